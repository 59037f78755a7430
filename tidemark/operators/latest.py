"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "_rank"


def orderable(dtype: DataType) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True


def tie_breakers(df: DataFrame, exclude: Sequence[str]) -> list[Column]:
    """All other columns, largest first, so equal timestamps rank the same way
    on every run."""
    return [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in exclude and orderable(f.dataType)
    ]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Keeps one row per key: the newest, a NULL timestamp ranking last.

    Spark turns the ``rank = 1`` filter into a group limit on both sides of the
    shuffle: every map task sends at most one row per key, so a key that holds
    a large share of the table does not concentrate in one reducer.
    """
    order = [F.col(ts).desc_nulls_last(), *prefer, *tie_breakers(df, [*keys, ts])]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
