"""Measured bounds that decide whether a table may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, NumericType, StringType

BROADCAST_LIMIT = 64 * 1024 * 1024

# Every value takes at least one eight-byte word in Spark's row format.
_WORD = 8


def _row_width(df: DataFrame) -> Column:
    width = F.lit(_WORD * (len(df.columns) + 1))
    for f in df.schema.fields:
        width = width + _variable_width(F.col(f"`{f.name}`"), f.dataType)
    return width


def _variable_width(column: Column, dtype: DataType) -> Column:
    if isinstance(dtype, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + _WORD
    if isinstance(dtype, NumericType) or dtype.typeName() in (
        "boolean", "date", "timestamp", "timestamp_ntz"
    ):
        return F.lit(_WORD)
    return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 2 + _WORD


def fits(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """True when the rows of ``df`` were measured to take at most ``limit`` bytes.

    Counts first, which Parquet answers from its footers; only a table whose
    row count leaves room is read for the lengths of its values.
    """
    rows = df.count()
    if rows * _WORD * (len(df.columns) + 1) > limit:
        return False
    measured = df.agg(F.sum(_row_width(df))).first()[0]
    return (measured or 0) <= limit
