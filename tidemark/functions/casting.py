"""Casting raw columns to a declared contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CAST_FAILED = "cast_failed"


def _source_text(df: DataFrame, name: str, trim: bool) -> Column:
    column = F.col(f"`{name}`")
    if trim and isinstance(df.schema[name].dataType, StringType):
        return F.trim(column)
    return column


def _typed(source: Column, field: StructField) -> Column:
    return source.try_cast(field.dataType)


def cast_to_schema(
    df: DataFrame, schema: StructType, trim: bool = False, report_failures: bool = False
) -> DataFrame:
    """Casts every contract column in place; columns outside it pass through.

    Text that does not parse becomes NULL and is left to the NULL rules.
    ``report_failures`` adds ``cast_failed``: the contract columns that held a
    value before the cast and NULL after it.
    """
    declared = {field.name: field for field in schema.fields}
    projection = [
        _typed(_source_text(df, name, trim), declared[name]).alias(name)
        if name in declared
        else F.col(f"`{name}`")
        for name in df.columns
    ]
    if report_failures:
        none = F.array().cast("array<string>")
        lost = [
            F.when(
                _source_text(df, name, trim).isNotNull() & _typed(_source_text(df, name, trim), declared[name]).isNull(),
                F.array(F.lit(name)),
            ).otherwise(none)
            for name in casts(df, schema)
        ]
        projection.append((F.concat(*lost) if lost else none).alias(CAST_FAILED))
    return df.select(*projection)


def casts(df: DataFrame, schema: StructType) -> list[str]:
    """The contract columns whose type differs from the declared one, in the contract's order."""
    return [f.name for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]


def all_text(schema: StructType) -> StructType:
    """The same columns, every one of them a nullable string."""
    return StructType([StructField(field.name, StringType(), True) for field in schema.fields])
