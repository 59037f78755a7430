"""Audits of row balance and key integrity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import repeated_keys


class ReconciliationError(ValueError):
    """Input and output row counts of a transformation differ."""


def reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows in, rows out and the difference, in one aggregate over the
    two tables' rows."""
    sides = source.select(F.lit(1).alias("side")).unionAll(target.select(F.lit(2).alias("side")))
    counts = sides.agg(
        F.count_if(F.col("side") == 1).alias("silver_rows"),
        F.count_if(F.col("side") == 2).alias("gold_rows"),
    )
    return counts.withColumn("discrepancy", F.col("silver_rows") - F.col("gold_rows"))


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of the given columns that also tell which of them are NULL."""
    nulls = reduce(add, [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << (i % 62))).otherwise(F.lit(0)).cast("long")
                         for i, c in enumerate(columns)])
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], nulls)


def digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that depend on which rows there are, and how often, but not on their order.

    The number of rows, and the sum and the XOR of their hashes: rows that are lost, repeated or
    swapped for others show even if the number stays. Partial results combine before any shuffle.
    """
    hashed = row_hash(columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(hashed.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor(hashed), F.lit(0).cast("long")).alias("hash_xor"),
    ]


def content_audit(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows in, rows out, the difference, and whether the columns hold the same rows.

    One pass over the two tables' columns; nothing is joined.
    """
    return digest_audit(source.agg(*digest(columns)), target.agg(*digest(columns)))


def added_up() -> list[Column]:
    """Aggregates that make the digest of a table from digests of its parts, such as its days."""
    return [
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("hash_sum"), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("hash_xor"), F.lit(0)).cast("long").alias("hash_xor"),
    ]


def taken_away(digests: DataFrame) -> DataFrame:
    """Digests that take their rows away from a table when they are added up with its own."""
    return digests.withColumns({c: -F.col(c) for c in ("rows", "hash_sum")})


def digest_audit(source: DataFrame, target: DataFrame) -> DataFrame:
    """:func:`content_audit` of two tables of which the digests are at hand, one row each."""
    both = reduce(DataFrame.unionByName, [
        df.select("rows", "hash_sum", "hash_xor", F.lit(i).alias("side")) for i, df in enumerate((source, target))
    ])

    def of(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    same = reduce(and_, [of(0, c) == of(1, c) for c in ("rows", "hash_sum", "hash_xor")])
    return both.agg(of(0, "rows").alias("silver_rows"), of(1, "rows").alias("gold_rows"), same.alias("same_content")).select(
        "silver_rows", "gold_rows", (F.col("silver_rows") - F.col("gold_rows")).alias("discrepancy"), "same_content"
    )


def require_content(audited: DataFrame) -> int:
    """Fails unless both sides of :func:`content_audit` hold the same rows; returns their number."""
    found = audited.first()
    require_balance(found["silver_rows"], found["gold_rows"])
    if not found["same_content"]:
        raise ReconciliationError(f"{found['gold_rows']} rows in and out, but not the same ones")
    return found["gold_rows"]


def require_balance(source_rows: int, target_rows: int) -> None:
    if source_rows != target_rows:
        raise ReconciliationError(f"{source_rows} rows in, {target_rows} rows out")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: per key column the number of NULLs."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(f"{k}_nulls") for k in keys])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return repeated_keys(df, keys).withColumnRenamed("n", "row_count")


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise ReconciliationError(f"{table} repeats a key of {list(keys)}")


def require_keys(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Fails on a missing or a repeated key."""
    missing = null_keys(df, keys).first()
    if any(missing):
        raise ReconciliationError(f"{table} has missing keys: {missing.asDict()}")
    require_unique(df, keys, table)
