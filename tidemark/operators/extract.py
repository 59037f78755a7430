"""Bounded incremental extraction by a watermark column.

Watermarks travel between jobs as microseconds since 1970-01-01, which survive
the trip through Python exactly. Filters compare the bare column with a folded
literal of the column's own type, so they reach the Parquet or JDBC scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = 0


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def watermark_literal(df: DataFrame, ts: str, value: int) -> Column:
    return F.timestamp_micros(F.lit(value)).cast(df.schema[ts].dataType)


def max_watermark(df: DataFrame, ts: str) -> DataFrame:
    """One row: the latest timestamp, NULL for an empty table."""
    return df.agg(F.max(ts).alias("high_watermark"))


def max_or_default(df: DataFrame, column: str, default, name: str) -> DataFrame:
    """One row: the largest value of ``column``, or ``default`` without any."""
    fallback = F.lit(default).cast(df.schema[column].dataType)
    return df.agg(F.coalesce(F.max(column), fallback).alias(name))


def high_watermark(df: DataFrame, ts: str) -> int | None:
    return df.agg(micros(F.max(ts))).first()[0]


def extract_window(df: DataFrame, ts: str, low: int, high: int) -> DataFrame:
    """Rows with ``low < ts <= high``; rows without a timestamp never qualify."""
    after = F.col(ts) > watermark_literal(df, ts, low)
    until = F.col(ts) <= watermark_literal(df, ts, high)
    return df.filter(after & until)


def window_bounds(df: DataFrame, ts: str, low: int, high: int, parts: int) -> list[int]:
    """Marks that divide the rows with ``low < ts <= high`` into about equal parts, the outer two included.

    One pass over the column with a sketch of fixed size per task; equal timestamps
    stay together, so there may be fewer parts.
    """
    shares = [i / parts for i in range(1, parts)]
    inner: list[int] = []
    if shares:
        sketch = F.percentile_approx(micros(F.col(ts)), F.array(*map(F.lit, shares)), F.lit(10_000))
        inner = extract_window(df, ts, low, high).agg(sketch).first()[0] or []
    return [low, *sorted({b for b in inner if low < b < high}), high]


def window_parts(df: DataFrame, ts: str, bounds: Sequence[int]) -> list[DataFrame]:
    """One frame per part: each is a scan with a window of its own pushed down."""
    return [extract_window(df, ts, low, high) for low, high in pairwise(bounds)]


def window_predicates(ts: str, bounds: Sequence[int]) -> list[str]:
    """The parts as SQL conditions, for sources that are read by predicates, such as JDBC tables."""

    def text(mark: int) -> str:
        return f"TIMESTAMP '{datetime.fromtimestamp(mark // 1_000_000, timezone.utc):%Y-%m-%d %H:%M:%S}.{mark % 1_000_000:06d}'"

    return [f"{ts} > {text(low)} AND {ts} <= {text(high)}" for low, high in pairwise(bounds)]


def late_rows(df: DataFrame, ts: str, low: int) -> DataFrame:
    """Rows at or below the stored mark: no later extraction returns them."""
    return df.filter(F.col(ts) <= watermark_literal(df, ts, low))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def is_populated(df: DataFrame) -> bool:
    return not df.isEmpty()
