"""Dense row numbers over a whole table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import in_order
from tidemark.sources.storage import materialise

_PART = "_part"
_POSITION = "_position"
_OFFSET = "_offset"


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str = "row_number", start: int = 1
) -> DataFrame:
    """Numbers the rows ``start, start + 1, ...`` in the order of ``order_by``.

    ``order_by`` should identify a row; ties are numbered in arbitrary order.
    Rows are range-partitioned and sorted per partition, then each partition's
    numbers are shifted by the sizes of the ones before it. The placed rows are
    written out in between, because a second range partitioning of the same
    plan may sample other bounds.
    """
    placed = in_order(df, order_by)
    # The low 33 bits of the id are the row's position in its partition.
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fixed = materialise(
        placed.select("*", F.spark_partition_id().alias(_PART), position.alias(_POSITION)),
        "numbered",
    )
    # One size per partition of the range shuffle, however many rows there are.
    counted = fixed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    sizes = sorted((row[_PART], row["n"]) for row in counted.collect())
    starts = accumulate([n for _, n in sizes], initial=start)
    offsets = df.sparkSession.createDataFrame(
        [(part, first) for (part, _), first in zip(sizes, starts)],
        f"{_PART} int, {_OFFSET} long",
    )
    return fixed.join(F.broadcast(offsets), _PART).select(
        *df.columns, (F.col(_OFFSET) + F.col(_POSITION)).alias(name)
    )


def assign_chunks(
    df: DataFrame, order_by: Sequence[str], rows_per_chunk: int, name: str = "chunk"
) -> DataFrame:
    """Ordered chunks of exactly ``rows_per_chunk`` rows, numbered from 1."""
    numbered = number_rows(df, order_by, "_row", start=0)
    chunk = F.floor(F.col("_row") / F.lit(rows_per_chunk)) + 1
    return numbered.select(*df.columns, chunk.cast("long").alias(name))


def allocate_keys(
    existing: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Gives incoming rows the keys after the largest existing one (0 if none)."""
    highest = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]
    rest = incoming.drop(key)
    numbered = number_rows(rest, order_by, key, start=highest + 1)
    return numbered.select(key, *rest.columns)


def sample_rows(df: DataFrame, count: int, seed: int) -> DataFrame:
    """``count`` random rows, by a top-k on a random order rather than a sort."""
    return df.orderBy(F.rand(seed)).limit(count)


def sample_by_hash(df: DataFrame, key: str, count: int, seed: str = "") -> DataFrame:
    """``count`` rows in the order of a seeded hash of their key: the same rows
    on every run and on any partitioning."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary"))
    return df.orderBy(digest, F.col(key)).limit(count)
