"""Source tables in a relational database.

Not exercised by the tests: they have no database and no driver jar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: Mapping[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table read by ``partitions`` parallel queries over ranges of
    ``split_column``, fetching ``fetch_size`` rows per round trip.

    The result is lazy: watermark filters applied to it are sent to the
    database with each query.
    """
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={**(properties or {}), "fetchsize": str(fetch_size)},
    )


def read_windows(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], properties: Mapping[str, str] | None = None
) -> DataFrame:
    """A table read by one query per condition, such as those of ``operators.extract.window_predicates``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties or {}))
