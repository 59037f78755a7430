"""Watermark state: the last extraction of every source table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tidemark.operators.extract import EPOCH, micros
from tidemark.operators.merge import upsert_by_key
from tidemark.sources import snapshots

STATE_KEYS = ("pipeline_name", "source_table")
STATE_SCHEMA = StructType(
    [
        StructField("pipeline_name", StringType()),
        StructField("source_table", StringType()),
        StructField("last_success_watermark", TimestampType()),
        StructField("last_run_status", StringType()),
        StructField("pipeline_run_id", StringType()),
    ]
)
SUCCESS = "SUCCESS"


def failed(message: str) -> str:
    return f"FAILED: {message}"


class LastRun(NamedTuple):
    watermark: int
    status: str | None = None
    run_id: str | None = None


NEVER_RUN = LastRun(EPOCH)


def entries_of(state: DataFrame, pipeline: str, table: str) -> DataFrame:
    return state.filter((F.col("pipeline_name") == pipeline) & (F.col("source_table") == table))


def find_watermark(state: DataFrame, pipeline: str, table: str) -> DataFrame:
    """One row: the stored watermark of a table, or 1970-01-01."""
    start = F.timestamp_micros(F.lit(EPOCH))
    latest = F.coalesce(F.max("last_success_watermark"), start)
    return entries_of(state, pipeline, table).agg(latest.alias("low_watermark"))


def last_runs(spark: SparkSession, root: str, pipeline: str) -> dict[str, LastRun]:
    """The stored entries of a pipeline, one per source table."""
    state = snapshots.read_current(spark, root, STATE_SCHEMA)
    if state is None:
        return {}
    entries = state.filter(F.col("pipeline_name") == pipeline).select(
        "source_table",
        micros(F.col("last_success_watermark")),
        "last_run_status",
        "pipeline_run_id",
    )
    return {table: LastRun(*entry) for table, *entry in entries.collect()}


def record(
    spark: SparkSession,
    root: str,
    pipeline: str,
    run_id: str,
    entries: Sequence[tuple[str, int, str]],
) -> None:
    """Replaces the entries of the given (table, watermark, status)."""
    if not entries:
        return
    rows = F.array(
        *[
            F.struct(
                F.lit(pipeline).alias("pipeline_name"),
                F.lit(table).alias("source_table"),
                F.timestamp_micros(F.lit(watermark)).alias("last_success_watermark"),
                F.lit(status).alias("last_run_status"),
                F.lit(run_id).alias("pipeline_run_id"),
            )
            for table, watermark, status in entries
        ]
    )
    incoming = spark.range(1, numPartitions=1).select(F.inline(rows))
    version = snapshots.current_version(spark, root)
    current = None
    if version is not None:
        current = snapshots.read_version(spark, root, version, STATE_SCHEMA)
    # One row per table: a single file is the right size for it.
    merged = upsert_by_key(current, incoming, STATE_KEYS).coalesce(1)
    snapshots.replace(merged, root, based_on=version or 0)
