"""Append-only record of what each run did, and what it has left to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.sources import storage

EXTRACTED = "extracted"
PROMOTED = "promoted"
GOLD = "gold"

LEDGER_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("table_name", StringType()),
        StructField("stage", StringType()),
        StructField("row_count", LongType()),
        StructField("duration_seconds", DoubleType()),
        StructField("logged_at", StringType()),
    ]
)


def append(
    spark: SparkSession,
    path: str,
    run_id: str,
    stage: str,
    entries: Sequence[tuple[str, int, float]],
) -> None:
    """Adds the (table, rows, seconds) of one stage of a run."""
    if not entries:
        return
    rows = F.array(
        *[
            F.struct(
                F.lit(run_id).alias("run_id"),
                F.lit(table).alias("table_name"),
                F.lit(stage).alias("stage"),
                F.lit(count).cast("long").alias("row_count"),
                F.lit(float(seconds)).alias("duration_seconds"),
                F.current_timestamp().cast("string").alias("logged_at"),
            )
            for table, count, seconds in entries
        ]
    )
    spark.range(1, numPartitions=1).select(F.inline(rows)).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    if not storage.exists(spark, path):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def pending(ledger: DataFrame, done_stage: str = PROMOTED) -> DataFrame:
    """Extracted batches that never reached ``done_stage``.

    A batch whose later stages failed keeps showing up here, so it can be
    replayed although the watermark has moved past it.
    """
    extracted = ledger.filter(F.col("stage") == EXTRACTED).select("run_id", "table_name")
    done = ledger.filter(F.col("stage") == done_stage).select("run_id", "table_name")
    return extracted.distinct().join(done, ["run_id", "table_name"], "left_anti")


def run_summary(ledger: DataFrame) -> DataFrame:
    """Capacity report: rows per stage of each run and table, the difference
    between what was promoted and what went in, and the time taken."""
    def rows(stage: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col("row_count")))

    missing = F.lit(0)
    balance = F.coalesce("extracted_rows", missing) - F.coalesce("silver_rows", missing)
    return (
        ledger.groupBy("run_id", "table_name")
        .agg(
            rows(EXTRACTED).alias("extracted_rows"),
            rows(PROMOTED).alias("silver_rows"),
            rows(GOLD).alias("gold_rows"),
            F.sum("duration_seconds").alias("duration_seconds"),
        )
        .withColumn("discrepancy", balance)
    )
