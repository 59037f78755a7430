"""Run-scoped raw batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ordering import in_order
from tidemark.sources import storage

DEFAULT_ROWS_PER_FILE = 1_000_000

# Doubled quotes and embedded line breaks follow RFC 4180; NULL and the empty
# string are both written as empty text and read back as NULL.
_CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "nullValue": "",
    "emptyValue": "",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    # Values go out and come back as they are, blanks included.
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def run_path(root: str, table: str, run_id: str) -> str:
    return f"{root}/bronze/{table}/run_{run_id}"


def write_run(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    order_by: Sequence[str] | None = None,
) -> int:
    """Writes one run's batch in files of at most ``rows_per_file`` rows and
    returns the number of rows.

    Without ``order_by`` the write has no shuffle at all. A repeated run
    replaces its own folder. The rows are counted on their way into the files,
    above any shuffle, where Spark counts a re-run task only once.
    """
    batch = in_order(df, order_by) if order_by else df
    written = Observation()
    observed = batch.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        writer.options(**_CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown raw format: {fmt}")
    return written.get["rows"]


PART = "part"


def write_parts(parts: Sequence[DataFrame], path: str, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> int:
    """Writes the parts of one run's batch side by side, each to files of its own, and returns the rows.

    The parts are the tasks of one write without a shuffle; a part's number is a folder
    ``part=<n>``, which :func:`read_run` leaves out of the columns.
    """
    numbered = [df.withColumn(PART, F.lit(i)) for i, df in enumerate(parts)]
    written = Observation()
    batch = reduce(DataFrame.unionByName, numbered).observe(written, F.count(F.lit(1)).alias("rows"))
    batch.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(PART).parquet(path)
    return written.get["rows"]


class IncompleteBatchError(ValueError):
    """A raw batch whose extraction failed half-way."""


def read_run(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame | None:
    """One run's batch, or None when the run wrote none.

    CSV columns all arrive as strings, under the names of the header row. A
    given ``schema`` is only for headers that are known to agree with it.
    """
    if not storage.exists(spark, path):
        return None
    if not storage.exists(spark, f"{path}/_SUCCESS"):
        raise IncompleteBatchError(f"{path} was not written to its end")
    if fmt == "parquet":
        batch = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
        return batch.drop(PART) if storage.child_folders(spark, path) else batch
    reader = spark.read.options(**_CSV_OPTIONS).option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
