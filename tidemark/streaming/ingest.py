"""The incremental merge as a Structured Streaming job.

Each trigger takes the files that arrived since the last one; the stream's
checkpoint takes the place of the watermark table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.contracts import TableContract
from tidemark.plans.versions import merge_stream_batch


# A century.
MAX_FILE_AGE_DAYS = 36_500


def read_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files: int = 1000
) -> DataFrame:
    """New files under ``path``, at most ``files`` of them per batch.

    Spark ignores files whose time stamp lies ``maxFileAge`` before the latest one
    it has seen, seven days unless told otherwise. Copied files keep old stamps, so
    the age is set beyond any retention; the stream's log remembers file names for
    as long, which is what removing files that were taken in keeps small.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files)
        .option("maxFileAge", f"{MAX_FILE_AGE_DAYS}d")
    )
    return reader.format(fmt).load(path)


def merge_batch(
    root: str, contract: TableContract, keep_versions: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Merges a micro-batch into the published table at ``root``.

    Repeating a batch after a failure leads to the same table, so the
    at-least-once delivery of ``foreachBatch`` is enough.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_stream_batch(batch, root, [contract.key], contract.watermark, keep_versions)

    return merge


def merge_available(
    stream: DataFrame,
    root: str,
    contract: TableContract,
    checkpoint: str,
    keep_versions: int | None = None,
) -> StreamingQuery:
    """Starts a query that merges everything available now and then stops."""
    return (
        stream.writeStream.foreachBatch(merge_batch(root, contract, keep_versions))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
