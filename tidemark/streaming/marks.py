"""A stream over a source table whose offsets are watermarks.

Where a stream of files remembers file names, this one remembers how far the watermark
column has been read. Each trigger takes the rows with ``low < watermark <= high``, as the batch
extraction does: the low mark is the one before, the high mark the largest there is when the trigger
starts. Row groups are the partitions; those whose statistics lie outside the window are not read. A
trigger that has failed is repeated with the same two marks, from the stream's own log.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.contracts import TableContract
from tidemark.operators.extract import EPOCH
from tidemark.streaming.ingest import merge_batch

FORMAT = "marked_files"


@dataclass
class RowGroup(InputPartition):
    """A row group of a file, and the window its rows are wanted from."""

    path: str
    number: int
    low: int
    high: int


class MarkedFiles(DataSource):
    """Parquet files right below a folder; options ``path`` and ``watermark`` (a timestamp column).

    Works on file systems that pyarrow opens by their URI: local disks, HDFS, S3, GCS.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _MarkReader(self.options["path"], self.options["watermark"], schema)


class _MarkReader(DataSourceStreamReader):
    def __init__(self, path: str, watermark: str, schema: StructType):
        self.path, self.watermark, self.schema = path, watermark, schema

    def initialOffset(self) -> dict:
        return {"mark": EPOCH}

    def latestOffset(self) -> dict:
        """The largest watermark, from the files' footers."""
        return {"mark": max((high for _, _, _, high in self._row_groups()), default=EPOCH)}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        low, high = start["mark"], end["mark"]
        return [
            RowGroup(path, number, low, high)
            for path, number, least, most in self._row_groups() if most > low and least <= high
        ]

    def read(self, partition: RowGroup) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(self.schema)
        with _open(partition.path) as file:
            for batch in file.iter_batches(row_groups=[partition.number], columns=fields.names):
                marks = _micros(batch.column(batch.schema.get_field_index(self.watermark)))
                wanted = pc.and_(pc.greater(marks, partition.low), pc.less_equal(marks, partition.high))
                rows = batch.filter(pc.fill_null(wanted, False))
                columns = [rows.column(rows.schema.get_field_index(f.name)).cast(f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    def _row_groups(self) -> list[tuple[str, int, int, int]]:
        """File, number, least and largest mark of every row group that has any."""
        system, root, prefix = _file_system(self.path)
        from pyarrow import fs

        names = [
            f.path for f in system.get_file_info(fs.FileSelector(root))
            if f.is_file and f.path.endswith(".parquet") and not f.base_name.startswith(("_", "."))
        ]
        with ThreadPoolExecutor(16) as pool:
            found = pool.map(lambda name: _marks_of(prefix + name, self.watermark), sorted(names))
            return [group for groups in found for group in groups]


def _file_system(path: str):
    """A pyarrow file system, the path in it, and what stands before paths in it to make them URIs."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path, ""
    system, root = fs.FileSystem.from_uri(path)
    return system, root, path[: len(path) - len(root)] if path.endswith(root) else path.split("://")[0] + "://"


def _open(path: str):
    import pyarrow.parquet as pq

    system, name, _ = _file_system(path)
    return pq.ParquetFile(name, filesystem=system)


def _micros(column):
    """Timestamps as microseconds since 1970."""
    import pyarrow as pa

    zone = column.type.tz if pa.types.is_timestamp(column.type) else None
    return column.cast(pa.timestamp("us", zone), safe=False).cast(pa.int64())


def _marks_of(path: str, watermark: str) -> list[tuple[str, int, int, int]]:
    import pyarrow as pa
    import pyarrow.compute as pc

    out = []
    with _open(path) as file:
        kind = file.schema_arrow.field(watermark).type
        names = [file.metadata.schema.column(i).path for i in range(file.metadata.num_columns)]
        at = names.index(watermark)
        for number in range(file.metadata.num_row_groups):
            statistics = file.metadata.row_group(number).column(at).statistics
            if statistics is not None and statistics.has_min_max:
                bounds = _micros(pa.array([statistics.min, statistics.max]).cast(kind, safe=False))
            else:
                # Files without statistics, such as old INT96 ones: the column is read.
                column = file.read_row_group(number, columns=[watermark]).column(0)
                bounds = _micros(pa.array([pc.min(column).as_py(), pc.max(column).as_py()], column.type))
            least, most = bounds.to_pylist()
            if most is not None:
                out.append((path, number, least, most))
    return out


def read_marks(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """The source table at ``path`` as a stream by the contract's watermark."""
    spark.dataSource.register(MarkedFiles)
    return (
        spark.readStream.format(FORMAT).schema(contract.schema)
        .option("path", path).option("watermark", contract.watermark).load()
    )


def merge_new(
    spark: SparkSession, path: str, root: str, contract: TableContract, checkpoint: str, keep_versions: int | None = None
) -> StreamingQuery:
    """Starts a query that merges all rows above the last mark into the table at ``root``, at once, and stops."""
    return (
        read_marks(spark, path, contract).writeStream.foreachBatch(merge_batch(root, contract, keep_versions))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
