"""Keyed tables stored in buckets of their key, each bucket one sorted file.

A join by the key reads such a table bucket by bucket and never shuffles it, however large
it is. Spark only knows buckets of tables in its catalog, so a table is entered there under
a name of its own for the moment in which it is written or looked up. The number of buckets and
their columns stand in the name of a marker file, so any session can read them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import storage

# Rows of a bucket, which is one task of a merge, before buckets are divided.
ROWS_PER_BUCKET = 1_000_000
# Small tables are still divided over the cores, as far as each gets this many rows.
_LEAST_ROWS = 10_000
_MARKER = "_buckets-"


class Buckets(NamedTuple):
    count: int
    keys: tuple[str, ...]
    # Rows of the table, 0 before it is written.
    rows: int = 0


def buckets_for(spark: SparkSession, rows: int, current: int | None = None) -> int:
    """Buckets of a table of that many rows; a count there is doubles while its buckets are overfull.

    Doubling keeps every row of a bucket in two new ones, so that a table is divided
    without a shuffle.
    """
    if current is None:
        spread = min(spark.sparkContext.defaultParallelism, rows // _LEAST_ROWS)
        return max(1, spread, -(-rows // ROWS_PER_BUCKET))
    while rows > 2 * current * ROWS_PER_BUCKET:
        current *= 2
    return current


def layout(spark: SparkSession, path: str) -> Buckets | None:
    """How the table at ``path`` is stored, None if not in buckets."""
    for name in storage.child_files(spark, path):
        if name.startswith(_MARKER):
            count, rows, *keys = name.removeprefix(_MARKER).split("-")
            return Buckets(int(count), tuple(unquote(k) for k in keys), int(rows))
    return None


def write(df: DataFrame, path: str, buckets: Buckets, flag: str | None = None) -> int:
    """Writes a new table. Rows of one bucket should already be in one task; else a bucket has several files.

    Returns how many rows have the column ``flag``, which is not written.
    """
    spark, name = df.sparkSession, _fresh_name()
    written = Observation()
    flagged = F.count_if(F.col(flag) if flag else F.lit(False))
    observed = df.observe(written, F.count(F.lit(1)).alias("rows"), flagged.alias("flagged"))
    observed = observed.drop(flag) if flag else observed
    writer = observed.write.format("parquet").mode("errorifexists").option("path", path)
    try:
        writer.bucketBy(buckets.count, *buckets.keys).sortBy(*buckets.keys).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    marks = "-".join([str(buckets.count), str(written.get["rows"]), *[quote(k, safe="").replace("-", "%2D") for k in buckets.keys]])
    storage.create_marker(spark, f"{path}/{_MARKER}{marks}")
    return written.get["flagged"]


def by_bucket(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``df`` with the rows of a bucket in one task, as :func:`write` wants them."""
    return df.repartition(buckets.count, *buckets.keys)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, with its buckets if it has any."""
    plain = spark.read.parquet(path)
    found = layout(spark, path)
    if found is None:
        return plain
    name = _fresh_name()
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in plain.schema.fields)
    keys = ", ".join(map(_quoted, found.keys))
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {found.count} BUCKETS LOCATION '{_escaped(path)}'"
    )
    try:
        # The frame keeps what the catalog said; the files are not the catalog's.
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def same_keys(buckets: Buckets | None, keys: Sequence[str]) -> bool:
    return buckets is not None and list(buckets.keys) == list(keys)


def _fresh_name() -> str:
    return f"tidemark_{uuid.uuid4().hex}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")
