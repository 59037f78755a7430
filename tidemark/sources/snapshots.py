"""Versioned Parquet tables.

Each write goes to its own ``v=<n>`` folder and becomes visible only once its
marker file exists. Readers take the highest published version, so nothing is
ever overwritten while it is being read, and a failed or rejected write leaves
the previous version current. A version may also hold several tables that are
published together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources import storage

_MARKER = "_PUBLISHED"
_PREFIX = "v="
_CLAIM = "_after-"


class ConcurrentWriteError(RuntimeError):
    """Another job published the table first."""


def version_path(root: str, version: int) -> str:
    return f"{root}/{_PREFIX}{version}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    names = storage.child_folders(spark, root)
    return sorted(int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX))


def current_version(spark: SparkSession, root: str) -> int | None:
    for version in reversed(_versions(spark, root)):
        if storage.exists(spark, f"{version_path(root, version)}/{_MARKER}"):
            return version
    return None


def next_version(spark: SparkSession, root: str) -> int:
    """One more than any version there is, published or not."""
    return max(_versions(spark, root), default=0) + 1


def read_version(
    spark: SparkSession, root: str, version: int, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(version_path(root, version))


def read_current(
    spark: SparkSession, root: str, schema: StructType | None = None
) -> DataFrame | None:
    """The published table, or None when there is none yet."""
    version = current_version(spark, root)
    return None if version is None else read_version(spark, root, version, schema)


def write_draft(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Writes a new version without publishing it."""
    version = next_version(df.sparkSession, root)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version_path(root, version))
    return version


def publish(spark: SparkSession, root: str, version: int, based_on: int | None = None) -> None:
    """Makes a draft the current version.

    The base is claimed first, which only one writer can do (on the file systems of
    ``storage.EXCLUSIVE_SCHEMES``; others are refused). A writer that dies between its
    claim and the marker leaves a base that nobody else can follow until
    :func:`release` takes the claim back.

    Fails if a later version was published meanwhile or, given the version the
    draft was computed from (0 for none), if that is no longer the current one:
    the draft would undo what another job has published.
    """
    newest = current_version(spark, root) or 0
    base = newest if based_on is None else based_on
    if newest >= version or newest != base:
        raise ConcurrentWriteError(f"{root} is at version {newest}; {version} comes too late")
    # One draft per base can win, however the steps of two writers interleave.
    if not storage.claim(spark, f"{root}/{_CLAIM}{base}"):
        raise ConcurrentWriteError(f"another draft follows version {base} of {root}")
    if not storage.create_marker(spark, f"{version_path(root, version)}/{_MARKER}"):
        raise ConcurrentWriteError(f"version {version} of {root} is already published")


def release(spark: SparkSession, root: str) -> bool:
    """Takes back the claim on the current version of a writer known to be dead."""
    return storage.remove(spark, f"{root}/{_CLAIM}{current_version(spark, root) or 0}")


def replace(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), based_on: int | None = None
) -> int:
    """Writes and publishes a new version of the whole table."""
    version = write_draft(df, root, partition_by)
    publish(df.sparkSession, root, version, based_on)
    return version


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Removes published versions older than the last ``keep``, and drafts that
    were given up before the current one. Readers of a removed version fail, so
    ``keep`` has to cover the longest-running of them."""
    if keep < 1:
        raise ValueError("the current version has to stay")
    versions = _versions(spark, root)
    published = [
        v for v in versions if storage.exists(spark, f"{version_path(root, v)}/{_MARKER}")
    ]
    if not published:
        return []
    kept = set(published[-keep:])
    old = [v for v in versions if v not in kept and v < published[-1]]
    for version in old:
        storage.remove(spark, version_path(root, version))
    return old
