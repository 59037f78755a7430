"""Current-state tables: versions in buckets of the key, and what each version changed."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import apply_changes, changes_to, merge_into_state, merge_keyed, net_changes
from tidemark.sources import keyed, snapshots, storage

_CHANGES, _CHANGED = "_changes-", "_changed"


def changes_folder(root: str) -> str:
    return f"{root}__changes"


def read_state(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A published version, with its buckets."""
    return keyed.read(spark, snapshots.version_path(root, version))


def merge_and_publish(
    latest: DataFrame, root: str, keys: list[str], ts: str, keep_versions: int | None = None, keep_changes: bool = False,
) -> int:
    """Merges a batch that holds each key at most once into the published table at ``root``; returns its version.

    Nothing is published if no row of the batch changes the table. The table is joined
    bucket by bucket; only the batch is shuffled. A batch with a NULL key, which no bucket
    join can match, is merged by shuffling both, and its changes are not kept. ``keep_changes`` keeps the changed rows, before
    and after, for those who build on the table, until :func:`forget_changes`. ``keep_versions``
    removes older versions and what they had changed.
    """
    spark = latest.sparkSession
    base = snapshots.current_version(spark, root)
    version = snapshots.next_version(spark, root)
    path = snapshots.version_path(root, version)
    rows, unkeyed = latest.agg(
        F.count(F.lit(1)), F.count_if(reduce(or_, [F.col(f"`{k}`").isNull() for k in keys]))
    ).first()
    if base is None:
        _write_first(latest, path, keys, rows)
    else:
        state = read_state(spark, root, base)
        before = keyed.layout(spark, snapshots.version_path(root, base))
        if unkeyed or not keyed.same_keys(before, keys):
            _write_first(merge_into_state(state, latest, keys, ts), path, keys, state.count() + rows)
        elif keep_changes:
            name = uuid.uuid4().hex
            kept, written = f"{changes_folder(root)}/{name}", Observation()
            changes = changes_to(state, latest, keys, ts)
            counted = changes.observe(written, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("errorifexists").parquet(kept)
            changes, added = spark.read.schema(changes.schema).parquet(kept), written.get["rows"]
            if added == 0:
                storage.remove(spark, kept)
                return base
            count = keyed.buckets_for(spark, before.rows + added, before.count)
            keyed.write(apply_changes(state, changes, keys), path, before._replace(count=count))
            storage.create_marker(spark, f"{path}/{_CHANGES}{base}-{name}")
        else:
            count = keyed.buckets_for(spark, before.rows + rows, before.count)
            merged = merge_keyed(state, latest, keys, ts, _CHANGED)
            if keyed.write(merged, path, before._replace(count=count), _CHANGED) == 0:
                storage.remove(spark, path)
                return base
    snapshots.publish(spark, root, version, base or 0)
    if keep_versions is not None:
        forget_changes(spark, root, version - keep_versions)
        snapshots.retire(spark, root, keep_versions)
    return version


def _write_first(df: DataFrame, path: str, keys: list[str], rows: int) -> None:
    buckets = keyed.Buckets(keyed.buckets_for(df.sparkSession, rows), tuple(keys))
    keyed.write(keyed.by_bucket(df, buckets), path, buckets)


def _change_marks(spark: SparkSession, root: str, version: int) -> list[tuple[int, str]]:
    """The version it follows and the name of the changes of a version that kept them."""
    names = storage.child_files(spark, snapshots.version_path(root, version))
    marks = [n.removeprefix(_CHANGES).split("-") for n in names if n.startswith(_CHANGES)]
    return [(int(base), name) for base, name in marks]


def changes_between(
    spark: SparkSession, root: str, keys: list[str], old: int, new: int
) -> DataFrame | None:
    """``before`` and ``after`` of the rows in which two published versions differ.

    None if the changes of a version between them were not kept, or have been removed; the
    versions then have to be taken as wholly different.
    """
    found, at = [], new
    while at > old:
        marks = _change_marks(spark, root, at)
        folder = f"{changes_folder(root)}/{marks[0][1]}" if marks else None
        if folder is None or not storage.exists(spark, folder):
            return None
        found.insert(0, spark.read.parquet(folder))
        at = marks[0][0]
    if at != old:
        return None
    if not found:
        row = snapshots.read_version(spark, root, new).schema
        return spark.createDataFrame([], StructType([StructField("before", row), StructField("after", row)]))
    return net_changes(found, keys)


def forget_changes(spark: SparkSession, root: str, up_to: int) -> None:
    """Removes the kept changes of versions up to ``up_to``."""
    for child in storage.child_folders(spark, root):
        version = child.removeprefix("v=")
        if version.isdigit() and int(version) <= up_to:
            for _, name in _change_marks(spark, root, int(version)):
                storage.remove(spark, f"{changes_folder(root)}/{name}")


def merge_stream_batch(batch: DataFrame, root: str, keys: list[str], ts: str, keep_versions: int | None) -> int | None:
    """Deduplicates a batch once, into a scratch table, and merges it."""
    if batch.isEmpty():
        return None
    with storage.owned_scratch(batch.sparkSession):
        latest = storage.materialise(latest_per_key(batch, keys, ts), "stream-batch")
        return merge_and_publish(latest, root, keys, ts, keep_versions)
