"""Merging a batch into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key, orderable, tie_breakers
from tidemark.operators.sizing import BROADCAST_LIMIT, fits

_SIDE = "_from_batch"
_MATCHED = "_matched"


class DuplicateKeyError(ValueError):
    """New rows collide with existing keys or with each other."""


def merge_latest(
    existing: DataFrame | None, batch: DataFrame, keys: Sequence[str], ts: str
) -> DataFrame:
    """Newest row per key of ``existing`` and ``batch`` together.

    Makes no assumption about either side. On equal timestamps the batch wins.
    Columns are matched by name, and differing columns are an error.
    """
    if existing is None:
        return latest_per_key(batch, keys, ts)
    both = existing.withColumn(_SIDE, F.lit(0)).unionByName(batch.withColumn(_SIDE, F.lit(1)))
    return latest_per_key(both, keys, ts, prefer=[F.col(_SIDE).desc()]).drop(_SIDE)


def merge_into_state(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    ts: str,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``merge_latest`` for a batch that holds each key at most once.

    State rows newer than the batch's row of their key stay and keep it out; other
    state rows of the batch's keys give way to it. A state that repeats a key is
    thus handled row by row, and the result is the same however it is joined: if
    the keys of the batch are measured to be small, the table is never shuffled but
    scanned against the broadcast keys, otherwise the sides meet by their keys.
    """
    if existing is None:
        return batch
    _require_same_columns(existing, batch)
    marks = batch.select(*_renamed(keys), F.col(ts).alias("_batch_ts"), F.lit(True).alias(_MATCHED))
    if fits(marks, broadcast_limit):
        marks = F.broadcast(marks)
    state_wins = _newer(F.col(ts), F.col("_batch_ts"))
    kept = (
        existing.join(marks, _same_key(existing, marks, keys), "left")
        .filter(F.col(_MATCHED).isNull() | state_wins)
        .select(*existing.columns)
    )
    narrow = existing.select(*keys, ts)
    stale = (
        narrow.join(marks, _same_key(narrow, marks, keys), "inner")
        .filter(state_wins)
        .select(*_renamed(keys))
    )
    fresh = batch.join(stale, _same_key(batch, stale, keys), "left_anti")
    return kept.unionByName(fresh)


def changes_to(existing: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``before`` and ``after`` of every row of ``batch`` that changes a keyed table.

    For tables that hold each key at most once, and no NULL key, on both sides: a row
    counts if its key is new (``before`` is NULL) or the table's row of the key is not newer and
    differs from it. A table stored in buckets of the keys is not shuffled; the batch is.
    """
    _require_same_columns(existing, batch)
    columns = [f"`{c}`" for c in existing.columns]
    joined = batch.select(F.struct(*columns).alias("after")).join(existing, _after_has(keys), "left")
    return joined.filter(_changes(existing, keys, ts)).select(
        F.when(_known(keys), F.struct(*columns)).alias("before"), "after"
    )


def apply_changes(existing: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the ``after`` rows of :func:`changes_to` in place of their keys' rows.

    One full join by the keys: a table stored in buckets of them is read bucket by bucket
    and comes out in the same buckets, sorted, without a shuffle.
    """
    changed = F.col("after").isNotNull()
    return existing.join(changes.select("after"), _after_has(keys), "full").select(
        *[F.when(changed, F.col(f"after.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in existing.columns]
    )


def merge_keyed(existing: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str, flag: str) -> DataFrame:
    """:func:`changes_to` and :func:`apply_changes` in one full join; ``flag`` marks the rows that have changed."""
    _require_same_columns(existing, batch)
    after = batch.select(F.struct(*[f"`{c}`" for c in existing.columns]).alias("after"))
    changed = F.col("after").isNotNull() & _changes(existing, keys, ts)
    return existing.join(after, _after_has(keys), "full").withColumn(flag, changed).select(
        *[F.when(F.col(flag), F.col(f"after.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in existing.columns], flag
    )


def _known(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def _changes(existing: DataFrame, keys: Sequence[str], ts: str) -> Column:
    """True where ``after`` is new, or not older than the row of its key and different from it."""
    won = ~_newer(F.col(f"`{ts}`"), F.col(f"after.`{ts}`"))
    # Columns without an order, such as maps, can't be compared and count as changed.
    equal = [
        F.col(f"`{f.name}`").eqNullSafe(F.col(f"after.`{f.name}`")) if orderable(f.dataType) else F.lit(False)
        for f in existing.schema.fields
    ]
    return ~_known(keys) | (won & ~reduce(and_, equal))


def _after_has(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"`{k}`") == F.col(f"after.`{k}`") for k in keys])


def net_changes(changes: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One ``before`` and ``after`` per key from the changes of consecutive versions, oldest first."""
    if len(changes) == 1:
        return changes[0]
    numbered = [c.withColumn("_turn", F.lit(i)) for i, c in enumerate(changes)]
    together = reduce(DataFrame.unionByName, numbered)
    # A struct may be NULL, which min_by takes as a value like others.
    return together.groupBy(*[F.col(f"after.`{k}`").alias(f"_{i}") for i, k in enumerate(keys)]).agg(
        F.min_by("before", "_turn").alias("before"), F.max_by("after", "_turn").alias("after")
    ).select("before", "after")


def _require_same_columns(existing: DataFrame, batch: DataFrame) -> None:
    if set(existing.columns) != set(batch.columns):
        raise ValueError(f"columns differ: {sorted(existing.columns)} and {sorted(batch.columns)}")


def _renamed(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_batch_{k}") for k in keys]


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[f"_batch_{k}"])
    return condition


def _newer(state_ts: Column, batch_ts: Column) -> Column:
    """True when the state's timestamp beats the batch's; never NULL."""
    return state_ts.isNotNull() & (batch_ts.isNull() | (state_ts > batch_ts))


def _present_keys(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch keys that ``existing`` already holds.

    The large side is reduced by a semi join first, which needs no shuffle of
    it when Spark finds the batch keys small enough to broadcast.
    """
    wanted = batch.select(*keys)
    return existing.select(*keys).join(wanted, list(keys), "left_semi").distinct()


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column]
) -> DataFrame:
    """Existing rows stay; of the batch only unknown keys are added.

    ``order_by`` ranks batch rows that share a key: the first one is inserted.
    """
    first = first_per_key(batch, keys, order_by)
    new = first.join(_present_keys(existing, batch, keys), list(keys), "left_anti")
    return existing.unionByName(new.select(*batch.columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key; rows that tie are decided by their other columns."""
    window = Window.partitionBy(*keys).orderBy(*order_by, *tie_breakers(df, keys))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def upsert_by_key(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Incoming rows replace existing rows of the same key unconditionally.

    Of incoming rows that share a key, the one with the largest other columns
    counts, so that an upsert never adds rows for a known key.
    """
    incoming = first_per_key(incoming, keys, [])
    if existing is None:
        return incoming
    kept = existing.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(incoming)


def update_by_key(
    existing: DataFrame,
    patches: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """Sets ``columns`` of the rows whose key has a patch.

    Other columns and rows stay; patches for unknown keys have no effect; a
    patch may set a column to NULL. Of patches that share a key, the one with
    the largest values counts: an update never adds rows.
    """
    changes = first_per_key(patches.select(*keys, *columns), keys, []).select(
        *_renamed(keys),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
        F.lit(True).alias(_MATCHED),
    )
    condition = F.lit(True)
    for k in keys:
        condition = condition & (existing[k] == changes[f"_batch_{k}"])
    dtypes = {f.name: f.dataType for f in existing.schema.fields}
    return existing.join(changes, condition, "left").select(
        *[
            F.when(F.col(_MATCHED).isNotNull(), F.col(f"_new_{c}").cast(dtypes[c]))
            .otherwise(F.col(c))
            .alias(c)
            if c in columns
            else F.col(c)
            for c in existing.columns
        ]
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def append_new(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` and ``batch`` together, after checking that the batch only
    brings new keys, each once."""
    require_new_keys(existing, batch, keys)
    return existing.unionByName(batch)


def require_new_keys(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> None:
    if not repeated_keys(batch, keys).isEmpty():
        raise DuplicateKeyError(f"batch repeats a key of {list(keys)}")
    if not _present_keys(existing, batch, keys).isEmpty():
        raise DuplicateKeyError(f"batch holds an existing key of {list(keys)}")


def append_batch(batch: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Appends the batch to a Parquet table after checking its keys.

    For one writer at a time: the check and the append are two steps, and a write
    that fails half-way may leave files behind. ``snapshots.replace`` publishes a
    whole version instead.
    """
    spark = batch.sparkSession
    require_new_keys(spark.read.parquet(path), batch, keys)
    batch.write.mode("append").parquet(path)
