"""Left joins of a large table to its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sizing import BROADCAST_LIMIT, fits
from tidemark.sources.storage import materialise

_SALT = "_salt"
_SALTS = "_salts"

# Rows of one key that one task should have to join.
ROWS_PER_TASK = 4_000_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Key values with more rows than one task should take, and over how many
    tasks (``_salts``) each is to be divided.

    A table of N rows has fewer than ``N / rows_per_task`` of them, a few
    hundred thousand short rows for a trillion, which bounds their broadcast.
    Only the key column is read, and counts are combined before the shuffle.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    salts = F.ceil(F.col("n") / F.lit(rows_per_task)).cast("long")
    hot = counts.filter(F.col("n") > rows_per_task).select(key, salts.alias(_SALTS))
    return materialise(hot, "hot-keys")


def salted_left_join(
    df: DataFrame, dim: DataFrame, key: str, spread_by: Sequence[str], hot: DataFrame
) -> DataFrame:
    """Left equi-join in which each hot key is divided over several tasks.

    Rows of a hot key get one of its salts, and the matching dimension rows are
    repeated once per salt, so each row meets each of its dimension rows
    exactly once, as in the plain join. Rows without a key match nothing and
    are spread over all tasks.

    The salt is a hash of ``spread_by``, such as the row's own key, and of the
    task the row comes from, which also spreads exact copies and stays the same
    when a lost task is run again.
    """
    spread = F.xxhash64(*spread_by, F.spark_partition_id())
    no_salt = F.lit(0).cast("long")
    salt = F.when(F.col(key).isNull(), spread)
    left, right = df, dim.withColumn(_SALT, no_salt)
    if not hot.isEmpty():
        salt = salt.when(F.col(_SALTS).isNotNull(), F.pmod(spread, F.col(_SALTS)))
        left = df.join(F.broadcast(hot), key, "left")
        last = F.coalesce(F.col(_SALTS), F.lit(1)) - 1
        right = dim.join(F.broadcast(hot), key, "left").select(
            *dim.columns, F.explode(F.sequence(no_salt, last)).alias(_SALT)
        )
    left = left.select(*df.columns, salt.otherwise(no_salt).alias(_SALT))
    return left.join(right, [key, _SALT], "left").drop(_SALT)


def dimension_join(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Sequence[str],
    broadcast_limit: int = BROADCAST_LIMIT,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Left join to a dimension: broadcast when it was measured to be small,
    else a shuffle join.

    Hot keys are counted and divided when ``count_in`` is given: a *stored* narrow
    table with the same distribution of ``key``, such as the table ``df`` was joined
    together from. Without it no job looks for them, and the skew join of adaptive
    execution, which splits a large partition of the left side, is relied on. Leave
    it out for keys that are nearly unique, and where ``df`` is itself a join, which
    counting would run once more. The rows are the same either way.
    """
    if fits(dim, broadcast_limit):
        return df.join(F.broadcast(dim), key, "left")
    if count_in is None:
        return df.join(dim, key, "left")
    return salted_left_join(df, dim, key, spread_by, hot_keys(count_in, key))
