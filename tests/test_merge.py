from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.latest import latest_per_key

SCHEMA = "id int, v string, ts timestamp"


def at(minute):
    return None if minute is None else datetime.datetime(2026, 1, 1, 0, minute)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, at(m)) for i, v, m in rows], SCHEMA)


def values(df):
    return sorted(((r.id, r.v, r.ts) for r in df.collect()), key=repr)


def expected(*rows):
    return sorted(((i, v, at(m)) for i, v, m in rows), key=repr)


def test_latest_wins_and_null_timestamp_loses(spark):
    df = frame(spark, [(1, "a", 1), (1, "b", 3), (1, "c", None), (2, "d", None)])
    assert values(latest_per_key(df, ["id"], "ts")) == expected((1, "b", 3), (2, "d", None))


def test_ties_do_not_depend_on_the_input_order(spark):
    rows = [(1, v, 5) for v in "abcdefgh"]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = frame(spark, rows).repartition(3)
        assert values(latest_per_key(df, ["id"], "ts")) == expected((1, "h", 5))


def test_columns_without_an_order_are_allowed(spark):
    df = frame(spark, [(1, "a", 1), (1, "b", 2)]).withColumn("m", F.create_map("v", "id"))
    assert latest_per_key(df, ["id"], "ts").first().v == "b"


def test_hot_keys_shrink_before_the_shuffle(spark):
    plan = latest_per_key(frame(spark, [(1, "a", 1)]), ["id"], "ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    below_exchange = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


STATE = [
    (1, "old", 5), (2, "old", 5), (3, "old", 5), (4, "old", None), (5, "old", 1), (7, "old", 9),
]
BATCH = [
    (1, "new", 6), (2, "new", 5), (3, "new", 4), (4, "new", None), (5, "new", None), (6, "new", 1),
]
MERGED = expected(
    (1, "new", 6), (2, "new", 5), (3, "old", 5), (4, "new", None), (5, "old", 1), (6, "new", 1),
    (7, "old", 9),
)

STRATEGIES = {
    "union": lambda s, b: merge.merge_latest(s, b, ["id"], "ts"),
    "broadcast": lambda s, b: merge.merge_into_state(s, b, ["id"], "ts"),
    "shuffle": lambda s, b: merge.merge_into_state(s, b, ["id"], "ts", broadcast_limit=0),
}


@pytest.mark.parametrize("name", STRATEGIES)
def test_merge(spark, name):
    apply = STRATEGIES[name]
    state, batch = frame(spark, STATE), frame(spark, BATCH)
    merged = apply(state, batch)
    assert merged.columns == state.columns
    assert values(merged) == MERGED
    assert values(apply(merged, batch)) == MERGED


@pytest.mark.parametrize("name", STRATEGIES)
def test_merge_of_a_null_key_and_empty_sides(spark, name):
    apply = STRATEGIES[name]
    state, batch = frame(spark, [(None, "old", 1)]), frame(spark, [(None, "new", 2)])
    assert values(apply(state, batch)) == expected((None, "new", 2))
    nothing = frame(spark, [])
    assert values(apply(state, nothing)) == expected((None, "old", 1))
    assert values(apply(nothing, batch)) == expected((None, "new", 2))
    assert values(apply(None, batch)) == expected((None, "new", 2))


@pytest.mark.parametrize("name", STRATEGIES)
def test_random_merges_agree_and_do_not_depend_on_their_order(spark, name):
    rng = random.Random(7)
    batches = []
    for b in range(3):
        keys = [k for k in range(20) if rng.random() < 0.6]
        rows = [(k, f"b{b}", rng.choice([None, *range(12)])) for k in keys]
        batches.append(rows)
    flat = [row for rows in batches for row in rows]
    best = {}
    for k, v, m in flat:
        rank = (m is not None, m if m is not None else 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, v, m))
    want = expected(*[row for _, row in best.values()])
    state = None
    for rows in batches:
        state = STRATEGIES[name](state, frame(spark, rows))
    assert values(state) == want


def test_state_is_not_shuffled_for_a_small_batch(spark, root):
    frame(spark, STATE).write.parquet(root + "/s")
    frame(spark, BATCH).write.parquet(root + "/b")
    state, batch = spark.read.parquet(root + "/s"), spark.read.parquet(root + "/b")
    merged = merge.merge_into_state(state, batch, ["id"], "ts")
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", STRATEGIES)
def test_merge_rejects_other_columns(spark, name):
    with pytest.raises(Exception):
        STRATEGIES[name](
            frame(spark, STATE), frame(spark, BATCH).withColumn("extra", F.lit(1))
        ).collect()


def test_insert_if_absent(spark):
    existing = frame(spark, [(1, "old", 1)])
    batch = frame(spark, [(1, "new", 9), (2, "b", 2), (2, "a", 1)])
    got = merge.insert_if_absent(existing, batch, ["id"], [F.col("v")])
    assert values(got) == expected((1, "old", 1), (2, "a", 1))


def test_upsert_takes_the_incoming_row_even_if_older(spark):
    got = merge.upsert_by_key(
        frame(spark, [(1, "old", 9), (2, "old", 9)]), frame(spark, [(1, "new", 1)]), ["id"]
    )
    assert values(got) == expected((1, "new", 1), (2, "old", 9))


def test_update_by_key(spark):
    existing = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, v string, n int")
    patches = spark.createDataFrame([(1, None), (3, 5)], "id int, n long")
    got = merge.update_by_key(existing, patches, ["id"], ["n"])
    assert got.schema == existing.schema
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, "b", 20)]


def test_append_checks_keys_first(spark, root):
    path = root + "/t"
    frame(spark, [(1, "a", 1)]).write.parquet(path)
    merge.append_batch(frame(spark, [(2, "b", 2)]), path, ["id"])
    assert spark.read.parquet(path).count() == 2
    for bad in ([(2, "c", 3)], [(3, "c", 3), (3, "d", 3)]):
        with pytest.raises(merge.DuplicateKeyError):
            merge.append_batch(frame(spark, bad), path, ["id"])
    assert spark.read.parquet(path).count() == 2
