"""Cases in which results once depended on sizes, ages or the order of writers."""

from __future__ import annotations

import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge, star
from tidemark.operators.sizing import BROADCAST_LIMIT
from tidemark.sources import bronze, snapshots, storage
from tidemark.streaming.ingest import read_files

LIMITS = [0, BROADCAST_LIMIT]


@pytest.mark.parametrize("limit", LIMITS)
def test_revenue_rounds_each_sale(spark, limit):
    products = spark.sql("SELECT 1 product_id, CAST(1.115 AS DECIMAL(10,3)) unit_price, 'A' product_category")
    orders = spark.sql(
        "SELECT id order_id, 1 product_id, q quantity, TIMESTAMP'2026-01-01' updated_at "
        "FROM VALUES (1, 3), (2, 1), (3, 1) AS t(id, q)"
    )
    row = star.daily_category_sales_from_orders(orders, products, limit).first()
    assert (row.total_revenue, row.total_orders) == (Decimal("5.59"), 3)


@pytest.mark.parametrize("limit", LIMITS)
def test_state_that_repeats_a_key_merges_alike(spark, limit):
    state = spark.createDataFrame([(1, "old", 1), (1, "old2", 1), (2, "x", 9)], "id int, v string, ts int")
    batch = spark.createDataFrame([(1, "new", 2), (2, "late", 3)], "id int, v string, ts int")
    rows = merge.merge_into_state(state, batch, ["id"], "ts", broadcast_limit=limit).collect()
    assert sorted(map(tuple, rows)) == [(1, "new", 2), (2, "x", 9)]


def test_repeated_patches_never_add_rows(spark):
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    patches = spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string")
    assert [tuple(r) for r in merge.update_by_key(rows, patches, ["id"], ["v"]).collect()] == [(1, "c")]
    assert [tuple(r) for r in merge.upsert_by_key(rows, patches, ["id"]).collect()] == [(1, "c")]


def test_stream_takes_files_with_old_stamps(spark, root):
    folder, seen = f"{root}/in", []
    schema = spark.range(1).schema
    for key, days in ((1, 0), (2, 30), (3, 0)):
        spark.range(key, key + 1, numPartitions=1).write.mode("append").parquet(folder)
        if days:
            for name in os.listdir(folder):
                full = f"{folder}/{name}"
                if name.endswith(".parquet") and full not in seen:
                    os.utime(full, (time.time() - days * 86400,) * 2)
        seen += [f"{folder}/{n}" for n in os.listdir(folder)]
        stream = read_files(spark, folder, schema)
        stream.writeStream.format("parquet").option("checkpointLocation", f"{root}/log").trigger(
            availableNow=True
        ).start(f"{root}/out").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


def test_one_of_two_interleaved_drafts_wins(spark, root, monkeypatch):
    table = f"{root}/t"
    snapshots.replace(spark.range(1), table)
    second = snapshots.write_draft(spark.range(2), table)
    third = snapshots.write_draft(spark.range(3), table)
    marked = storage.create_marker

    def delayed(session, path):
        monkeypatch.setattr(storage, "create_marker", marked)
        with pytest.raises(snapshots.ConcurrentWriteError):
            snapshots.publish(session, table, third, based_on=1)
        return marked(session, path)

    monkeypatch.setattr(storage, "create_marker", delayed)
    snapshots.publish(spark, table, second, based_on=1)
    assert snapshots.read_current(spark, table).count() == 2
    assert snapshots.replace(spark.range(4), table) == 4


def test_batch_without_success_is_refused(spark, root):
    assert bronze.read_run(spark, f"{root}/none") is None
    os.makedirs(f"{root}/half")
    with pytest.raises(bronze.IncompleteBatchError):
        bronze.read_run(spark, f"{root}/half")


def test_null_sides_survive_the_splits(spark, root):
    from tidemark.plans.queries import QUERIES

    source = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    for name in ("orders", "lineitem", "events"):
        column = {"orders": "o_orderstatus", "lineitem": "l_shipdate", "events": "ts"}[name]
        key = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "user_id"}[name]
        df = spark.read.parquet(f"{source}/{name}.parquet")
        new = df.limit(1).withColumn(column, F.lit(None).cast(df.schema[column].dataType)).withColumn(
            key, F.lit(-7).cast("long")
        )
        df.unionByName(new).write.parquet(f"{root}/{name}.parquet")
    for name, key in (("silver_merge", "l_orderkey"), ("append_new_keys", "o_orderkey"), ("watermark_upsert", "user_id")):
        assert QUERIES[name](spark, root).filter(F.col(key) == -7).count() == 1, name
