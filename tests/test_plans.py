from __future__ import annotations

import dataclasses
import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import CUSTOMERS, ECOMMERCE, ORDERS, PRODUCTS
from tidemark.operators import star
from tidemark.operators.audit import ReconciliationError
from tidemark.operators.quality import MissingColumnsError, YieldBelowTolerance
from tidemark.plans import extract, gold, promote
from tidemark.plans.layout import Warehouse
from tidemark.plans.refresh import refresh
from tidemark.sources import bronze, ledger, snapshots, state, storage
from tidemark.streaming.ingest import merge_available, read_files


def at(minute):
    return datetime.datetime(2026, 1, 1, 0, minute)


def products(spark, *rows):
    return spark.createDataFrame(
        [(i, f"p{i}", Decimal(price), "Books", 5, at(m)) for i, price, m in rows], PRODUCTS.schema
    )


def customers(spark, *rows):
    return spark.createDataFrame(
        [(i, "A", "B", f"c{i}@x", "Y", at(m)) for i, m in rows], CUSTOMERS.schema
    )


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, c, p, q, Decimal("10.00"), at(m)) for i, c, p, q, m in rows], ORDERS.schema
    )


@pytest.fixture
def warehouse(root):
    return Warehouse(root)


def saved_state(spark, warehouse, table):
    known = state.last_runs(spark, warehouse.state, warehouse.pipeline)
    return known.get(table, state.NEVER_RUN)


def extract_one(df, contract, warehouse, run_id, raw=extract.RawFormat()):
    return extract.extract_tables(
        df.sparkSession, {contract.name: df}, [contract], warehouse, run_id, raw
    )[0]


def promote_one(spark, contract, warehouse, run_id, fmt="parquet"):
    return promote.promote_tables(spark, [contract], warehouse, run_id, fmt)[0]


def silver(spark, warehouse, contract):
    return snapshots.read_current(spark, warehouse.silver(contract.name))


def sources(spark, p, c, o):
    return {
        PRODUCTS.name: products(spark, *p),
        CUSTOMERS.name: customers(spark, *c),
        ORDERS.name: orders(spark, *o),
    }


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_two_runs(spark, warehouse, fmt):
    raw = extract.RawFormat(fmt, ordered=fmt == "csv")
    first = sources(
        spark,
        [(1, "2.50", 1), (2, "4.00", 1)],
        [(1, 1)],
        [(1, 1, 1, 2, 1), (2, 1, 9, 1, 2)],
    )
    done = refresh(spark, first, ECOMMERCE, warehouse, "a", raw)
    assert [e.rows for e in done.extractions] == [2, 1, 2]
    assert done.gold.status == gold.PUBLISHED and done.gold.rows == 2

    # Product 1 is repriced, order 2 changes, order 3 is new, customers rest.
    second = sources(
        spark,
        [(1, "3.00", 5), (2, "4.00", 1)],
        [(1, 1)],
        [(1, 1, 1, 2, 1), (2, 1, 2, 3, 6), (3, 1, 1, 1, 7)],
    )
    done = refresh(spark, second, ECOMMERCE, warehouse, "b", raw)
    assert [e.status for e in done.extractions] == [
        state.SUCCESS, extract.NOTHING_NEW, state.SUCCESS,
    ]
    assert [p.status for p in done.promotions] == [
        promote.PUBLISHED, promote.NO_BATCH, promote.PUBLISHED,
    ]
    assert [e.rows for e in done.extractions] == [1, 0, 2]
    assert not storage.exists(spark, bronze.run_path(warehouse.root, CUSTOMERS.name, "b"))
    fact = {r.order_id: r for r in gold.read_gold(spark, warehouse, gold.FACT).collect()}
    # Dimension values are current, so the new price also applies to order 1.
    assert {k: r.net_sales for k, r in fact.items()} == {
        1: Decimal("6.00"), 2: Decimal("12.00"), 3: Decimal("3.00"),
    }
    sales = gold.read_gold(spark, warehouse, gold.DAILY_SALES).collect()
    assert [tuple(r) for r in sales] == [(datetime.date(2026, 1, 1), "Books", Decimal("21.00"), 3)]
    assert promote.pending_runs(spark, warehouse).isEmpty()


def test_repeated_run_changes_nothing(spark, warehouse):
    data = sources(spark, [(1, "1.00", 1)], [(1, 1)], [(1, 1, 1, 1, 1)])
    refresh(spark, data, ECOMMERCE, warehouse, "a")
    before = silver(spark, warehouse, ORDERS).collect()
    # Rows that arrived meanwhile wait for the next run and do not displace the
    # batch this run has written.
    data[ORDERS.name] = orders(spark, (1, 1, 1, 1, 1), (2, 1, 1, 1, 9))
    again = refresh(spark, data, ECOMMERCE, warehouse, "a")
    assert {e.status for e in again.extractions} == {extract.ALREADY_DONE}
    assert silver(spark, warehouse, ORDERS).collect() == before
    refresh(spark, data, ECOMMERCE, warehouse, "b")
    assert silver(spark, warehouse, ORDERS).count() == 2


def test_empty_source_is_skipped(spark, warehouse):
    got = extract_one(products(spark), PRODUCTS, warehouse, "a")
    assert got.status == extract.EMPTY_SOURCE
    assert not storage.exists(spark, bronze.run_path(warehouse.root, PRODUCTS.name, "a"))
    assert saved_state(spark, warehouse, PRODUCTS.name) == state.LastRun(0)
    assert promote_one(spark, PRODUCTS, warehouse, "a").status == promote.NO_BATCH
    assert gold.build_gold(spark, warehouse, "a").status == gold.SKIPPED


def test_empty_batch_is_skipped(spark, warehouse):
    path = bronze.run_path(warehouse.root, PRODUCTS.name, "a")
    bronze.write_run(products(spark), path)
    assert promote_one(spark, PRODUCTS, warehouse, "a").status == promote.EMPTY_BATCH


def test_failed_extraction_keeps_the_watermark(spark, warehouse):
    extract_one(products(spark, (1, "1.00", 1)), PRODUCTS, warehouse, "a")
    mark = saved_state(spark, warehouse, PRODUCTS.name).watermark
    with pytest.raises(ValueError):
        extract_one(
            products(spark, (2, "1.00", 2)), PRODUCTS, warehouse, "b", extract.RawFormat("unknown")
        )
    failed = saved_state(spark, warehouse, PRODUCTS.name)
    assert failed.watermark == mark and failed.status.startswith("FAILED: unknown raw format")
    extract_one(products(spark, (2, "1.00", 2)), PRODUCTS, warehouse, "b")
    assert saved_state(spark, warehouse, PRODUCTS.name).status == state.SUCCESS


def test_quarantine_metrics_and_duplicates(spark, warehouse):
    rows = [(i, "1.00", 1) for i in range(1, 30)] + [(1, "2.00", 2), (99, "0.00", 1)]
    extract_one(products(spark, *rows), PRODUCTS, warehouse, "a")
    done = promote_one(spark, PRODUCTS, warehouse, "a")
    assert done.metrics["metrics"] == {
        "input_records_extracted": 31,
        "clean_records_promoted": 29,
        "quarantined_records_isolated": 1,
        "duplicate_records_purged": 1,
        "data_health_yield_percentage": 93.55,
    }
    kept = {r.product_id: r.price for r in silver(spark, warehouse, PRODUCTS).collect()}
    assert len(kept) == 29 and kept[1] == Decimal("2.00")
    rejected = spark.read.parquet(warehouse.quarantine(PRODUCTS.name, "a")).collect()
    assert [(r.product_id, list(r.validation_errors)) for r in rejected] == [
        (99, ["negative_or_zero_price"])
    ]
    logged = [json.loads(r.value) for r in spark.read.text(warehouse.metrics).collect()]
    assert logged == [done.metrics]


def test_low_yield_stops_before_the_state_but_keeps_the_evidence(spark, warehouse):
    extract_one(products(spark, (1, "1.00", 1)), PRODUCTS, warehouse, "a")
    promote_one(spark, PRODUCTS, warehouse, "a")
    bad = products(spark, (2, "1.00", 2), (3, "0.00", 2))
    extract_one(bad, PRODUCTS, warehouse, "b")
    with pytest.raises(YieldBelowTolerance, match="50.0"):
        promote_one(spark, PRODUCTS, warehouse, "b")
    assert [r.product_id for r in silver(spark, warehouse, PRODUCTS).collect()] == [1]
    assert spark.read.parquet(warehouse.quarantine(PRODUCTS.name, "b")).count() == 1
    # The watermark has moved on, but the batch is still known and replayable.
    pending = promote.pending_runs(spark, warehouse)
    assert [tuple(r) for r in pending.collect()] == [("b", PRODUCTS.name)]
    lenient = dataclasses.replace(PRODUCTS, rules={})
    assert [p.status for p in promote.promote_pending(spark, [lenient], warehouse)["b"]] == [
        promote.PUBLISHED
    ]
    assert silver(spark, warehouse, PRODUCTS).count() == 3
    assert promote.promote_pending(spark, [lenient], warehouse) == {}


def test_one_failing_table_does_not_hold_up_the_others(spark, warehouse):
    data = sources(spark, [(1, "0.00", 1)], [(1, 1)], [(1, 1, 1, 1, 1)])
    with pytest.raises(YieldBelowTolerance):
        refresh(spark, data, ECOMMERCE, warehouse, "a")
    assert silver(spark, warehouse, PRODUCTS) is None
    assert silver(spark, warehouse, ORDERS).count() == 1
    assert gold.build_gold(spark, warehouse, "a").status == gold.SKIPPED


def test_malformed_text_is_quarantined(spark, warehouse):
    path = bronze.run_path(warehouse.root, ORDERS.name, "a")
    text = orders(spark, *[(i, 1, 1, 1, 1) for i in range(20)]).select(
        *[F.col(c).cast("string") for c in ORDERS.columns]
    )
    broken = text.withColumn(
        "quantity", F.when(F.col("order_id") == "3", "many").otherwise(F.col("quantity"))
    )
    bronze.write_run(broken, path, "csv")
    done = promote_one(spark, ORDERS, warehouse, "a", "csv")
    assert done.metrics["failures_by_rule_breakdown"]["invalid_quantity"] == 1
    assert silver(spark, warehouse, ORDERS).schema == ORDERS.schema


def test_missing_column_stops_the_run(spark, warehouse):
    path = bronze.run_path(warehouse.root, ORDERS.name, "a")
    bronze.write_run(orders(spark, (1, 1, 1, 1, 1)).drop("quantity"), path, "csv")
    with pytest.raises(MissingColumnsError, match="quantity"):
        promote_one(spark, ORDERS, warehouse, "a", "csv")


def test_audit_stops_gold_before_it_is_visible(spark, warehouse):
    one = sources(spark, [(1, "1.00", 1)], [(1, 1)], [(1, 1, 1, 1, 1)])
    refresh(spark, one, ECOMMERCE, warehouse, "a")
    assert gold.build_gold(spark, warehouse, "a2").status == gold.UNCHANGED
    before = snapshots.current_version(spark, warehouse.gold)
    doubled = silver(spark, warehouse, PRODUCTS)
    snapshots.replace(doubled.unionAll(doubled), warehouse.silver(PRODUCTS.name))
    with pytest.raises(ReconciliationError):
        gold.build_gold(spark, warehouse, "b")
    assert snapshots.current_version(spark, warehouse.gold) == before
    assert gold.read_gold(spark, warehouse, gold.FACT).count() == 1


def test_key_checks_of_the_fact(spark, warehouse):
    data = sources(spark, [(1, "1.00", 1)], [(1, 1)], [(1, 1, 1, 1, 1), (2, 1, 1, 1, 1)])
    refresh(spark, data, ECOMMERCE, warehouse, "a")
    table = warehouse.silver(ORDERS.name)
    good = silver(spark, warehouse, ORDERS)
    for broken in (good.unionAll(good), good.withColumn("order_id", F.lit(None).cast("int"))):
        snapshots.replace(broken, table)
        with pytest.raises(ReconciliationError):
            gold.build_gold(spark, warehouse, "b", check_keys=True)
    snapshots.replace(good, table)
    assert gold.build_gold(spark, warehouse, "c", check_keys=True).status == gold.PUBLISHED


def test_fact_is_partitioned_and_pruned(spark, warehouse):
    rows = [(i, 1, 1, 1, 1) for i in range(1, 4)]
    data = sources(spark, [(1, "1.00", 1)], [(1, 1)], rows)
    data[ORDERS.name] = data[ORDERS.name].withColumn(
        "updated_at", F.col("updated_at") + F.make_dt_interval(F.col("order_id"))
    )
    refresh(spark, data, ECOMMERCE, warehouse, "a")
    fact = gold.read_gold(spark, warehouse, gold.FACT)
    days = fact.filter(F.col("order_date") == F.lit("2026-01-03").cast("date"))
    assert [r.order_id for r in days.collect()] == [2]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan


def test_days_of_a_large_fact_can_be_split(spark):
    df = spark.range(100).select(F.lit("2026-01-01").cast("date").alias("order_date"), "id")

    plan = star.by_day(df)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_missing_date_goes_to_the_default_partition(spark, root):
    rows = [(1, None), (2, datetime.date(2026, 1, 1))]
    df = spark.createDataFrame(rows, "id int, order_date date")
    snapshots.replace(df, root + "/t", ["order_date"])
    assert "order_date=__HIVE_DEFAULT_PARTITION__" in storage.child_folders(spark, root + "/t/v=1")
    back = snapshots.read_current(spark, root + "/t", df.schema)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_run_report(spark, warehouse):
    data = sources(spark, [(1, "1.00", 1)], [(1, 1)], [(1, 1, 1, 1, 1)])
    refresh(spark, data, ECOMMERCE, warehouse, "a")
    report = ledger.run_summary(ledger.read(spark, warehouse.ledger)).collect()
    rows = {r.table_name: r for r in report}
    assert rows[ORDERS.name].extracted_rows == rows[ORDERS.name].silver_rows == 1
    assert rows[ORDERS.name].discrepancy == 0
    assert rows[gold.FACT].gold_rows == 1
    assert all(r.duration_seconds > 0 for r in report)


def test_snapshots(spark, root):
    table = root + "/t"
    assert snapshots.read_current(spark, table) is None
    assert snapshots.replace(spark.range(1), table) == 1
    draft = snapshots.write_draft(spark.range(2), table)
    assert snapshots.read_current(spark, table).count() == 1
    snapshots.publish(spark, table, draft)
    assert snapshots.read_current(spark, table).count() == 2
    with pytest.raises(snapshots.ConcurrentWriteError):
        snapshots.publish(spark, table, draft)
    # A table can be rebuilt from itself.
    mine = snapshots.read_current(spark, table)
    snapshots.replace(mine.unionAll(mine), table)
    assert snapshots.read_current(spark, table).count() == 4
    abandoned = snapshots.write_draft(spark.range(9), table)
    assert snapshots.replace(spark.range(5), table) == abandoned + 1
    assert snapshots.retire(spark, table, keep=2) == [1, 2, 4]
    assert snapshots.read_current(spark, table).count() == 5
    assert snapshots.retire(spark, root + "/none") == []


def test_a_draft_that_would_undo_another_jobs_work_is_refused(spark, root):
    snapshots.replace(spark.range(1), root, based_on=0)
    late = snapshots.write_draft(spark.range(2), root)
    snapshots.replace(spark.range(3), root, based_on=1)
    with pytest.raises(snapshots.ConcurrentWriteError):
        snapshots.publish(spark, root, late)
    with pytest.raises(snapshots.ConcurrentWriteError):
        snapshots.replace(spark.range(4), root, based_on=1)
    assert snapshots.read_current(spark, root).count() == 3


def test_watermark_lookup_and_history(spark, root):
    state.record(spark, root, "p", "r1", [("t", 5, state.SUCCESS), ("u", 7, state.SUCCESS)])
    state.record(spark, root, "p", "r2", [("t", 3, state.failed("x"))])
    state.record(spark, root, "p", "r3", [])
    assert state.last_runs(spark, root, "p") == {
        "t": state.LastRun(3, "FAILED: x", "r2"),
        "u": state.LastRun(7, state.SUCCESS, "r1"),
    }
    assert state.last_runs(spark, root, "other") == {}
    stored = snapshots.read_current(spark, root, state.STATE_SCHEMA)
    assert state.find_watermark(stored, "p", "u").first()[0] > datetime.datetime(1970, 1, 1)
    assert state.find_watermark(stored, "p", "w").first()[0] == datetime.datetime(1970, 1, 1)


def test_stream_equals_batch(spark, root):
    source, table = root + "/in", root + "/out"
    early = orders(spark, (1, 1, 1, 1, 1), (2, 1, 1, 1, 5))
    late = orders(spark, (1, 1, 1, 7, 3), (2, 1, 1, 7, 4), (3, 1, 1, 1, 1))
    for batch in (early, late, late.limit(0)):
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = read_files(spark, source, ORDERS.schema)
        merge_available(stream, table, ORDERS, root + "/log", keep_versions=1).awaitTermination()
    rows = snapshots.read_current(spark, table).collect()
    assert storage.child_folders(spark, table) == ["v=2"]
    got = {r.order_id: (r.quantity, r.updated_at) for r in rows}
    assert got == {1: (7, at(3)), 2: (1, at(5)), 3: (1, at(1))}


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")
