"""State by buckets, the star schema by changed days, lost rows, and what a run leaves behind."""

from __future__ import annotations

import dataclasses
import datetime
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.contracts import CUSTOMERS, ECOMMERCE, ORDERS, PRODUCTS
from tidemark.functions.casting import CAST_FAILED, cast_to_schema
from tidemark.functions.rules import tag_failures
from tidemark.operators import audit, merge, numbering, quality, reconcile, star
from tidemark.operators.latest import latest_per_key
from tidemark.plans import extract, gold, promote, verify, versions
from tidemark.plans.layout import Warehouse
from tidemark.plans.refresh import refresh
from tidemark.sources import bronze, keyed, snapshots, storage

START = datetime.datetime(2026, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def at(day, minute=0):
    return START + datetime.timedelta(days=day, minutes=minute)


def products(spark, rows):
    return spark.createDataFrame(
        [(i, f"p{i}", Decimal(price), category, 5, at(m)) for i, price, category, m in rows], PRODUCTS.schema
    )


def customers(spark, rows):
    return spark.createDataFrame([(i, "A", "B", f"c{i}@x", city, at(m)) for i, city, m in rows], CUSTOMERS.schema)


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, c, p, q, Decimal("10.00"), at(d, m)) for i, c, p, q, d, m in rows], ORDERS.schema
    )


@pytest.fixture
def warehouse(root):
    return Warehouse(root)


# --- state by buckets ----------------------------------------------------------------

SCHEMA = "id int, v string, ts timestamp"


def test_a_merge_shuffles_the_batch_alone(spark, root):
    rows = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.lit("a").alias("v"), F.lit(at(1)).alias("ts"))
    versions.merge_and_publish(rows, root, ["id"], "ts")
    state = versions.read_state(spark, root, 1)
    batch = spark.createDataFrame([(5, "b", at(2))], SCHEMA)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = merge.changes_to(state, batch, ["id"], "ts")
        stored = storage.materialise(changes, "changes")
        for df in (
            changes, merge.apply_changes(state, stored, ["id"]), merge.merge_keyed(state, batch, ["id"], "ts", "_new"),
        ):
            text = plan(df)
            assert "Bucketed: true" in text and text.count("Exchange") == 1
            # The exchange stands above the batch: what the state's side has is a sort at most.
            scan = next(x for x in text.split("\n") if "Bucketed: true" in x)
            above = text.split("\n")[: text.split("\n").index(scan)]
            assert "Exchange" not in above[-1] and "Exchange" not in above[-2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("per_bucket", [3, 1_000_000])
def test_merges_and_their_changes(spark, root, monkeypatch, per_bucket):
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", per_bucket)
    rng = random.Random(per_bucket)
    everything, states = [], [{}]
    for turn in range(4):
        rows = {k: (k, rng.choice("xyz"), at(rng.randint(0, 3))) for k in rng.sample(range(30), 12)}
        everything.append(spark.createDataFrame(list(rows.values()), SCHEMA))
        version = versions.merge_and_publish(everything[-1], root, ["id"], "ts", keep_changes=True)
        state = dict(states[-1])
        for k, row in rows.items():
            if k not in state or row[2] >= state[k][2]:
                state[k] = row
        states.append(state)
        assert version == turn + 1
        # The same without keeping the changes, in one join.
        other = root + "/other"
        assert versions.merge_and_publish(everything[-1], other, ["id"], "ts") == turn + 1
        assert {r["id"]: tuple(r) for r in snapshots.read_current(spark, other).collect()} == state
    assert versions.merge_and_publish(everything[-1], root + "/other", ["id"], "ts") == 4
    stored = versions.read_state(spark, root, 4)
    assert {r["id"]: tuple(r) for r in stored.collect()} == states[-1]
    files = [f for f in os.listdir(f"{root}/v=4") if f.startswith("part-")]
    assert len(files) == keyed.layout(spark, f"{root}/v=4").count == (8 if per_bucket == 3 else 1)
    changed = versions.changes_between(spark, root, ["id"], 2, 4)
    got = {r["after"]["id"]: (r["before"] and tuple(r["before"]), tuple(r["after"])) for r in changed.collect()}
    differing = {k for k in states[4] if states[4][k] != states[2].get(k)}
    # A key that went back to what it was is listed, with nothing changed.
    assert differing <= got.keys()
    assert all(got[k] == (states[2].get(k), states[4][k]) for k in got)
    assert versions.changes_between(spark, root, ["id"], 4, 4).count() == 0
    # Repeating a batch changes nothing and publishes nothing.
    assert versions.merge_and_publish(everything[-1], root, ["id"], "ts", keep_changes=True) == 4
    versions.forget_changes(spark, root, 3)
    assert versions.changes_between(spark, root, ["id"], 2, 4) is None
    assert versions.changes_between(spark, root, ["id"], 3, 4) is not None


def test_null_keys_merge_as_before(spark, root):
    for v, minute in (("old", 1), ("new", 2)):
        batch = spark.createDataFrame([(None, v, at(minute)), (1, v, at(minute))], SCHEMA)
        versions.merge_and_publish(batch, root, ["id"], "ts", keep_changes=True)
    rows = snapshots.read_current(spark, root).collect()
    assert sorted(((r["id"] or 0, r["v"]) for r in rows)) == [(0, "new"), (1, "new")]
    assert versions.changes_between(spark, root, ["id"], 1, 2) is None


# --- the star schema by changed days -------------------------------------------------


class Shop:
    """Source tables that change from run to run, and what the star schema should hold."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.products = {i: (i, f"{i}.50", "Books", 0) for i in range(1, 6)}
        self.customers = {i: (i, "Y", 0) for i in range(1, 4)}
        # Products 6 and 7 are sold before they are known.
        self.orders = {i: (i, 1 + i % 3, 1 + i % 7, 1 + i % 4, i % 10, 0) for i in range(1, 41)}

    def change(self, turn: int) -> None:
        rng, day = self.rng, 20 + turn
        for i in rng.sample(sorted(self.orders), 3):
            _, c, p, _, _, _ = self.orders[i]
            self.orders[i] = (i, c, p, rng.randint(1, 9), day, turn)
        new = max(self.orders) + 1
        self.orders[new] = (new, 9, rng.randint(1, 8), 2, day, turn)
        if turn == 1:
            self.products[1] = (1, "99.00", "Books", turn)
            self.products[2] = (2, "2.50", "Beauty", turn)
        if turn == 2:
            self.products[6] = (6, "6.00", "Apparel", turn)
            self.customers[2] = (2, "Z", turn)

    def sources(self, spark):
        return {
            PRODUCTS.name: products(spark, list(self.products.values())),
            CUSTOMERS.name: customers(spark, list(self.customers.values())),
            ORDERS.name: orders(spark, list(self.orders.values())),
        }


def _facts(df):
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def test_builds_from_changes_equal_whole_builds(spark, warehouse):
    shop = Shop(7)
    files, previous = {}, None
    for turn in range(4):
        if turn:
            shop.change(turn)
        done = refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, f"r{turn}", keep_versions=2)
        assert (done.gold.days is None) == (turn == 0) and done.gold.rows == len(shop.orders)
        silver = [snapshots.read_current(spark, warehouse.silver(c.name)) for c in ECOMMERCE]
        whole = star.order_fact(silver[2], star.product_dimension(silver[0]), star.customer_dimension(silver[1]))
        assert _facts(gold.read_gold(spark, warehouse, gold.FACT)) == _facts(whole)
        assert _facts(gold.read_gold(spark, warehouse, gold.DAILY_SALES)) == _facts(star.daily_category_sales(whole))
        assert _facts(gold.read_gold(spark, warehouse, gold.DIM_PRODUCTS)) == _facts(star.product_dimension(silver[0]))
        # Days nothing has touched are still in the files they were in.
        now: dict = {}
        for r in gold.read_gold(spark, warehouse, gold.FACT).select("order_date", F.input_file_name().alias("f")).collect():
            now.setdefault(r["order_date"], set()).add(r["f"])
        for day, names in files.items():
            if day in now and done.gold.days is not None:
                assert (now[day] == names) == (day not in done.gold.days), day
        if turn == 3:
            # Only orders have changed: few days, and the dimensions are those of the build before.
            assert len(done.gold.days) < len(now)
            assert now != files and previous is not None
        previous, files = done, now
    # No version holds the first run's parts any more, and no part is without a version.
    builds = {int(b.removeprefix("build=")) for b in storage.child_folders(spark, warehouse.gold_part(gold.DIM_CUSTOMERS))}
    assert builds == {3}
    assert storage.child_folders(spark, warehouse.gold) == ["v=3", "v=4"] or set(
        storage.child_folders(spark, warehouse.gold)
    ) == {"v=3", "v=4"}
    assert gold.build_gold(spark, warehouse, "again").status == gold.UNCHANGED
    # Without the changes of a version all days are built, to the same rows.
    shop.change(9)
    extract.extract_tables(spark, shop.sources(spark), ECOMMERCE, warehouse, "r9")
    promote.promote_tables(spark, ECOMMERCE, warehouse, "r9")
    versions.forget_changes(spark, warehouse.silver(ORDERS.name), 99)
    built = gold.build_gold(spark, warehouse, "r9")
    assert built.days is None and built.rows == len(shop.orders)


@pytest.mark.parametrize("most", [0.0, 2.0])
def test_touched_days_from_the_table_or_from_their_files(spark, warehouse, monkeypatch, most):
    monkeypatch.setattr(gold, "_MOST", most)
    shop, reads, read_fact = Shop(11), [], gold._read_fact
    monkeypatch.setattr(gold, "_read_fact", lambda *args: reads.append(args) or read_fact(*args))
    for turn in range(4):
        if turn:
            shop.change(turn)
        reads.clear()
        done = refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, f"r{turn}", keep_versions=1)
        # The base's folders are listed once, however many tables have changed, or not at all.
        searched = turn in (1, 2)
        assert len(reads) == (0 if turn == 0 else 1 if searched or most else 0)
        assert (done.gold.days is None) == (turn == 0)
        silver = [snapshots.read_current(spark, warehouse.silver(c.name)) for c in ECOMMERCE]
        whole = star.order_fact(silver[2], star.product_dimension(silver[0]), star.customer_dimension(silver[1]))
        assert _facts(gold.read_gold(spark, warehouse, gold.FACT)) == _facts(whole)
        assert _facts(gold.read_gold(spark, warehouse, gold.DAILY_SALES)) == _facts(star.daily_category_sales(whole))


def test_a_build_notices_rows_its_changes_do_not_explain(spark, warehouse, monkeypatch):
    shop = Shop(5)
    refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, "r0")
    shop.change(1)
    by_day = star.by_day
    monkeypatch.setattr(star, "by_day", lambda fact: by_day(fact.withColumn("quantity", F.col("quantity") + F.lit(1))))
    with pytest.raises(audit.ReconciliationError):
        refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, "r1")


def test_digests_add_up(spark):
    rows = spark.createDataFrame([(i % 3, i, None if i % 7 == 0 else str(i)) for i in range(60)], "d int, a int, b string")
    names = ["rows", "hash_sum", "hash_xor"]
    old, gone, come = rows.filter("a < 50"), rows.filter("a < 20"), rows.filter("a >= 50")
    digests = [df.groupBy("d").agg(*audit.digest(["a", "b"])).select(*names) for df in (old, gone, come)]
    due = digests[0].unionByName(audit.taken_away(digests[1])).unionByName(digests[2]).agg(*audit.added_up())
    now = rows.filter("a >= 20").agg(*audit.digest(["a", "b"]))
    assert due.schema.simpleString() == now.schema.simpleString() and due.first() == now.first()
    assert audit.require_content(audit.digest_audit(due, now)) == 40
    with pytest.raises(audit.ReconciliationError):
        audit.require_content(audit.digest_audit(due, rows.agg(*audit.digest(["a", "b"]))))
    assert tuple(digests[0].limit(0).agg(*audit.added_up()).first()) == (0, 0, 0)


def test_signed_deltas_of_sales(spark):
    schema = "order_id int, product_category string, net_sales decimal(10,2), order_date date"
    rng, day = random.Random(3), START.date()

    def row(i):
        price = rng.choice([None, Decimal("1.25"), Decimal("-3.00"), Decimal("0.00")])
        return (rng.choice([i, None]), rng.choice("AB"), price, rng.choice([day, None, day + datetime.timedelta(1)]))

    old = [row(i) for i in range(30)]
    removed, kept = old[:12], old[12:]
    added = [row(100 + i) for i in range(5)]
    frame = lambda rows: spark.createDataFrame(rows, schema)
    got = star.apply_sales_delta(star.sales_parts(frame(old)), frame(removed), frame(added))
    assert got.dtypes == star.sales_parts(frame(old)).dtypes
    assert _facts(got) == _facts(star.sales_parts(frame(kept + added)))
    # All rows of the table gone: no group is left.
    assert star.apply_sales_delta(star.sales_parts(frame(old)), frame(old), frame(old).limit(0)).count() == 0


# --- audits and lost rows ------------------------------------------------------------


def test_a_swapped_row_is_caught(spark):
    rows = [(i, i * 2, None if i % 5 else i) for i in range(100)]
    source = spark.createDataFrame(rows, "a int, b int, c int")
    swapped = rows.copy()
    swapped[3] = (3, 6, 4)
    for other, same in ((rows[::-1], True), (swapped, False), (rows[:99] + rows[:1], False),
                        ([(a, c, b) for a, b, c in rows], False)):
        audited = audit.content_audit(source, spark.createDataFrame(other, "a int, b int, c int"), ["a", "b", "c"])
        row = audited.first()
        assert (row["silver_rows"], row["gold_rows"], row["discrepancy"], row["same_content"]) == (100, 100, 0, same)
        if same:
            assert audit.require_content(audited) == 100
        else:
            with pytest.raises(audit.ReconciliationError, match="not the same ones"):
                audit.require_content(audited)
    assert "Join" not in plan(audited)
    empty = source.limit(0)
    assert audit.require_content(audit.content_audit(empty, empty, ["a"])) == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_differences_by_ranges(spark, kind):
    rng = random.Random(1)
    source = {k: (k, rng.random()) for k in rng.sample(range(-(10**12), 10**12), 3000)}
    source[2**63 - 1], source[-(2**63)] = (2**63 - 1, 0.0), (-(2**63), 1.0)
    target = dict(source)
    keys = sorted(source)
    for k in keys[10:13]:
        del target[k]
    for k in keys[2000:2002]:
        target[k] = (k, 2.0)
    target[5] = (5, 0.5)
    schema = "id long, v double"
    frames = [
        spark.createDataFrame([*rows.values(), *extra], schema).withColumn("id", F.col("id").cast(kind))
        for rows, extra in ((source, [(None, 1.0), (keys[0], 7.0)]), (target, [(None, 2.0)]))
    ]
    got = reconcile.differences(*frames, "id", rows_per_range=20)
    expected = {
        **{k: reconcile.MISSING for k in keys[10:13]}, **{k: reconcile.CHANGED for k in keys[2000:2002]},
        5: reconcile.DELETED, None: reconcile.CHANGED, keys[0]: reconcile.CHANGED,
    }
    assert {None if r["id"] is None else int(r["id"]): r["difference"] for r in got.collect()} == expected
    same = frames[0]
    assert reconcile.differing_ranges(same, same, "id", ["id", "v"]) == []
    assert reconcile.differences(same, same, "id").count() == 0
    assert reconcile.differences(same, same.limit(0), "id").filter(f"difference = '{reconcile.MISSING}'").count() == 3003


def test_only_differing_ranges_are_read(spark, root):
    spark.range(200_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(root + "/a")
    source = spark.read.parquet(root + "/a")
    target = source.withColumn("v", F.when(F.col("id") == 77_777, 99).otherwise(F.col("v")))
    ranges = reconcile.differing_ranges(source, target, "id", ["id", "v"], rows_per_range=100)
    assert len(ranges) == 1 and ranges[0].low <= 77_777 <= ranges[0].high and ranges[0].high - ranges[0].low < 200
    found = reconcile.differences(source, target, "id", rows_per_range=100)
    pushed = [x for x in plan(found).split("\n") if "PushedFilters" in x]
    assert pushed and all(f"GreaterThanOrEqual(id,{ranges[0].low})" in x and "LessThanOrEqual(id" in x for x in pushed)
    assert [tuple(r) for r in found.collect()] == [(77_777, "changed")]


def test_lost_rows_are_found_and_recovered(spark, warehouse):
    shop = Shop(1)
    refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, "r1")
    # Order 100 comes late, order 3 changes in place, order 4 goes, order 5 breaks a rule by now.
    shop.orders[100] = (100, 1, 1, 1, 2, 0)
    shop.orders[3] = (*shop.orders[3][:3], 77, *shop.orders[3][4:])
    del shop.orders[4]
    shop.orders[5] = (*shop.orders[5][:3], 0, *shop.orders[5][4:])
    # One above the mark is not lost; the next run extracts it.
    shop.orders[101] = (101, 1, 1, 1, 30, 0)
    sources = shop.sources(spark)
    lost = verify.lost_rows(spark, sources[ORDERS.name], ORDERS, warehouse)
    assert {tuple(r) for r in lost.collect()} == {(100, "missing"), (3, "changed"), (4, "deleted"), (5, "deleted")}
    assert verify.recover(spark, sources[ORDERS.name], ORDERS, warehouse, "r1-lost") == 2
    assert [p.status for p in promote.promote_pending(spark, ECOMMERCE, warehouse)["r1-lost"]] == [promote.PUBLISHED]
    done = refresh(spark, sources, ECOMMERCE, warehouse, "r2", find_lost=True)
    assert done.lost == {ORDERS.name: {"deleted": 2}}
    fact = {r["order_id"]: r["quantity"] for r in gold.read_gold(spark, warehouse, gold.FACT).collect()}
    assert fact[3] == 77 and fact[100] == 1 and fact[101] == 1
    assert verify.lost_rows(spark, sources[ORDERS.name], ORDERS, Warehouse(warehouse.root + "/none")) is None


# --- promotion in one pass -----------------------------------------------------------


def test_the_batch_is_scanned_once(spark, root):
    orders(spark, [(i, 1, 1, 1, 1, 1) for i in range(10)]).write.parquet(root + "/raw")
    raw = spark.read.parquet(root + "/raw")
    tagged = tag_failures(cast_to_schema(raw, ORDERS.schema, report_failures=True), ORDERS.rules)
    text = plan(quality.sorted_out(tagged, ORDERS.rules, [ORDERS.key], ORDERS.watermark))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1
    assert "WindowGroupLimit" in text[text.index("Exchange"):]


def test_outcomes_against_the_separate_operators(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice([None, 1, 2, 3, 4]), 1, 1, rng.choice([0, 1, 2, None]), Decimal(rng.randint(-1, 3)), at(rng.randint(0, 2)))
        for _ in range(200)
    ]
    typed = spark.createDataFrame(rows, ORDERS.schema).repartition(4)
    tagged = tag_failures(cast_to_schema(typed, ORDERS.schema, report_failures=True), ORDERS.rules)
    got = quality.sorted_out(tagged, ORDERS.rules, [ORDERS.key], ORDERS.watermark)
    clean, rejected = quality.split_by_rules(typed, ORDERS.rules)
    kept = latest_per_key(clean, [ORDERS.key], ORDERS.watermark)
    columns = ORDERS.columns
    assert _facts(got.filter("outcome = 'clean'").select(*columns)) == _facts(kept)
    bad = got.filter("outcome = 'rejected'").drop("outcome", CAST_FAILED)
    assert _facts(bad) == _facts(rejected)


def test_cast_failures_are_counted_and_kept(spark, warehouse):
    text = orders(spark, [(i, 1, 1, 1, 1, 1) for i in range(40)]).select(*[F.col(c).cast("string") for c in ORDERS.columns])
    broken = text.withColumns({
        "order_id": F.when(F.col("order_id") == "3", "x3").otherwise(F.col("order_id")),
        "customer_id": F.when(F.col("order_id") == "7", "?").otherwise(F.col("customer_id")),
    })
    bronze.write_run(broken, bronze.run_path(warehouse.root, ORDERS.name, "a"), "csv")
    done = promote.promote_tables(spark, [ORDERS], warehouse, "a", "csv")[0]
    assert done.cast_failures == {"order_id": 1, "customer_id": 1}
    rejected = spark.read.parquet(warehouse.quarantine(ORDERS.name, "a")).collect()
    assert [list(r[CAST_FAILED]) for r in rejected] == [["order_id"]]
    # The yield counts all rows that came in; the staging folder has gone.
    assert done.metrics["metrics"]["clean_records_promoted"] == 39
    assert not storage.exists(spark, warehouse.staged(ORDERS.name, "a"))


def test_metrics_are_read_back_with_new_rules(spark, warehouse):
    assert promote.read_metrics(spark, warehouse) is None
    lenient = dataclasses.replace(PRODUCTS, rules={"null_primary_key": PRODUCTS.rules["null_primary_key"]})
    for run, (contract, bad) in enumerate([(lenient, 0), (PRODUCTS, 2), (PRODUCTS, 0)]):
        rows = [(i, "0.00" if i < bad else "1.00", "Books", run) for i in range(30)]
        extract.extract_tables(spark, {PRODUCTS.name: products(spark, rows)}, [contract], warehouse, f"r{run}")
        promote.promote_tables(spark, [contract], warehouse, f"r{run}")
    metrics = promote.read_metrics(spark, warehouse)
    shares = {r["pipeline_run_id"]: (r["previous_run"], r["yield_change"]) for r in quality.yield_history(metrics).collect()}
    assert shares == {"r0": (None, None), "r1": ("r0", Decimal("-6.67")), "r2": ("r1", Decimal("6.67"))}
    rules = {(r["pipeline_run_id"], r["rule"]): (r["failures"], r["change"]) for r in quality.rule_history(metrics).collect()}
    assert len(rules) == 3 * 3
    assert [rules[f"r{i}", "negative_or_zero_price"] for i in range(3)] == [(0, None), (2, 2), (0, -2)]


# --- what is left behind -------------------------------------------------------------


def scratch(spark):
    return set(storage.child_folders(spark, storage.shared_folder(spark) + "/tidemark"))


def test_runs_and_numberings_leave_no_scratch(spark, warehouse):
    before = scratch(spark)
    shop = Shop(2)
    for turn in range(3):
        shop.change(turn)
        refresh(spark, shop.sources(spark), ECOMMERCE, warehouse, f"r{turn}", keep_versions=1)
    with storage.owned_scratch(spark):
        rows = numbering.number_rows(spark.range(100), ["id"]).collect()
        assert len(rows) == 100 and scratch(spark) != before
    assert scratch(spark) == before
    assert not storage.child_folders(spark, f"{warehouse.root}/staging/{ORDERS.name}")
    for contract in ECOMMERCE:
        assert len(storage.child_folders(spark, warehouse.silver(contract.name))) == 1
        assert not storage.child_folders(spark, versions.changes_folder(warehouse.silver(contract.name)))
    assert len(storage.child_folders(spark, warehouse.gold)) == 1
    with pytest.raises(RuntimeError), storage.owned_scratch(spark):
        storage.materialise(spark.range(1), "lost")
        raise RuntimeError
    assert scratch(spark) == before


def test_file_systems_without_exclusive_files_are_refused_before_writing(spark, warehouse, monkeypatch):
    refresh(spark, Shop(3).sources(spark), ECOMMERCE, warehouse, "r0")
    monkeypatch.setattr(storage, "EXCLUSIVE_SCHEMES", ("hdfs",))
    with pytest.raises(ValueError, match="exclusively"):
        storage.require_exclusive(spark, warehouse.root)
    with pytest.raises(ValueError, match="exclusively"):
        refresh(spark, Shop(4).sources(spark), ECOMMERCE, warehouse, "r1")
    assert not storage.exists(spark, bronze.run_path(warehouse.root, ORDERS.name, "r1"))
