"""Times the headline queries and prints one JSON line.

Each query is run once to warm up, then timed from building the plan to the
last row. ``medallion_refresh`` writes a whole warehouse and is timed once. Two
incremental runs of all three stages follow, the second without new rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark import build_session  # noqa: E402
from tidemark.operators.extract import high_watermark, watermark_literal  # noqa: E402
from tidemark.operators.latest import latest_per_key  # noqa: E402
from tidemark.operators.merge import merge_into_state, merge_latest  # noqa: E402
from tidemark.plans import shop  # noqa: E402
from tidemark.plans.layout import Warehouse  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.plans.refresh import refresh  # noqa: E402
from tidemark.plans.versions import merge_and_publish  # noqa: E402
from tidemark.sources.storage import materialise, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "incremental_extract",
    "bronze_roundtrip",
    "chunk_assignment",
    "schema_cast",
    "rule_breakdown",
    "quality_metrics",
    "dedup_latest",
    "silver_merge",
    "silver_merge_broadcast",
    "silver_merge_shuffled",
    "silver_merge_bucketed",
    "insert_if_absent",
    "update_by_key",
    "fact_orders",
    "daily_category_sales",
    "distinct_orders",
    "reconciliation_audit",
    "medallion_refresh",
)
ONCE = {"medallion_refresh"}


def seconds(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def stored_merges(spark) -> dict[str, float]:
    """Times of a merge of corrected rows into one stored state, to the written new state: by ranking both,
    by a join that knows nothing of how the state is stored, and bucket by bucket."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    keys, ts = ["l_orderkey", "l_linenumber"], "l_shipdate"
    latest = latest_per_key(lines, keys, ts)
    plain = materialise(latest, "bench-state")
    root = scratch_path(spark, "bench-buckets")
    merge_and_publish(plain, root, keys, ts)
    returned = lines.filter("l_returnflag = 'R'").withColumn("l_tax", F.lit(0.0))
    times = {}
    for turn in range(2):  # the first is a warm-up
        batch = materialise(latest_per_key(returned.withColumn("l_tax", F.lit(float(turn))), keys, ts), "bench-batch")
        steps = {
            "merge_stored_ranked": lambda: materialise(merge_latest(plain, batch, keys, ts), "bench-out"),
            "merge_stored_joined": lambda: materialise(merge_into_state(plain, batch, keys, ts), "bench-out"),
            "merge_stored_bucketed": lambda: merge_and_publish(batch, root, keys, ts),
        }
        for name, step in steps.items():
            started = time.perf_counter()
            step()
            times[name] = round(time.perf_counter() - started, 3)
    for name, value in times.items():
        print(name, value, file=sys.stderr, flush=True)
    return times


def whole_runs(spark) -> dict[str, float]:
    """Times of two runs on a loaded warehouse: one for the orders of the last
    days, a few hundred at sf0.1, and one that finds nothing new."""
    orders = materialise(shop.orders(spark, SF_DIR).drop("o_orderstatus"), "bench-orders")
    mark = high_watermark(orders, "updated_at") - 7 * 24 * 3600 * 1_000_000
    older = orders.filter(F.col("updated_at") <= watermark_literal(orders, "updated_at", mark))
    stamp = F.lit("1995-01-01").cast("timestamp_ntz")
    later = {
        "source_products": shop.products(spark, SF_DIR).withColumn("updated_at", stamp),
        "source_customers": shop.customers(spark, SF_DIR).withColumn("created_at", stamp),
        "source_orders": orders,
    }
    warehouse = Warehouse(scratch_path(spark, "bench"))
    refresh(spark, {**later, "source_orders": older}, shop.SHOP, warehouse, "r1")
    times = {}
    for name, run_id in (("run_last_days", "r2"), ("run_nothing_new", "r3")):
        started = time.perf_counter()
        done = refresh(spark, later, shop.SHOP, warehouse, run_id)
        times[name] = round(time.perf_counter() - started, 3)
        rows = sum(e.rows for e in done.extractions)
        print(name, times[name], f"({rows} rows)", file=sys.stderr, flush=True)
    return times


def main() -> None:
    conf = {
        "spark.master": f"local[{CPUS}]",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # The local disk of a bench run needs no checksum file per data file.
        "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    spark = build_session("bench", conf)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).count()
    times = {}
    for name in HEADLINES:
        if name not in ONCE:
            seconds(spark, name)
        times[name] = round(seconds(spark, name), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    times.update(stored_merges(spark))
    times.update(whole_runs(spark))
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
