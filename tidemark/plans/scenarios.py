"""Whole runs over the TPC-H-like tables, as queries of what they leave behind."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.extract import micros
from tidemark.operators.quality import YieldBelowTolerance
from tidemark.plans import shop
from tidemark.plans.extract import RawFormat, extract_tables
from tidemark.plans.gold import DAILY_SALES, FACT, read_gold
from tidemark.plans.layout import Warehouse
from tidemark.plans.promote import promote_tables, read_metrics
from tidemark.plans.promote import pending_runs as waiting
from tidemark.plans.refresh import load, refresh
from tidemark.plans.verify import lost_rows as lost
from tidemark.sources import ledger, snapshots, state
from tidemark.sources.storage import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The mark up to which orders are loaded first, stamps of the products and
# customers of a first and a second run, and days on which orders come or are touched later.
SHIP_MARK = "1998-06-30 00:00:00"
FIRST_STAMP, SECOND_STAMP = "1995-01-01 00:00:00", "1996-01-01 00:00:00"
LATE_DAY, LATER_DAY = "2002-12-30 00:00:00", "2002-12-31 00:00:00"

PRODUCTS, CUSTOMERS, ORDERS = (c.name for c in shop.SHOP)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _sources(spark: SparkSession, sf_dir: str, orders: DataFrame) -> dict[str, DataFrame]:
    return {
        PRODUCTS: shop.products(spark, sf_dir).withColumn("updated_at", _ntz(FIRST_STAMP)),
        CUSTOMERS: shop.customers(spark, sf_dir).withColumn("created_at", _ntz(FIRST_STAMP)),
        ORDERS: orders.drop("o_orderstatus"),
    }


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(scratch_path(spark, "warehouse"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(shop.orders(spark, sf_dir), "source-orders")


@query
def medallion_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of the current state, then a whole run on the source after orders completed
    by the mark were touched again on the day after it."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    mark = _ntz(SHIP_MARK)
    touched = (F.col("o_orderstatus") == "F") & (F.col("updated_at") <= mark)
    moved = F.when(touched, mark + F.expr("INTERVAL 1 DAY")).otherwise(F.col("updated_at"))
    load(spark, _sources(spark, sf_dir, orders.filter(F.col("updated_at") <= mark)), shop.SHOP, warehouse, "r1")
    refresh(spark, _sources(spark, sf_dir, orders.withColumn("updated_at", moved)), shop.SHOP, warehouse, "r2")
    return _revenue(read_gold(spark, warehouse, DAILY_SALES))


def _revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query
def gold_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run in which orders come and move to other days, and products are repriced, change
    their category or come late: the maintained daily sales next to figures of the whole fact.

    Only the days that the changes touch are joined and written by it.
    """
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    pending = F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
    first = _sources(spark, sf_dir, orders.filter(~pending))
    size, fifty = F.col("stock_quantity"), F.col("quantity") == 50
    first[PRODUCTS] = first[PRODUCTS].filter(size != 3)
    refresh(spark, first, shop.SHOP, warehouse, "r1")
    second = _sources(spark, sf_dir, orders.withColumns({
        "updated_at": F.when(fifty, _ntz(LATER_DAY)).when(pending, _ntz(LATE_DAY)).otherwise(F.col("updated_at")),
        "quantity": F.when(fifty, F.lit(1).cast("long")).otherwise(F.col("quantity")),
    }))
    second[PRODUCTS] = shop.products(spark, sf_dir).withColumns({
        "price": (F.col("price") + F.when(size == 1, 1).otherwise(0)).cast("decimal(10,2)"),
        "category": F.when(size == 2, "PROMO").otherwise(F.col("category")),
        "updated_at": F.when(size <= 3, _ntz(SECOND_STAMP)).otherwise(_ntz(FIRST_STAMP)),
    })
    rich = shop.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), (F.col("c_acctbal") > 9900).alias("rich")
    )
    second[CUSTOMERS] = first[CUSTOMERS].join(rich, "customer_id").withColumns({
        "city": F.when(F.col("rich"), "MOVED").otherwise(F.col("city")),
        "created_at": F.when(F.col("rich"), _ntz(SECOND_STAMP)).otherwise(F.col("created_at")),
    }).select(*first[CUSTOMERS].columns)
    refresh(spark, second, shop.SHOP, warehouse, "r2", keep_versions=1)
    whole = read_gold(spark, warehouse, FACT).groupBy("order_date", "product_category").agg(
        F.sum("net_sales").cast("double").alias("fact_revenue"), F.count("*").alias("fact_rows"),
        F.count_if(F.col("customer_city") == "MOVED").alias("moved_rows"),
    ).withColumnsRenamed({"order_date": "_day", "product_category": "_category"})
    sales = _revenue(read_gold(spark, warehouse, DAILY_SALES))
    same = F.col("order_date").eqNullSafe(F.col("_day")) & F.col("product_category").eqNullSafe(F.col("_category"))
    return sales.join(whole, same, "full").drop("_day", "_category")


def _second_run_fails(spark: SparkSession, sf_dir: str, warehouse: Warehouse, orders: DataFrame) -> None:
    """A run over changed products of which half have lost their price."""
    sources = _sources(spark, sf_dir, orders)
    sources[PRODUCTS] = sources[PRODUCTS].withColumns({
        "price": F.when(F.col("stock_quantity") > 25, F.lit(0).cast("decimal(10,2)")).otherwise(F.col("price")),
        "updated_at": _ntz(SECOND_STAMP),
    })
    try:
        refresh(spark, sources, shop.SHOP, warehouse, "r2")
    except YieldBelowTolerance:
        return
    raise AssertionError("the second run should have failed")


@query
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a good run and a failing one after it wrote into the ledger."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    refresh(spark, _sources(spark, sf_dir, orders), shop.SHOP, warehouse, "r1")
    _second_run_fails(spark, sf_dir, warehouse, orders)
    report = ledger.run_summary(ledger.read(spark, warehouse.ledger))
    return report.withColumn("timed", (F.col("duration_seconds") > 0).cast("int")).drop("duration_seconds")


@query
def pending_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch that the failing run left to be promoted."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    load(spark, _sources(spark, sf_dir, orders), shop.SHOP, warehouse, "r1")
    _second_run_fails(spark, sf_dir, warehouse, orders)
    return waiting(spark, warehouse)


def _rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few rows of text and numbers a run has returned."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))


@query
def run_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How extraction and promotion end: with rows, an empty source, nothing new, no batch, a missing column."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    first = _sources(spark, sf_dir, orders)
    first[CUSTOMERS] = first[CUSTOMERS].limit(0)
    second = _sources(spark, sf_dir, orders.withColumn("updated_at", _ntz(LATE_DAY)).drop("quantity"))
    done = []
    for run_id, sources in (("r1", first), ("r2", second)):
        for e in extract_tables(spark, sources, shop.SHOP, warehouse, run_id):
            done.append((run_id, "extract", e.table, e.status, e.rows))
        for p in promote_tables(spark, shop.SHOP, warehouse, run_id, raise_problems=False):
            problem = f"{p.status}: {type(p.problem).__name__}" if p.problem else p.status
            done.append((run_id, "promote", p.table, problem, p.rows))
    found = _rows(spark, done, ["run_id", "stage", "table_name", "status", "row_count"])
    return found.withColumn("row_count", F.col("row_count").cast("long"))


@query
def quarantine_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a promotion put aside, as they are read back."""
    warehouse = _warehouse(spark)
    contracts = shop.SHOP[:2]
    sources = _sources(spark, sf_dir, shop.orders(spark, sf_dir))
    extract_tables(spark, sources, contracts, warehouse, "r1")
    promote_tables(spark, contracts, warehouse, "r1", raise_problems=False)
    return reduce(DataFrame.unionAll, [
        spark.read.parquet(warehouse.quarantine(c.name, "r1")).select(
            F.lit(c.name).alias("table_name"), F.col(c.key).alias("row_key"),
            F.array_join("validation_errors", ",").alias("validation_errors"),
        )
        for c in contracts
    ])


@query
def extraction_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored watermarks after a good extraction and one that fails for the table with new rows."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    extract_tables(spark, _sources(spark, sf_dir, orders), shop.SHOP, warehouse, "r1")
    later = _sources(spark, sf_dir, orders.withColumn("updated_at", _ntz(LATE_DAY)))
    extract_tables(spark, later, shop.SHOP, warehouse, "r2", RawFormat("unknown"), raise_problems=False)
    return snapshots.read_current(spark, warehouse.state, state.STATE_SCHEMA).select(
        "source_table", "pipeline_run_id", F.split("last_run_status", ":")[0].alias("status"),
        micros(F.col("last_success_watermark")).alias("watermark_us"),
    )


@query
def metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures per rule over two runs, the second of which has a rule more, read back from what they wrote."""
    warehouse = _warehouse(spark)
    products = _sources(spark, sf_dir, shop.orders(spark, sf_dir))[PRODUCTS]
    small = F.col("stock_quantity") <= 25
    rules = {name: rule for name, rule in shop.SHOP_PRODUCTS.rules.items() if name != "oversized_stock"}
    runs = (
        ("r1", products.filter(small), dataclasses.replace(shop.SHOP_PRODUCTS, rules=rules)),
        ("r2", products.withColumn("updated_at", F.when(small, F.col("updated_at")).otherwise(_ntz(SECOND_STAMP))),
         shop.SHOP_PRODUCTS),
    )
    for run_id, source, contract in runs:
        extract_tables(spark, {PRODUCTS: source}, [contract], warehouse, run_id)
        promote_tables(spark, [contract], warehouse, run_id, raise_problems=False)
    return quality.rule_history(read_metrics(spark, warehouse))


@query
def lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that came late, were changed without a new time stamp, or were deleted after a load."""
    warehouse = _warehouse(spark)
    orders = _orders(spark, sf_dir)
    late = F.coalesce((F.col("o_orderstatus") == "O") & (F.col("quantity") == 7), F.lit(False))
    load(spark, _sources(spark, sf_dir, orders.filter(~late)), shop.SHOP, warehouse, "r1")
    touched = F.coalesce(F.col("quantity") == 50, F.lit(False))
    now = orders.filter(F.col("total_amount") >= 5000).withColumn(
        "total_amount", F.when(touched, (F.col("total_amount") + 1).cast("decimal(10,2)")).otherwise(F.col("total_amount"))
    )
    return lost(spark, _sources(spark, sf_dir, now)[ORDERS], shop.SHOP_ORDERS, warehouse)
