from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, joins, star
from tidemark.operators.joins import dimension_join, hot_keys, salted_left_join
from tidemark.operators.sizing import fits


def day(n):
    return None if n is None else datetime.datetime(2026, 1, n, 12)


@pytest.fixture
def shop(spark):
    orders = spark.createDataFrame(
        [
            (1, 10, 100, 2, Decimal("5.00"), day(1)),
            (2, 10, 999, 1, Decimal("7.00"), day(1)),
            (3, None, 100, 3, Decimal("0.00"), None),
            (4, 11, None, 1, Decimal("1.00"), day(2)),
        ],
        "order_id int, customer_id int, product_id int, quantity int, "
        "total_amount decimal(10,2), updated_at timestamp",
    )
    products = spark.createDataFrame(
        [(100, "Pen", Decimal("1.25"), "Books", 5, day(1))],
        "product_id int, product_name string, price decimal(10,2), category string, "
        "stock_quantity int, updated_at timestamp",
    )
    customers = spark.createDataFrame(
        [(10, "A", "B", "a@b", "X", day(1))],
        "customer_id int, first_name string, last_name string, email string, city string, "
        "created_at timestamp",
    )
    return orders, star.product_dimension(products), star.customer_dimension(customers)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_fact(shop, limit):
    orders, products, customers = shop
    fact = star.order_fact(orders, products, customers, limit)
    assert sorted(fact.columns) == sorted(
        [
            "customer_id", "product_id", "order_id", "quantity", "total_amount", "updated_at",
            "product_name", "unit_price", "product_category", "customer_first_name",
            "customer_last_name", "customer_email", "customer_city", "net_sales", "order_date",
        ]
    )
    assert fact.schema["net_sales"].dataType.simpleString() == "decimal(22,2)"
    rows = {r.order_id: r for r in fact.collect()}
    assert len(rows) == 4
    assert rows[1].net_sales == Decimal("2.50") and rows[1].customer_city == "X"
    assert rows[2].net_sales is None and rows[2].product_category is None
    assert rows[3].order_date is None and rows[3].customer_email is None
    assert rows[4].product_name is None


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_daily_sales_agree_on_every_path(shop, limit):
    orders, products, customers = shop
    want = {
        (datetime.date(2026, 1, 1), "Books", Decimal("2.50"), 1),
        (datetime.date(2026, 1, 1), None, None, 1),
        (None, "Books", Decimal("3.75"), 1),
        (datetime.date(2026, 1, 2), None, None, 1),
    }
    fact = star.order_fact(orders, products, customers, limit)
    direct = star.daily_category_sales(fact)
    summed = star.daily_category_sales_from_orders(orders, products, limit)
    assert direct.dtypes == summed.dtypes == [
        ("order_date", "date"), ("product_category", "string"),
        ("total_revenue", "decimal(32,2)"), ("total_orders", "bigint"),
    ]
    assert {tuple(r) for r in direct.collect()} == want
    assert {tuple(r) for r in summed.collect()} == want


def test_hot_keys_are_counted_in_stored_tables_only(shop, monkeypatch):
    counted = []

    def counting(df, key):
        counted.append(key)
        return hot_keys(df, key, 1)

    monkeypatch.setattr(joins, "hot_keys", counting)
    plain = star.order_fact(*shop, 0)
    assert counted == []
    salted = star.order_fact(*shop, 0, stored=shop[0])
    assert counted == ["product_id", "customer_id"]
    assert plain.columns == salted.columns
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, salted.collect()), key=repr)


def test_other_measures(shop):
    fact = star.order_fact(*shop)
    revenue = {r.order_date: r.total_revenue for r in star.revenue_by_amount(fact).collect()}
    assert revenue[datetime.date(2026, 1, 1)] == Decimal("12.00")
    doubled = fact.unionAll(fact)
    assert {r.total_orders for r in star.distinct_orders(doubled).collect()} == {1}


def hot_list(df, key, rows):
    return sorted(map(tuple, hot_keys(df, key, rows).collect()))


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k")
    )
    assert hot_list(df, "k", 100) == [(7, 4)]  # 335 rows
    assert hot_list(df, "k", 335) == []
    assert hot_list(df.limit(0), "k", 1) == []
    assert hot_list(df.select(F.lit(None).cast("long").alias("k")), "k", 1) == []


@pytest.mark.parametrize("rows_per_task", [1, 20, 1000])
def test_salted_join_equals_plain_join(spark, rows_per_task):
    """With a hot key, missing keys, unknown keys and a repeated dimension key."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit(1))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 50)
        .cast("long")
        .alias("k"),
        F.col("id").alias("row"),
    )
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (40, "d")], "k long, name string")
    salted = salted_left_join(df, dim, "k", ["row"], hot_keys(df, "k", rows_per_task))
    plain = df.join(dim, "k", "left")
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(
        map(tuple, plain.collect()), key=repr
    )


@pytest.mark.parametrize("key", [1, None], ids=["hot", "missing"])
@pytest.mark.parametrize("row", [F.col, lambda _: F.lit(0)], ids=["rows", "copies"])
def test_a_hot_key_is_spread_over_tasks(spark, key, row):
    df = spark.range(4000, numPartitions=32).select(
        F.lit(key).cast("int").alias("k"), row("id").alias("row")
    )
    dim = spark.createDataFrame([(1, "a")], "k int, name string").hint("merge")
    hot = hot_keys(df, "k", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_left_join(df, dim, "k", ["row"], hot)
        sizes = [
            r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and max(sizes) < 2500


def test_broadcast_only_below_the_measured_size(spark):
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit("x" * 100).alias("name"))
    df = spark.range(10).withColumnRenamed("id", "k")
    assert fits(dim, 1 << 20) and not fits(dim, 5000) and not fits(dim, 100)
    assert fits(dim.limit(0), 0)
    small = dimension_join(df, dim, "k", ["k"], 1 << 20)
    large = dimension_join(df, dim.hint("merge"), "k", ["k"], 100)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()


def test_audits(spark, shop):
    orders, products, customers = shop
    fact = star.order_fact(orders, products, customers)
    assert tuple(audit.reconciliation(orders, fact).first()) == (4, 4, 0)
    audit.require_balance(4, 4)
    fanned = star.order_fact(orders, products.unionAll(products), customers)
    row = audit.reconciliation(orders, fanned).first()
    assert row.discrepancy == -2
    with pytest.raises(audit.ReconciliationError):
        audit.require_balance(row.silver_rows, row.gold_rows)
    with pytest.raises(audit.ReconciliationError):
        audit.require_unique(products.unionAll(products), ["product_id"], "dim_products")
    assert tuple(audit.null_keys(fact, ["order_id", "product_id"]).first()) == (0, 1)
