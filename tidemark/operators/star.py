"""Star schema: dimensions, order fact and daily category figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import dimension_join
from tidemark.operators.sizing import BROADCAST_LIMIT, fits

# Source column -> dimension column.
PRODUCT_COLUMNS = {
    "product_id": "product_id",
    "product_name": "product_name",
    "price": "unit_price",
    "category": "product_category",
}
CUSTOMER_COLUMNS = {
    "customer_id": "customer_id",
    "first_name": "customer_first_name",
    "last_name": "customer_last_name",
    "email": "customer_email",
    "city": "customer_city",
}

SALES_KEYS = ("order_date", "product_category")


def dimension(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Projects the listed columns under their dimension names."""
    return df.select(*[F.col(source).alias(target) for source, target in columns.items()])


def product_dimension(products: DataFrame) -> DataFrame:
    return dimension(products, PRODUCT_COLUMNS)


def customer_dimension(customers: DataFrame) -> DataFrame:
    return dimension(customers, CUSTOMER_COLUMNS)


def with_measures(orders: DataFrame) -> DataFrame:
    """Adds ``net_sales`` at the current price and the ``order_date`` key."""
    return orders.withColumns(
        {
            "net_sales": F.round(F.col("quantity") * F.col("unit_price"), 2),
            "order_date": F.to_date("updated_at"),
        }
    )


def order_fact(
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Orders with both dimensions attached; unmatched orders are kept.

    ``stored`` is a stored table of the orders' keys in which hot ones may be counted.
    """
    priced = dimension_join(orders, products, "product_id", ["order_id"], broadcast_limit, stored)
    placed = dimension_join(priced, customers, "customer_id", ["order_id"], broadcast_limit, stored)
    return with_measures(placed)


def daily_category_sales(fact: DataFrame) -> DataFrame:
    """Net sales and order rows per day and category; a missing category is a
    group of its own."""
    return sales_of(sales_parts(fact))


def sales_parts(fact: DataFrame) -> DataFrame:
    """Daily sales with the counts that let parts of a fact be added and taken away."""
    return fact.groupBy(*SALES_KEYS).agg(*sales_figures())


def sales_figures() -> list[Column]:
    """The aggregates of :func:`sales_parts`."""
    return [
        F.sum("net_sales").alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.count("net_sales").alias("priced_rows"),
        F.count(F.lit(1)).alias("fact_rows"),
    ]


def sales_of(parts: DataFrame) -> DataFrame:
    return parts.select(*SALES_KEYS, "total_revenue", "total_orders")


def apply_sales_delta(stored: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """:func:`sales_parts` of a fact after the rows of ``removed`` have left and those of ``added`` have come.

    The three are parts of their own: only rows that change are aggregated, with a sign, and met
    with the stored figures, one row per day and category. A group goes with its last row, and has
    no revenue (NULL, not 0) without any price. Exact for decimal sales.
    """
    figures = ("total_orders", "priced_rows", "fact_rows")
    sides = [
        parts.select(
            *SALES_KEYS, (F.coalesce("total_revenue", F.lit(0)) * F.lit(sign)).alias("total_revenue"),
            *[(F.col(c) * F.lit(sign)).alias(c) for c in figures],
        )
        for parts, sign in ((stored, 1), (sales_parts(removed), -1), (sales_parts(added), 1))
    ]
    summed = reduce(DataFrame.unionByName, sides).groupBy(*SALES_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("total_revenue", *figures)]
    )
    revenue = F.col("total_revenue").cast(stored.schema["total_revenue"].dataType)
    return summed.filter(F.col("fact_rows") > 0).select(
        *SALES_KEYS, F.when(F.col("priced_rows") > 0, revenue).alias("total_revenue"), *figures
    )


def daily_category_sales_from_orders(
    orders: DataFrame, products: DataFrame, broadcast_limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """The same figures straight from the orders, without building the fact.

    Orders are counted per day, product and quantity before the products are
    joined: a hot product reaches the shuffle as a few counts instead of all of its
    rows. Each counted sale is rounded as in the fact, so the figures are the same
    whatever the tables' sizes and the prices' decimals; only whether the products
    are broadcast depends on their size.
    """
    needed = products.select("product_id", "unit_price", "product_category")
    counted = orders.groupBy(
        F.to_date("updated_at").alias("updated_at"), "product_id", "quantity"
    ).agg(F.count("*").alias("n"), F.count("order_id").alias("orders"))
    priced = with_measures(
        counted.join(F.broadcast(needed) if fits(needed, broadcast_limit) else needed, "product_id", "left")
    )
    revenue = (F.col("net_sales") * F.col("n")).cast("decimal(32,2)")
    return priced.groupBy("order_date", "product_category").agg(
        F.sum(revenue).cast("decimal(32,2)").alias("total_revenue"),
        F.sum("orders").alias("total_orders"),
    )


def revenue_by_amount(fact: DataFrame) -> DataFrame:
    """Revenue as charged, per day: the sum of the order amounts."""
    return fact.groupBy("order_date").agg(F.sum("total_amount").alias("total_revenue"))


def distinct_orders(fact: DataFrame, order_key: str = "order_id") -> DataFrame:
    """Distinct orders per day and category."""
    return fact.groupBy("order_date", "product_category").agg(
        F.count_distinct(order_key).alias("total_orders")
    )


def sales_between(fact: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Fact rows of a range of days; on the partitioned table only those
    partitions are read."""
    day = F.col("order_date")
    return fact.filter(day.between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))


def on_days(days: Sequence[date | None], column: str = "order_date") -> Column:
    """True for rows of the given days, None among them standing for rows without one; never NULL."""
    known = [F.lit(d) for d in days if d is not None]
    found = F.coalesce(F.col(column).isin(*known), F.lit(False)) if known else F.lit(False)
    return found | F.col(column).isNull() if None in days else found


def by_day(fact: DataFrame) -> DataFrame:
    """Rows of one day brought together for the partitioned write.

    A rebalance, unlike a plain repartition by date, lets Spark cut a day that
    is too large for one task into several files and join the small ones.
    """
    return fact.hint("rebalance", "order_date")
