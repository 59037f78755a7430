"""The e-commerce source tables, derived from the TPC-H-like tables.

Order lines and orders play the part of the order table, parts are products.
Amounts become decimals, as the contracts declare them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark.contracts import TableContract
from tidemark.functions.rules import (
    missing,
    missing_or_negative,
    missing_or_not_positive,
    missing_or_unlike,
    outside,
)
from tidemark.operators.joins import dimension_join
from tidemark.operators.latest import latest_per_key

# The product types that count as valid categories.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(10,2)")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        money("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("long").alias("stock_quantity"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt have an address without a domain."""
    name = F.split("c_name", "#")
    domain = F.when(F.col("c_acctbal") < -500, "").otherwise("@example.com")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        F.concat("c_name", domain).alias("email"),
        F.col("c_mktsegment").alias("city"),
    )


def line_columns(lines: DataFrame) -> DataFrame:
    """What an order line says of itself as an order."""
    return lines.select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total_amount"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as an order, with the customer and date of its order."""
    lines = line_columns(table(spark, sf_dir, "lineitem"))
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dimension_join(lines, heads, "o_orderkey", ["order_id", "product_id"]).select(
        "order_id",
        F.col("o_custkey").alias("customer_id"),
        "product_id",
        "quantity",
        "total_amount",
        F.col("o_orderdate").alias("updated_at"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the product of its last shipped line; an order
    without lines has no product and no quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_partkey", "l_quantity"
    )
    last_line = latest_per_key(lines, ["l_orderkey"], "l_shipdate")
    heads = table(spark, sf_dir, "orders")
    return heads.join(last_line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderstatus"),
    )


def _schema(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


SHOP_PRODUCTS = TableContract(
    name="source_products",
    schema=_schema(
        product_id=LongType(),
        product_name=StringType(),
        price=DecimalType(10, 2),
        category=StringType(),
        stock_quantity=LongType(),
        updated_at=TimestampNTZType(),
    ),
    key="product_id",
    watermark="updated_at",
    rules={
        "null_primary_key": missing("product_id"),
        "negative_or_zero_price": missing_or_not_positive("price"),
        "invalid_category_enum": outside("category", CATEGORIES),
        "oversized_stock": "stock_quantity > 48",
    },
)

SHOP_CUSTOMERS = TableContract(
    name="source_customers",
    schema=_schema(
        customer_id=LongType(),
        first_name=StringType(),
        last_name=StringType(),
        email=StringType(),
        city=StringType(),
        created_at=TimestampNTZType(),
    ),
    key="customer_id",
    watermark="created_at",
    rules={
        "null_primary_key": missing("customer_id"),
        "malformed_or_null_email": missing_or_unlike("email", "%@%"),
    },
)

SHOP_ORDERS = TableContract(
    name="source_orders",
    schema=_schema(
        order_id=LongType(),
        customer_id=LongType(),
        product_id=LongType(),
        quantity=LongType(),
        total_amount=DecimalType(10, 2),
        updated_at=TimestampNTZType(),
    ),
    key="order_id",
    watermark="updated_at",
    rules={
        "null_primary_key": missing("order_id"),
        "invalid_quantity": missing_or_not_positive("quantity"),
        "negative_total_amount": missing_or_negative("total_amount"),
    },
)

SHOP = (SHOP_PRODUCTS, SHOP_CUSTOMERS, SHOP_ORDERS)
