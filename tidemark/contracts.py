"""Declared shape of a table: columns, key, watermark column and rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.functions.rules import (
    missing,
    missing_or_negative,
    missing_or_not_positive,
    missing_or_unlike,
    outside,
)


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: StructType
    key: str
    watermark: str
    rules: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required_columns(self) -> list[str]:
        return list(self.required) if self.required is not None else self.columns


def _schema(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


# The category domain, rule names, columns and types of the
# e-commerce source tables.
PRODUCT_CATEGORIES = ("Electronics", "Apparel", "Home & Kitchen", "Books", "Beauty")

PRODUCTS = TableContract(
    name="source_products",
    schema=_schema(
        product_id=IntegerType(),
        product_name=StringType(),
        price=DecimalType(10, 2),
        category=StringType(),
        stock_quantity=IntegerType(),
        updated_at=TimestampType(),
    ),
    key="product_id",
    watermark="updated_at",
    rules={
        "null_primary_key": missing("product_id"),
        "negative_or_zero_price": missing_or_not_positive("price"),
        "invalid_category_enum": outside("category", PRODUCT_CATEGORIES),
    },
)

CUSTOMERS = TableContract(
    name="source_customers",
    schema=_schema(
        customer_id=IntegerType(),
        first_name=StringType(),
        last_name=StringType(),
        email=StringType(),
        city=StringType(),
        created_at=TimestampType(),
    ),
    key="customer_id",
    watermark="created_at",
    rules={
        "null_primary_key": missing("customer_id"),
        "malformed_or_null_email": missing_or_unlike("email", "%@%"),
    },
)

ORDERS = TableContract(
    name="source_orders",
    schema=_schema(
        order_id=IntegerType(),
        customer_id=IntegerType(),
        product_id=IntegerType(),
        quantity=IntegerType(),
        total_amount=DecimalType(10, 2),
        updated_at=TimestampType(),
    ),
    key="order_id",
    watermark="updated_at",
    rules={
        "null_primary_key": missing("order_id"),
        "invalid_quantity": missing_or_not_positive("quantity"),
        "negative_total_amount": missing_or_negative("total_amount"),
    },
)

ECOMMERCE = (PRODUCTS, CUSTOMERS, ORDERS)
