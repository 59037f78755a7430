from __future__ import annotations

import datetime
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StructField, StructType, TimestampType

from tidemark.contracts import CUSTOMERS, ECOMMERCE, ORDERS, PRODUCTS
from tidemark.functions.casting import CAST_FAILED, all_text, cast_to_schema
from tidemark.functions.rules import ERRORS, VALID, tag_failures
from tidemark.operators import quality


def tags(spark, rows, schema, rules, key):
    tagged = tag_failures(spark.createDataFrame(rows, schema), rules).collect()
    return {row[key]: (list(row[ERRORS]), row[VALID]) for row in tagged}


def test_contracts_declare_the_source_tables():
    assert [c.name for c in ECOMMERCE] == ["source_products", "source_customers", "source_orders"]
    assert CUSTOMERS.watermark == "created_at"
    assert ORDERS.required_columns == ORDERS.columns


def test_product_rules(spark):
    rows = [
        (1, Decimal("9.99"), "Books"),
        (2, Decimal("0.00"), "Books"),
        (3, None, "Toys"),
        (4, Decimal("1.00"), None),
        (None, Decimal("-1.00"), "Home & Kitchen"),
    ]
    got = tags(
        spark, rows, "product_id int, price decimal(10,2), category string", PRODUCTS.rules,
        "product_id",
    )
    assert got == {
        1: ([], True),
        2: (["negative_or_zero_price"], False),
        3: (["negative_or_zero_price", "invalid_category_enum"], False),
        4: ([], True),  # a missing category is not outside the domain
        None: (["null_primary_key", "negative_or_zero_price"], False),
    }


def test_customer_and_order_rules(spark):
    got = tags(
        spark, [(1, "a@b"), (2, None), (3, "ab"), (4, "")], "customer_id int, email string",
        CUSTOMERS.rules, "customer_id",
    )
    assert [got[i][1] for i in (1, 2, 3, 4)] == [True, False, False, False]
    rows = [
        (1, 1, Decimal("0.00")),
        (2, 0, Decimal("1.00")),
        (3, None, None),
        (4, 2, Decimal("-0.01")),
    ]
    got = tags(
        spark, rows, "order_id int, quantity int, total_amount decimal(10,2)", ORDERS.rules,
        "order_id",
    )
    assert got[1] == ([], True)
    assert got[2] == (["invalid_quantity"], False)
    assert got[3] == (["invalid_quantity", "negative_total_amount"], False)
    assert got[4] == (["negative_total_amount"], False)


def test_no_rules_pass_everything(spark):
    row = tag_failures(spark.createDataFrame([(1,)], "a int"), {}).first()
    assert row[VALID] is True and list(row[ERRORS]) == []


def test_tags_stay_in_generated_code(spark):
    plan = tag_failures(spark.range(3), {"r": "id > 1", "s": "id < 1"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in text


def test_cast_turns_malformed_text_into_null(spark):
    schema = StructType(
        [
            StructField("n", IntegerType()),
            StructField("amount", DecimalType(10, 2)),
            StructField("at", TimestampType()),
        ]
    )
    raw = spark.createDataFrame(
        [
            ("1", "2.345", "2026-01-01 10:00:00", "x"),
            ("12.7", "99999999999", "soon", "y"),
            (" 7 ", None, None, "z"),
        ],
        "n string, amount string, at string, extra string",
    )
    good, bad, padded = cast_to_schema(raw, schema, trim=True, report_failures=True).collect()
    assert (good.n, good.amount, good.extra) == (1, Decimal("2.35"), "x")
    assert good["at"] == datetime.datetime(2026, 1, 1, 10)
    assert (bad.n, bad.amount, bad["at"]) == (None, None, None)
    assert list(bad[CAST_FAILED]) == ["n", "amount", "at"]
    assert padded.n == 7 and list(padded[CAST_FAILED]) == []


def test_all_text():
    assert {f.dataType.typeName() for f in all_text(ORDERS.schema).fields} == {"string"}


def test_missing_column_is_fatal_and_extra_is_not(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    quality.require_columns(df, ["a"], "t")
    with pytest.raises(quality.MissingColumnsError, match="c"):
        quality.require_columns(df, ["a", "c"], "t")


RULES = {"null_key": "id IS NULL", "small": "v < 1 OR v IS NULL"}


def test_routing_keeps_tags_with_rejected_rows_only(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (None, None)], "id int, v int")
    clean, rejected = quality.split_by_rules(df, RULES)
    assert clean.columns == ["id", "v"]
    assert [tuple(r) for r in clean.collect()] == [(1, 1)]
    assert rejected.columns == ["id", "v", "err_null_key", "err_small", ERRORS]
    counts = {r.rule: r.failures for r in quality.failures_by_rule(rejected, RULES).collect()}
    assert counts == {"null_key": 1, "small": 2}


def metrics(spark, rows):
    tagged = tag_failures(spark.createDataFrame(rows, "id int, v int"), RULES)
    counts = quality.tag_counts(tagged, RULES, ["id"])
    return json.loads(quality.as_json(quality.quality_metrics(counts, "t", "r")).first()[0])


def test_metrics_balance(spark):
    got = metrics(spark, [(1, 1), (1, 2), (2, 1), (3, 0)])
    assert got == {
        "pipeline_run_id": "r",
        "table_name": "t",
        "metrics": {
            "input_records_extracted": 4,
            "clean_records_promoted": 2,
            "quarantined_records_isolated": 1,
            "duplicate_records_purged": 1,
            "data_health_yield_percentage": 50.0,
        },
        "failures_by_rule_breakdown": {"null_key": 0, "small": 1},
        "execution_status": quality.FAILED_TOLERANCE,
    }


def test_breakdown_is_empty_without_quarantine(spark):
    got = metrics(spark, [(1, 1)])
    assert got["failures_by_rule_breakdown"] == {}
    assert got["execution_status"] == quality.PROCEEDED


def test_metrics_of_nothing(spark):
    got = metrics(spark, [])
    assert got["metrics"]["data_health_yield_percentage"] == 0.0
    assert got["execution_status"] == quality.PROCEEDED


@pytest.mark.parametrize(
    ("promoted", "status"),
    [(8999, quality.FAILED_TOLERANCE), (9000, quality.PROCEEDED), (10000, quality.PROCEEDED)],
)
def test_gate_boundary(spark, promoted, status):
    row = spark.range(1).select(
        F.lit(promoted).cast("long").alias("p"), F.lit(10000).cast("long").alias("n")
    )
    pct = quality.yield_percentage(F.col("p"), F.col("n"))
    got = row.select(pct.alias("pct"), quality.status_of(pct, F.col("n")).alias("status")).first()
    assert got.pct == Decimal(promoted) / 100
    assert got.status == status
