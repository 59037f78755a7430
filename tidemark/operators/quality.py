"""Schema checks, quarantine routing and quality metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.casting import CAST_FAILED
from tidemark.functions.rules import ERRORS, VALID, any_failure, error_column, tag_failures
from tidemark.operators.latest import tie_breakers

# The gate, the two statuses and the metric names of the payload.
MINIMUM_YIELD = 90.0
PROCEEDED = "PROCEEDED"
FAILED_TOLERANCE = "FAILED_TOLERANCE"
COUNT_FIELDS = (
    "input_records_extracted",
    "clean_records_promoted",
    "quarantined_records_isolated",
    "duplicate_records_purged",
)
YIELD_FIELD = "data_health_yield_percentage"

# What becomes of a row of a batch.
OUTCOME, CLEAN, REJECTED = "outcome", "clean", "rejected"
_ALONE, _RANK = "_alone", "_rank"


class MissingColumnsError(ValueError):
    """The raw batch lacks columns its contract requires."""


class YieldBelowTolerance(RuntimeError):
    """Too few rows of a batch survived validation and deduplication."""


class Routed(NamedTuple):
    clean: DataFrame
    quarantined: DataFrame


def require_columns(df: DataFrame, required: Sequence[str], table: str) -> None:
    """Fails on missing columns; further columns are tolerated."""
    absent = [name for name in required if name not in df.columns]
    if absent:
        raise MissingColumnsError(f"table {table} is missing columns: {absent}")


def route(tagged: DataFrame, rules: Mapping[str, str]) -> Routed:
    """Splits tagged rows: clean rows without the tags, rejected rows with them."""
    tags = [error_column(rule) for rule in rules]
    clean = tagged.filter(F.col(VALID)).drop(*tags, ERRORS, VALID)
    quarantined = tagged.filter(~F.col(VALID)).drop(VALID)
    return Routed(clean, quarantined)


def split_by_rules(df: DataFrame, rules: Mapping[str, str]) -> Routed:
    """The two sides of an untagged table. The rejected side filters by the bare
    predicates, which can reach the scan, and only its rows are tagged."""
    bad = reduce(or_, [F.expr(p) for p in rules.values()], F.lit(False))
    return Routed(df.filter(~any_failure(rules)), tag_failures(df.filter(bad), rules).drop(VALID))


def sorted_out(tagged: DataFrame, rules: Mapping[str, str], keys: Sequence[str], ts: str) -> DataFrame:
    """Every rejected row, and of the valid rows the newest of each key, told apart by ``outcome``.

    One shuffle for both: valid rows meet by their key, where all but one per key and map task
    have already gone, and each rejected row is a group of its own, so that neither
    a frequent key nor many rejected rows gather in one task.
    """
    tags = [*map(error_column, rules), ERRORS, VALID, CAST_FAILED]
    plain = [c for c in tagged.columns if c not in tags]
    alone = F.when(~F.col(VALID), F.monotonically_increasing_id())
    order = [F.col(f"`{ts}`").desc_nulls_last(), *tie_breakers(tagged.select(*[f"`{c}`" for c in plain]), [*keys, ts])]
    window = Window.partitionBy(*[f"`{k}`" for k in keys], _ALONE).orderBy(*order)
    ranked = tagged.withColumn(_ALONE, alone).withColumn(_RANK, F.row_number().over(window))
    outcome = F.when(F.col(VALID), F.lit(CLEAN)).otherwise(F.lit(REJECTED))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK, _ALONE).withColumn(OUTCOME, outcome).drop(VALID)


def outcome_counts(rules: Mapping[str, str], cast_columns: Sequence[str] = ()) -> list[Column]:
    """What to observe of the rows of :func:`sorted_out`: rows by outcome, and failures per rule and cast."""
    return [
        F.count_if(F.col(OUTCOME) == CLEAN).alias("promoted"),
        F.count_if(F.col(OUTCOME) == REJECTED).alias("quarantined"),
        *[F.count(error_column(rule)).alias(error_column(rule)) for rule in rules],
        *[F.count_if(F.array_contains(CAST_FAILED, c)).alias(f"{CAST_FAILED}:{c}") for c in cast_columns],
    ]


def counts_frame(spark: SparkSession, total: int, observed: Mapping[str, int], rules: Mapping[str, str]) -> DataFrame:
    """The row of counts that :func:`quality_metrics` takes, from observed figures."""
    quarantined = observed["quarantined"]
    none = F.create_map().cast("map<string,bigint>")
    pairs = [part for rule in rules for part in (F.lit(rule), F.lit(observed[error_column(rule)]).cast("long"))]
    return spark.range(1, numPartitions=1).select(
        F.lit(total).cast("long").alias("input"), F.lit(quarantined).cast("long").alias("quarantined"),
        F.lit(total - quarantined).cast("long").alias("clean"),
        F.lit(observed["promoted"]).cast("long").alias("promoted"),
        (F.create_map(*pairs) if pairs and quarantined else none).alias("failures_by_rule_breakdown"),
    )


def failures_by_rule(quarantined: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule with the number of rows it rejected, in one pass."""
    counts = quarantined.agg(
        *[F.count(error_column(rule)).alias(error_column(rule)) for rule in rules]
    )
    pairs = [
        F.struct(F.lit(rule).alias("rule"), F.col(error_column(rule)).alias("failures"))
        for rule in rules
    ]
    return counts.select(F.inline(F.array(*pairs)))


def tag_counts(tagged: DataFrame, rules: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """One row: input, quarantined and clean rows and failures per rule.

    With ``keys`` it also holds ``promoted``, the rows deduplication keeps:
    one per distinct key, counted in the same pass without ranking any rows.
    ``failures_by_rule_breakdown`` is empty when nothing was quarantined.
    """
    counts = [
        F.count(F.lit(1)).alias("input"),
        F.count_if(~F.col(VALID)).alias("quarantined"),
        F.count_if(F.col(VALID)).alias("clean"),
        *[F.count(error_column(rule)).alias(error_column(rule)) for rule in rules],
    ]
    if keys:
        # A struct of the keys is never NULL, so a NULL key counts as one key.
        counts.append(F.count_distinct(F.when(F.col(VALID), F.struct(*keys))).alias("promoted"))
    none = F.create_map().cast("map<string,bigint>")
    pairs = [part for rule in rules for part in (F.lit(rule), F.col(error_column(rule)))]
    breakdown = F.create_map(*pairs) if pairs else none
    return tagged.agg(*counts).select(
        "input",
        "quarantined",
        "clean",
        *(["promoted"] if keys else []),
        F.when(F.col("quarantined") > 0, breakdown)
        .otherwise(none)
        .alias("failures_by_rule_breakdown"),
    )


def yield_percentage(promoted: Column, total: Column) -> Column:
    """Share of the input that was promoted, in percent with two decimals, ties
    rounded away from zero; 0 without input."""
    share = promoted.cast("decimal(20,0)") * F.lit(100) / total.cast("decimal(20,0)")
    return F.round(F.when(total > 0, share).otherwise(F.lit(0)), 2).cast("decimal(5,2)")


def status_of(yield_pct: Column, total: Column) -> Column:
    below = (total > 0) & (yield_pct < F.lit(MINIMUM_YIELD))
    return F.when(below, F.lit(FAILED_TOLERANCE)).otherwise(F.lit(PROCEEDED))


def quality_metrics(counts: DataFrame, table: str, run_id: str) -> DataFrame:
    """The nested metrics row of a batch, from its row of counts."""
    yield_pct = yield_percentage(F.col("promoted"), F.col("input"))
    values = (
        F.col("input"),
        F.col("promoted"),
        F.col("quarantined"),
        F.col("clean") - F.col("promoted"),
    )
    metrics = F.struct(
        *[value.alias(name) for name, value in zip(COUNT_FIELDS, values)],
        yield_pct.alias(YIELD_FIELD),
    )
    return counts.select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(table).alias("table_name"),
        metrics.alias("metrics"),
        F.col("failures_by_rule_breakdown"),
        status_of(yield_pct, F.col("input")).alias("execution_status"),
    )


def as_json(metrics: DataFrame, name: str = "payload") -> DataFrame:
    return metrics.select(F.to_json(F.struct("*")).alias(name))


METRICS_SCHEMA = (
    "pipeline_run_id string, table_name string, "
    "metrics struct<input_records_extracted: bigint, clean_records_promoted: bigint, "
    "quarantined_records_isolated: bigint, duplicate_records_purged: bigint, "
    "data_health_yield_percentage: decimal(5,2)>, "
    "failures_by_rule_breakdown map<string,bigint>, execution_status string"
)


def from_json(payloads: DataFrame, name: str = "payload") -> DataFrame:
    """The typed rows of :func:`as_json` documents; rules are a map, so new ones need no new column.

    A document that is not such a payload raises.
    """
    return payloads.select(F.from_json(name, METRICS_SCHEMA, {"mode": "FAILFAST"}).alias("m")).select("m.*")


def yield_history(metrics: DataFrame) -> DataFrame:
    """Each run's yield per table with the run before it and the change; repeated runs count by themselves."""
    before = Window.partitionBy("table_name").orderBy("pipeline_run_id", "metrics")
    share = F.col(f"metrics.{YIELD_FIELD}")
    return metrics.select(
        "table_name", "pipeline_run_id", "execution_status", *[f"metrics.{c}" for c in COUNT_FIELDS],
        share.alias(YIELD_FIELD), F.lag("pipeline_run_id").over(before).alias("previous_run"),
        (share - F.lag(share).over(before)).alias("yield_change"),
    )


def rule_history(metrics: DataFrame) -> DataFrame:
    """Failures of every rule a table has ever had, in each of its runs, and the change from the run before.

    A rule a run does not list counts 0 there. One row per run and rule of the same table.
    """
    rules = metrics.select("table_name", F.explode(F.map_keys("failures_by_rule_breakdown")).alias("rule")).distinct()
    before = Window.partitionBy("table_name", "rule").orderBy("pipeline_run_id", "failures")
    listed = metrics.join(rules, "table_name").select(
        "table_name", "pipeline_run_id", "rule",
        F.coalesce(F.col("failures_by_rule_breakdown")[F.col("rule")], F.lit(0).cast("long")).alias("failures"),
    )
    return listed.withColumn("change", F.col("failures") - F.lag("failures").over(before))
