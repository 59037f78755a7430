"""Raw batches to current-state tables."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import TableContract
from tidemark.functions.casting import CAST_FAILED, cast_to_schema, casts
from tidemark.functions.rules import tag_failures
from tidemark.operators.quality import (
    CLEAN,
    FAILED_TOLERANCE,
    OUTCOME,
    REJECTED,
    YieldBelowTolerance,
    as_json,
    counts_frame,
    from_json,
    outcome_counts,
    quality_metrics,
    require_columns,
    sorted_out,
)
from tidemark.plans.concurrent import raise_all, side_by_side
from tidemark.plans.layout import Warehouse
from tidemark.plans.versions import merge_and_publish
from tidemark.sources import bronze, ledger, storage

NO_BATCH = "skipped: no raw batch"
EMPTY_BATCH = "skipped: empty raw batch"
PUBLISHED = "published"
FAILED = "failed"


@dataclass(frozen=True)
class Promotion:
    table: str
    status: str
    version: int | None = None
    metrics: dict = field(default_factory=dict)
    seconds: float = 0.0
    problem: Exception | None = None
    # Rows of the outcome whose text in a column did not parse, by column.
    cast_failures: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return self.metrics["metrics"]["clean_records_promoted"] if self.metrics else 0


def promote_tables(
    spark: SparkSession,
    contracts: Sequence[TableContract],
    warehouse: Warehouse,
    run_id: str,
    fmt: str = "parquet",
    trim: bool = False,
    keep_versions: int | None = None,
    raise_problems: bool = True,
) -> list[Promotion]:
    """Validates the run's batches and merges them into the current state.

    Tables do not wait for each other; failures are raised once all of them
    have been tried and the metrics of all were kept. ``keep_versions`` removes
    older versions of a table once the new one is published. Nothing but the quarantine, the
    metrics and the tables is left of a promotion, however it ends. Without ``raise_problems``
    failed promotions are only returned.
    """

    def promote(contract: TableContract) -> Promotion:
        with storage.owned_scratch(spark):
            return _promote(spark, contract, warehouse, run_id, fmt, trim, keep_versions)

    done = side_by_side(promote, contracts)
    _keep_metrics(spark, [p.metrics for p in done if p.metrics], warehouse)
    ledger.append(
        spark,
        warehouse.ledger,
        run_id,
        ledger.PROMOTED,
        [(p.table, p.rows, p.seconds) for p in done if p.status == PUBLISHED],
    )
    if raise_problems:
        raise_all([p.problem for p in done if p.problem], f"promotion of run {run_id}")
    return done


def _promote(
    spark: SparkSession,
    contract: TableContract,
    warehouse: Warehouse,
    run_id: str,
    fmt: str,
    trim: bool,
    keep_versions: int | None,
) -> Promotion:
    """One pass over the batch writes its clean and its rejected rows side by side.

    They are counted on their way into the files, above the shuffle, where Spark counts a
    re-run task once; how many rows went in is known from the batch's footers. The yield
    gate is checked before the state is touched; quarantined rows are kept either way.
    """
    started = time.monotonic()
    table = contract.name
    payload: dict = {}
    lost: dict[str, int] = {}
    staged = warehouse.staged(table, run_id)
    try:
        raw = bronze.read_run(spark, bronze.run_path(warehouse.root, table, run_id), fmt)
        if raw is None:
            return Promotion(table, NO_BATCH)
        total = raw.count()
        if total == 0:
            return Promotion(table, EMPTY_BATCH)
        require_columns(raw, contract.required_columns, table)
        cast = casts(raw, contract.schema)
        typed = cast_to_schema(raw, contract.schema, trim=trim, report_failures=True)
        columns = [c for c in typed.columns if c != CAST_FAILED]
        rows = sorted_out(tag_failures(typed, contract.rules), contract.rules, [contract.key], contract.watermark)
        written = Observation()
        rows.observe(written, *outcome_counts(contract.rules, cast)).write.mode("overwrite").partitionBy(OUTCOME).parquet(
            staged
        )
        found = written.get
        lost = {c: found[f"{CAST_FAILED}:{c}"] for c in cast if found[f"{CAST_FAILED}:{c}"]}
        counts = counts_frame(spark, total, found, contract.rules)
        payload = json.loads(as_json(quality_metrics(counts, table, run_id)).first()[0])
        # A repeated run may reject fewer rows than the attempt before it.
        storage.remove(spark, warehouse.quarantine(table, run_id))
        if found["quarantined"]:
            storage.move(spark, f"{staged}/{OUTCOME}={REJECTED}", warehouse.quarantine(table, run_id))
        if payload["execution_status"] == FAILED_TOLERANCE:
            share = payload["metrics"]["data_health_yield_percentage"]
            raise YieldBelowTolerance(f"{table}: only {share} % of run {run_id} was promoted")
        latest = typed.select(*[f"`{c}`" for c in columns]).limit(0)
        if found["promoted"]:
            latest = spark.read.schema(latest.schema).parquet(f"{staged}/{OUTCOME}={CLEAN}")
        version = merge_and_publish(
            latest, warehouse.silver(table), [contract.key], contract.watermark, keep_versions, keep_changes=True
        )
    except Exception as problem:
        return Promotion(table, FAILED, metrics=payload, problem=problem, cast_failures=lost)
    finally:
        storage.remove(spark, staged)
    return Promotion(table, PUBLISHED, version, payload, time.monotonic() - started, cast_failures=lost)


def _keep_metrics(spark: SparkSession, payloads: list[dict], warehouse: Warehouse) -> None:
    """Appends one small document per table and run."""
    if payloads:
        documents = F.array(*[F.lit(json.dumps(p)) for p in payloads])
        lines = spark.range(1, numPartitions=1).select(F.explode(documents).alias("value"))
        lines.write.mode("append").text(warehouse.metrics)


def read_metrics(spark: SparkSession, warehouse: Warehouse) -> DataFrame | None:
    """The metrics of all promotions so far, typed; None before the first."""
    if not storage.exists(spark, warehouse.metrics):
        return None
    return from_json(spark.read.text(warehouse.metrics), "value")


def pending_runs(spark: SparkSession, warehouse: Warehouse) -> DataFrame | None:
    """Batches that were extracted but not promoted yet."""
    entries = ledger.read(spark, warehouse.ledger)
    return None if entries is None else ledger.pending(entries)


def promote_pending(
    spark: SparkSession,
    contracts: Sequence[TableContract],
    warehouse: Warehouse,
    fmt: str = "parquet",
    trim: bool = False,
    keep_versions: int | None = None,
) -> dict[str, list[Promotion]]:
    """Promotes what earlier runs left behind, each run from its own folder.

    All runs are tried, oldest first; what failed is raised at the end and stays
    pending. Returns the promotions by run. The pending list has one row per run
    and table, not per record.
    """
    waiting = pending_runs(spark, warehouse)
    runs: dict[str, set[str]] = {}
    for row in waiting.collect() if waiting is not None else []:
        runs.setdefault(row["run_id"], set()).add(row["table_name"])
    done, problems = {}, []
    for run_id, tables in sorted(runs.items()):
        wanted = [c for c in contracts if c.name in tables]
        try:
            done[run_id] = promote_tables(spark, wanted, warehouse, run_id, fmt, trim, keep_versions)
        except Exception as problem:
            problems.append(problem)
    raise_all(problems, "promotion of pending runs")
    return done
