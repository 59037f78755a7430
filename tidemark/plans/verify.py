"""Rows that extraction by a watermark has never seen: late, changed in place, or deleted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import TableContract
from tidemark.functions.casting import cast_to_schema
from tidemark.functions.rules import any_failure
from tidemark.operators.extract import watermark_literal
from tidemark.operators.reconcile import CHANGED, MISSING, differences
from tidemark.plans.layout import Warehouse
from tidemark.sources import bronze, ledger, snapshots, state


def lost_rows(
    spark: SparkSession, source: DataFrame, contract: TableContract, warehouse: Warehouse, trim: bool = False
) -> DataFrame | None:
    """Keys in which the source, as far as its stored watermark, is not what the current state holds.

    ``missing`` keys came late, with a time stamp an extraction had passed, or without one;
    ``changed`` ones were changed without a newer time stamp; ``deleted`` ones are gone from the source, or
    break a rule by now. Rows that break a rule are no loss: they are in quarantine.
    None before the table's first promotion.
    """
    current = snapshots.read_current(spark, warehouse.silver(contract.name))
    if current is None:
        return None
    return differences(_promoted(spark, source, contract, warehouse, trim), current, contract.key, current.columns)


def recover(
    spark: SparkSession, source: DataFrame, contract: TableContract, warehouse: Warehouse, run_id: str
) -> int:
    """Writes the source's rows of missing and changed keys as a raw batch of a run, ready to be promoted.

    Returns their number. A promotion takes a row in unless the state's row of the key is newer.
    """
    lost = lost_rows(spark, source, contract, warehouse)
    if lost is None:
        return 0
    keys = lost.filter(F.col("difference").isin(MISSING, CHANGED)).select(contract.key)
    batch = source.join(keys, contract.key, "left_semi").select(*source.columns)
    path = bronze.run_path(warehouse.root, contract.name, run_id)
    rows = bronze.write_run(batch, path)
    ledger.append(spark, warehouse.ledger, run_id, ledger.EXTRACTED, [(contract.name, rows, 0.0)])
    return rows


def lost_by_table(
    spark: SparkSession, sources: Mapping[str, DataFrame], contracts: Sequence[TableContract], warehouse: Warehouse
) -> dict[str, dict[str, int]]:
    """How many keys of each table differ, by kind; tables without any are left out."""
    out = {}
    for contract in contracts:
        lost = lost_rows(spark, sources[contract.name], contract, warehouse)
        counted = {} if lost is None else {r[0]: r[1] for r in lost.groupBy("difference").count().collect()}
        if counted:
            out[contract.name] = counted
    return out


def _promoted(
    spark: SparkSession, source: DataFrame, contract: TableContract, warehouse: Warehouse, trim: bool
) -> DataFrame:
    """The source's rows that should be in the state by now."""
    known = state.last_runs(spark, warehouse.state, warehouse.pipeline)
    mark = known.get(contract.name, state.NEVER_RUN).watermark
    ts = contract.watermark
    due = source.filter(F.col(ts).isNull() | (F.col(ts) <= watermark_literal(source, ts, mark)))
    return cast_to_schema(due, contract.schema, trim=trim).filter(~any_failure(contract.rules))
