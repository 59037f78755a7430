"""Source tables to raw batches."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.contracts import TableContract
from tidemark.operators.extract import extract_window, high_watermark, window_bounds, window_parts
from tidemark.plans.concurrent import raise_all, side_by_side
from tidemark.plans.layout import Warehouse
from tidemark.sources import bronze, ledger, state

EMPTY_SOURCE = "skipped: empty source"
NOTHING_NEW = "skipped: no new rows"
ALREADY_DONE = "skipped: this run has extracted the table"


@dataclass(frozen=True)
class Extraction:
    table: str
    status: str
    low: int
    high: int | None = None
    rows: int = 0
    seconds: float = 0.0
    problem: Exception | None = None


@dataclass(frozen=True)
class RawFormat:
    """How raw batches are read and stored. ``ordered`` sorts the whole batch by the
    watermark column, at the price of a shuffle. ``parts`` reads a Parquet batch as that many
    windows between quantiles of the watermark column, for sources that answer each by an index or
    by row groups; the files of a part follow those of the part before."""

    name: str = "parquet"
    ordered: bool = False
    parts: int = 1
    rows_per_file: int = bronze.DEFAULT_ROWS_PER_FILE


def extract_tables(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    contracts: Sequence[TableContract],
    warehouse: Warehouse,
    run_id: str,
    raw: RawFormat = RawFormat(),
    raise_problems: bool = True,
) -> list[Extraction]:
    """Writes each table's rows above its stored watermark to the run's folder.

    The high mark is taken before the scan, so rows arriving meanwhile wait for
    the next run. A skipped table writes nothing, a failed one keeps its old
    watermark, and a run repeated after success keeps the batches it wrote.
    Failures are raised once every table has been tried and recorded, or only returned
    without ``raise_problems``.
    """
    known = state.last_runs(spark, warehouse.state, warehouse.pipeline)

    def extract(contract: TableContract) -> Extraction:
        last = known.get(contract.name, state.NEVER_RUN)
        return _extract(sources[contract.name], contract, warehouse, run_id, raw, last)

    done = side_by_side(extract, contracts)
    moved = [e for e in done if e.status == state.SUCCESS]
    ledger.append(
        spark,
        warehouse.ledger,
        run_id,
        ledger.EXTRACTED,
        [(e.table, e.rows, e.seconds) for e in moved],
    )
    state.record(
        spark,
        warehouse.state,
        warehouse.pipeline,
        run_id,
        [(e.table, e.high, e.status) for e in moved]
        + [(e.table, e.low, e.status) for e in done if e.problem],
    )
    if raise_problems:
        raise_all([e.problem for e in done if e.problem], f"extraction of run {run_id}")
    return done


def _extract(
    source: DataFrame,
    contract: TableContract,
    warehouse: Warehouse,
    run_id: str,
    raw: RawFormat,
    last: state.LastRun,
) -> Extraction:
    started = time.monotonic()
    table, ts, low = contract.name, contract.watermark, last.watermark
    if last.status == state.SUCCESS and last.run_id == run_id:
        return Extraction(table, ALREADY_DONE, low)
    try:
        high = high_watermark(source, ts)
        if high is None:
            return Extraction(table, EMPTY_SOURCE, low)
        if high <= low:
            return Extraction(table, NOTHING_NEW, low, high)
        path = bronze.run_path(warehouse.root, table, run_id)
        if raw.parts > 1 and raw.name == "parquet" and not raw.ordered:
            parts = window_parts(source, ts, window_bounds(source, ts, low, high, raw.parts))
            rows = bronze.write_parts(parts, path, raw.rows_per_file)
        else:
            order = [ts, contract.key] if raw.ordered else None
            rows = bronze.write_run(
                extract_window(source, ts, low, high), path, raw.name, raw.rows_per_file, order
            )
    except Exception as problem:
        return Extraction(table, state.failed(str(problem)), low, problem=problem)
    return Extraction(table, state.SUCCESS, low, high, rows, time.monotonic() - started)
