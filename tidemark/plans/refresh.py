"""One whole run: extract, promote, build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.contracts import TableContract
from tidemark.plans.extract import Extraction, RawFormat, extract_tables
from tidemark.plans.gold import GoldBuild, build_gold
from tidemark.plans.layout import Warehouse
from tidemark.plans.promote import Promotion, promote_tables
from tidemark.plans.verify import lost_by_table
from tidemark.sources import storage


@dataclass(frozen=True)
class Refresh:
    extractions: list[Extraction]
    promotions: list[Promotion]
    gold: GoldBuild
    # Keys that extraction has missed, by table and kind, if they were looked for.
    lost: dict[str, dict[str, int]] | None = None


def load(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    contracts: Sequence[TableContract],
    warehouse: Warehouse,
    run_id: str,
    raw: RawFormat = RawFormat(),
    trim: bool = False,
    keep_versions: int | None = None,
) -> tuple[list[Extraction], list[Promotion]]:
    """Extracts every table, then promotes every table; see their own functions for the options."""
    # Object stores are refused before anything is written; put the warehouse on HDFS or a shared disk.
    storage.require_exclusive(spark, warehouse.root)
    extractions = extract_tables(spark, sources, contracts, warehouse, run_id, raw)
    promotions = promote_tables(spark, contracts, warehouse, run_id, raw.name, trim, keep_versions)
    return extractions, promotions


def refresh(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    contracts: tuple[TableContract, TableContract, TableContract],
    warehouse: Warehouse,
    run_id: str,
    raw: RawFormat = RawFormat(),
    trim: bool = False,
    keep_versions: int | None = None,
    check_keys: bool = False,
    find_lost: bool = False,
) -> Refresh:
    """Runs the three stages in order; ``contracts`` are products, customers
    and orders, and ``sources`` holds a table for each by its name.

    ``trim`` takes white space off text before it is cast, ``keep_versions`` leaves that many
    versions of every table, ``check_keys`` looks through the keys of the whole fact, and ``find_lost``
    counts the rows extraction has missed, which reads the sources once."""
    extractions, promotions = load(spark, sources, contracts, warehouse, run_id, raw, trim, keep_versions)
    names = tuple(c.name for c in contracts)
    gold = build_gold(spark, warehouse, run_id, names=names, check_keys=check_keys, keep_versions=keep_versions)
    lost = lost_by_table(spark, sources, contracts, warehouse) if find_lost else None
    return Refresh(extractions, promotions, gold, lost)
