"""Where a warehouse keeps its tables, all under one root."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Warehouse:
    root: str
    pipeline: str = "ecommerce"

    @property
    def state(self) -> str:
        return f"{self.root}/state/etl_metadata"

    @property
    def ledger(self) -> str:
        return f"{self.root}/state/run_ledger"

    @property
    def metrics(self) -> str:
        return f"{self.root}/state/quality_metrics"

    def staged(self, table: str, run_id: str) -> str:
        return f"{self.root}/staging/{table}/run_{run_id}"

    def quarantine(self, table: str, run_id: str) -> str:
        return f"{self.root}/quarantine/{table}/run_{run_id}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    @property
    def gold(self) -> str:
        """Versions of the star schema: its aggregate, and which parts belong to it."""
        return f"{self.root}/gold"

    def gold_part(self, name: str) -> str:
        """Dimensions and days of the fact, under the build that wrote them."""
        return f"{self.root}/gold_parts/{name}"
