"""Where the layer tables of a data set live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# What Spark says where the catalog of a name does not exist.
NO_CATALOG = ("CATALOG_NOT_FOUND", "REQUIRES_SINGLE_PART_NAMESPACE")

HISTORY_TABLES = ("dq_results", "dq_run_snapshots", "dq_agent_reports")


@dataclass(frozen=True)
class LayerNames:
    """Names layer tables as folders below ``root``, or as ``root``-qualified tables."""

    root: str
    as_tables: bool = False

    def layer(self, layer: str, table: str) -> str:
        name = f"{layer}_{table}"
        return f"{self.root}.{name}" if self.as_tables else f"{self.root}/{name}"

    def bronze(self, table: str) -> str:
        return self.layer("bronze", table)

    def silver(self, table: str) -> str:
        return self.layer("silver", table)

    def quarantine(self, table: str) -> str:
        return self.layer("quarantine", table)

    def gold(self, table: str) -> str:
        return self.layer("gold", table)

    def history(self, table: str) -> str:
        if table not in HISTORY_TABLES:
            raise ValueError(f"unknown history table {table!r}, expected one of {HISTORY_TABLES}")
        return f"{self.root}.{table}" if self.as_tables else f"{self.root}/{table}"

    def registry(self, tables: list[str]) -> dict[str, str]:
        """Logical name to full name, for the given tables and the history."""
        names = {
            f"{layer}_{t}": self.layer(layer, t)
            for layer in ("bronze", "silver", "quarantine")
            for t in tables
        }
        return names | {t: self.history(t) for t in HISTORY_TABLES}


def ensure_namespace(spark: SparkSession, catalog: str, schema: str) -> str:
    """Create and use ``catalog.schema``; where there is no such catalog, use a plain
    database of the session catalog. Returns the qualifier in use."""
    try:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{catalog}`.`{schema}`")
        spark.sql(f"USE `{catalog}`.`{schema}`")
        return f"{catalog}.{schema}"
    except AnalysisException as error:
        if error.getCondition() not in NO_CATALOG:
            raise
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        spark.sql(f"USE `{schema}`")
        return schema
