"""Declarations: what a table must look like and how its rows are judged.

Predicates and derived values are SQL text, so a contract is plain data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """Reject rows for which ``bad`` holds, or cannot be decided (NULL)."""

    reason: str
    bad: str


@dataclass(frozen=True)
class Lookup:
    """Reject rows whose ``column`` has no partner in the parent table."""

    column: str
    parent_column: str
    reason: str


@dataclass(frozen=True)
class CodeTable:
    """Values that a row's ``column`` stands for, from a table with one row for each
    ``code``. ``values`` maps new columns to the table's."""

    column: str
    code: str
    values: Mapping[str, str]


@dataclass(frozen=True)
class Intake:
    """How bronze rows of one table are split into silver and quarantine.

    ``order_by`` decides which copy of a key came first; of copies that tie for first
    place the remaining columns decide. A ``derived`` expression may depend on the
    bronze schema, and may use the values of ``codes``. ``fills`` replace silver
    columns.
    """

    name: str
    key: tuple[str, ...]
    order_by: tuple[str, ...]
    duplicate_reason: str
    rules: tuple[Rule, ...]
    bronze_columns: tuple[str, ...]
    silver_columns: tuple[str, ...]
    lookup: Lookup | None = None
    derived: tuple[tuple[str, str | Callable[[StructType], str]], ...] = ()
    fills: Mapping[str, str] = field(default_factory=dict)
    codes: CodeTable | None = None


@dataclass(frozen=True)
class CheckSpec:
    """Which checks a silver table has to pass, and against what limits."""

    table: str
    bronze_columns: tuple[str, ...] | None = None
    silver_columns: tuple[str, ...] | None = None
    max_null_pct: Mapping[str, float] = field(default_factory=dict)
    unique_columns: tuple[str, ...] = ()
    email_column: str | None = None
    positive_column: str | None = None
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    max_drop_pct: float = 10.0
    warn_drop_pct: float = 5.0
    fail_drop_pct: float = 15.0
    flag_extra_columns: bool = True
    long_columns: tuple[str, ...] = ()

    @classmethod
    def from_mapping(
        cls, table: str, config: Mapping[str, Any], thresholds: Mapping[str, Any] | None = None
    ) -> CheckSpec:
        """Build a spec from an already parsed configuration mapping."""
        rules = config.get("rules", {})
        expected = config.get("expected_columns", {})
        limits = thresholds or {}
        allowed = dict(rules.get("allowed_values", {}))
        if "allowed_status" in rules:
            allowed["status"] = rules["allowed_status"]
        return cls(
            table=table,
            bronze_columns=_names(expected.get("bronze")),
            silver_columns=_names(expected.get("silver")),
            max_null_pct={c: float(v) for c, v in rules.get("max_null_pct", {}).items()},
            unique_columns=tuple(rules.get("unique_columns", ())),
            email_column="email" if rules.get("email_format") else None,
            positive_column="amount" if rules.get("amount_positive") else None,
            allowed={c: tuple(v) for c, v in allowed.items()},
            max_drop_pct=float(rules.get("max_row_drop_pct", 10)),
            warn_drop_pct=float(limits.get("warn_row_drop_pct", 5)),
            fail_drop_pct=float(limits.get("fail_row_drop_pct", 15)),
        )


@dataclass(frozen=True)
class StageModel:
    """An ordered process: its stages, the codes that lead to them, its targets."""

    stages: tuple[str, ...]
    code_to_stage: Mapping[str, str]
    e2e_target_days: float = 60.0
    d2d_target_days: float = 2.0
    max_null_pct: Mapping[str, float] = field(
        default_factory=lambda: {"batch_id": 0.0, "stage": 0.0, "start_ts": 0.0, "end_ts": 0.0}
    )

    @property
    def first(self) -> str:
        return self.stages[0]

    @property
    def last(self) -> str:
        return self.stages[-1]

    @property
    def stage_order(self) -> dict[str, int]:
        return {stage: at for at, stage in enumerate(self.stages, start=1)}

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], code_map_key: str) -> StageModel:
        """Build a model from an already parsed configuration mapping."""
        targets = config.get("targets", {})
        limits = config.get("rules", {}).get("max_null_pct_stages", {})
        return cls(
            stages=tuple(config["stages"]),
            code_to_stage={str(k): v for k, v in config[code_map_key].items()},
            e2e_target_days=float(targets.get("e2e_days", 60)),
            d2d_target_days=float(targets.get("d2d_days", 2)),
            max_null_pct={c: float(v) for c, v in limits.items()},
        )


def _names(columns: Sequence[str] | None) -> tuple[str, ...] | None:
    return None if columns is None else tuple(columns)
