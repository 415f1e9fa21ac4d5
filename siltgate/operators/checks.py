"""Data-quality checks: one aggregate per table, one result row per check.

A check names the aggregates it needs and says, as SQL over them, how its row
reads. All checks of a table share a single pass: their aggregates are computed
together into one row, which is then unfolded into ``(check_no, check_name,
status, message, metrics_json)`` rows. Nothing is collected.

Checks read a *tagged* frame: rows of silver and quarantine with a flag for either, and
how many rows of bronze each stands for. It comes either from separate layer tables
(``tag_layers``) or straight from a classified table (``tag_classified``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.contracts import CheckSpec, Intake, StageModel
from siltgate.functions import predicates as bad
from siltgate.functions import sql
from siltgate.functions.numbers import percentage, percentage_2, percentage_text
from siltgate.operators.classify import REASON, silver_projection
from siltgate.operators.lookups import count_unmatched

BRONZE_ROWS, IN_SILVER, IN_QUARANTINE = "_bronze_rows", "_in_silver", "_in_quarantine"
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


class QualityGateError(RuntimeError):
    """Raised by the gate when a run's overall status is FAIL."""


@dataclass(frozen=True)
class Check:
    """``status``, ``message`` and ``metrics`` are SQL over the ``aggregates``, and over
    the counts of distinct values of the expressions in ``distinct``."""

    name: str
    status: str
    message: str
    aggregates: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)


# ---------------------------------------------------------------- evaluation


def evaluate(df: DataFrame, checks: Sequence[Check], first_no: int = 1) -> DataFrame:
    """Run the checks over ``df`` in one aggregation; all distinct counts are taken
    together in one more (``_distinct_counts``), which also gives the row counts, so that
    checks of uniqueness alone need one scan. In one aggregate Spark would shuffle a
    copy of every row for each distinct count."""
    aggregates, distinct = {"_rows": "count(1)"}, {}
    for check in checks:
        aggregates.update(check.aggregates)
        distinct.update(check.distinct)
    if not distinct:
        counted = df.selectExpr(*[f"{how} AS {sql.name(alias)}" for alias, how in aggregates.items()])
        return _unfold(counted, checks, first_no)
    counts = _distinct_counts(df, distinct)
    more = {a: how for a, how in aggregates.items() if a not in counts.columns}
    if more:
        rest = df.selectExpr(*[f"{how} AS {sql.name(alias)}" for alias, how in more.items()])
        united = rest.unionByName(counts, allowMissingColumns=True)
        counts = united.selectExpr(*[f"max({sql.name(c)}) AS {sql.name(c)}" for c in united.columns])
    return _unfold(counts, checks, first_no)


def _distinct_counts(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """One row: ``_rows``, ``silver_n``, and for each name how many values, NULL being one,
    its expression has in silver rows.

    Every row gives a pair (number of the expression, value as text) for each. Pairs fold
    on the map side, so a hot value leaves each task as one row, and are counted by
    number; rows counted with the first expression's pairs are all rows.
    """
    pairs = [
        f"named_struct('_no', {no}, '_in', {IN_SILVER}, '_value', {how})"
        for no, how in enumerate(values.values())
    ]
    folded = (
        df.selectExpr(f"inline(array({', '.join(pairs)}))")
        .groupBy("_no", "_in", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    of_first = "if(_no = 0, _n, 0L)"
    return folded.selectExpr(
        f"coalesce(sum({of_first}), 0L) AS _rows",
        f"coalesce(sum(if(_in, {of_first}, 0L)), 0L) AS silver_n",
        *[f"count_if(_in AND _no = {no}) AS {sql.name(name)}" for no, name in enumerate(values)],
    )


def _value_text(df: DataFrame, column: str, long: bool) -> str:
    """A column's values as text, equal where the values are."""
    source, kind = sql.name(column), df.schema[column].dataType
    if long:
        return f"sha2({source}, 256)"
    if isinstance(kind, T.StringType):
        return source
    if isinstance(kind, T.BinaryType):
        return f"hex({source})"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return f"cast({source} + cast(0 AS {kind.simpleString()}) AS STRING)"  # -0.0 is 0.0
    if isinstance(kind, T.TimestampType):
        return f"cast(unix_micros({source}) AS STRING)"  # local times repeat
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return f"if({source} IS NULL, NULL, to_json(named_struct('v', {source})))"
    return f"cast({source} AS STRING)"


def _unfold(counted: DataFrame, checks: Sequence[Check], first_no: int = 1) -> DataFrame:
    rows = []
    for number, check in enumerate(checks, start=first_no):
        pairs = ", ".join(f"{sql.text(k)}, {v}" for k, v in check.metrics.items())
        metrics = f"to_json(named_struct({pairs}))" if pairs else "'{}'"
        rows.append(
            f"named_struct('check_no', {number}, 'check_name', {sql.text(check.name)}, 'status', "
            f"{check.status}, 'message', {check.message}, 'metrics_json', {metrics})"
        )
    return counted.selectExpr(f"inline(array({', '.join(rows)}))")


def pass_if(condition: str, otherwise: str = FAIL) -> str:
    return f"if({condition}, '{PASS}', '{otherwise}')"


# ------------------------------------------------------------------- tagging


def tag_layers(
    silver: DataFrame, bronze: DataFrame | None = None, quarantine: DataFrame | None = None
) -> DataFrame:
    """Rows of separate layer tables under one schema. Bronze is one row, its count."""
    tagged = _flags(silver, silver=True)
    if quarantine is not None:
        kept = [c for c in quarantine.columns if c == "rejection_reason"]
        tagged = tagged.unionByName(
            _flags(quarantine.select(*kept), quarantine=True), allowMissingColumns=True
        )
    if bronze is not None:
        counted = bronze.agg(F.count(F.lit(1)).alias(BRONZE_ROWS))
        tagged = tagged.drop(BRONZE_ROWS).unionByName(counted, allowMissingColumns=True)
    return tagged


def _flags(df: DataFrame, *, silver: bool = False, quarantine: bool = False) -> DataFrame:
    flags = {IN_SILVER: silver, IN_QUARANTINE: quarantine}
    return df.selectExpr(
        "*", f"0L AS {BRONZE_ROWS}", *[f"{'true' if on else 'false'} AS {n}" for n, on in flags.items()]
    )


def as_silver(df: DataFrame) -> DataFrame:
    """A single table, to run row-level checks on it whatever layer it is."""
    return _flags(df, silver=True)


def tag_classified(classified: DataFrame, intake: Intake) -> DataFrame:
    """The same from a classified table: every row is bronze and one of the others."""
    accepted = F.col(REASON).isNull()
    return classified.select(
        *silver_projection(intake),
        F.col(REASON).alias("rejection_reason"),
        F.lit(1).cast("long").alias(BRONZE_ROWS),
        accepted.alias(IN_SILVER),
        (~accepted).alias(IN_QUARANTINE),
    )


# ---------------------------------------------------------- checks of a table
# Check names and message layouts are fixed values: downstream reports and
# history queries rely on them.

_LAYER_COUNTS = {
    "bronze_n": f"coalesce(sum({BRONZE_ROWS}), 0L)",
    "silver_n": f"count_if({IN_SILVER})",
    "quarantine_n": f"count_if({IN_QUARANTINE})",
}
_SILVER_COUNT = {"silver_n": _LAYER_COUNTS["silver_n"]}


def _silver_count_if(condition: str) -> str:
    return f"count_if({IN_SILVER} AND {condition})"


def row_count_delta(spec: CheckSpec) -> Check:
    """Share of bronze rows that did not reach silver, against three limits."""
    dropped = "greatest(bronze_n - silver_n, 0L)"
    pct = percentage(dropped, "bronze_n")
    fail, most, warn = (
        sql.double(v) for v in (spec.fail_drop_pct, spec.max_drop_pct, spec.warn_drop_pct)
    )
    return Check(
        name="row_count_delta",
        status=f"CASE WHEN {pct} >= {fail} OR {pct} > {most} THEN '{FAIL}'"
        f" WHEN {pct} >= {warn} THEN '{WARN}' ELSE '{PASS}' END",
        message=sql.message(
            "Bronze={bronze_n}, Silver={silver_n}, dropped={dropped} ({pct}%)",
            dropped=dropped,
            pct=percentage_text(dropped, "bronze_n"),
        ),
        aggregates=_LAYER_COUNTS,
        metrics={
            "bronze_count": "bronze_n",
            "silver_count": "silver_n",
            "dropped": dropped,
            "drop_pct": percentage_2(dropped, "bronze_n"),
            "max_drop_pct": most,
        },
    )


def quarantine_reconciliation(has_reason: bool = True) -> Check:
    """Silver and quarantine together account for bronze, and every rejection says why.
    Without a reason column all rejections count as unexplained."""
    unexplained = bad.blank("rejection_reason") if has_reason else "true"
    return Check(
        name="quarantine_reconciliation",
        status=pass_if("silver_n + quarantine_n = bronze_n AND blank_reasons = 0"),
        message=sql.message(
            "Bronze={bronze_n}, Silver={silver_n}, Quarantine={quarantine_n}, "
            "accounted={accounted}, blank_reasons={blank_reasons}",
            accounted="(silver_n + quarantine_n)",
        ),
        aggregates=_LAYER_COUNTS
        | {"blank_reasons": f"count_if({IN_QUARANTINE} AND {unexplained})"},
        metrics={
            "bronze_count": "bronze_n",
            "silver_count": "silver_n",
            "quarantine_count": "quarantine_n",
            "accounted": "silver_n + quarantine_n",
            "blank_rejection_reasons": "blank_reasons",
        },
    )


def schema_drift(
    bronze_columns: Sequence[str],
    silver_columns: Sequence[str],
    expected_bronze: Sequence[str] | None = None,
    expected_silver: Sequence[str] | None = None,
    *,
    flag_extra: bool = True,
) -> Check:
    """Actual against expected column names; a matter of metadata, not of rows."""
    bronze, silver = set(bronze_columns), set(silver_columns)
    dropped, added = sorted(bronze - silver), sorted(silver - bronze)
    planned: set[str] = set()
    if expected_bronze is not None and expected_silver is not None:
        planned = set(expected_bronze) - set(expected_silver)
    issues = []
    for layer, actual, expected in (
        ("bronze", bronze, expected_bronze),
        ("silver", silver, expected_silver),
    ):
        if expected is None:
            continue
        missing, extra = sorted(set(expected) - actual), sorted(actual - set(expected))
        if missing:
            issues.append(f"{layer} missing expected columns: {_listing(missing)}")
        if extra and flag_extra:
            issues.append(f"{layer} unexpected columns: {_listing(extra)}")
    unplanned = sorted(set(dropped) - planned)
    if unplanned:
        issues.append(f"unexpected columns dropped: {_listing(unplanned)}")
    notes = []
    if dropped:
        notes.append(f"columns dropped bronze to silver: {_listing(dropped)}")
    if added:
        notes.append(f"columns added in silver: {_listing(added)}")
    return Check(
        name="schema_drift",
        status=sql.text(FAIL if issues else PASS),
        message=sql.text("; ".join(notes + issues) or "Schemas align with expectations"),
        metrics={
            "bronze_columns": sql.strings(sorted(bronze)),
            "silver_columns": sql.strings(sorted(silver)),
            "dropped_columns": sql.strings(dropped),
            "added_columns": sql.strings(added),
            "expected_dropped": sql.strings(sorted(planned)),
        },
    )


def _listing(names: Sequence[str]) -> str:
    return "[" + ", ".join(names) + "]"


def null_rates(df: DataFrame, limits: Mapping[str, float], layer: str = "silver") -> list[Check]:
    """Share of NULL or blank values per column; an empty table passes."""
    checks = []
    for column, limit in limits.items():
        check_name = f"null_pct_{layer}_{column}"
        if column not in df.columns:
            checks.append(_absent(check_name, column, layer))
            continue
        alias = f"nulls_{column}"
        nulls, total = sql.name(alias), "greatest(silver_n, 1L)"
        checks.append(
            Check(
                name=check_name,
                status=pass_if(f"{percentage(nulls, total)} <= {sql.double(limit)}"),
                message=sql.message(
                    sql.plain(f"{layer}.{column}: ")
                    + "{nulls}/{total} null/blank ({pct}%), "
                    + f"limit={limit}%",
                    nulls=nulls,
                    total=total,
                    pct=percentage_text(nulls, total),
                ),
                aggregates=_SILVER_COUNT | {alias: _silver_count_if(bad.blank(column))},
                metrics={
                    "layer": sql.text(layer),
                    "column": sql.text(column),
                    "nulls": nulls,
                    "total": total,
                    "null_pct": percentage_2(nulls, total),
                    "limit_pct": sql.double(limit),
                },
            )
        )
    return checks


def uniqueness(
    df: DataFrame,
    columns: Sequence[str],
    layer: str = "silver",
    long: Sequence[str] = (),
) -> list[Check]:
    """Surplus rows per column, each column on its own; NULL is one value.

    Columns named in ``long`` hold long texts. They are compared by the SHA-256 of
    the whole text, so that the shuffle carries digests instead of documents.
    """
    checks = []
    for column in columns:
        check_name = f"unique_{layer}_{column}"
        if column not in df.columns:
            checks.append(_absent(check_name, column, layer))
            continue
        alias = f"distinct_{column}"
        distinct = sql.name(alias)
        checks.append(
            Check(
                name=check_name,
                status=pass_if(f"silver_n = {distinct}"),
                message=sql.message(
                    sql.plain(f"{layer}.{column}: ") + "{surplus} duplicate value(s)",
                    surplus=f"(silver_n - {distinct})",
                ),
                aggregates=_SILVER_COUNT,
                distinct={alias: _value_text(df, column, column in long)},
                metrics={
                    "layer": sql.text(layer),
                    "column": sql.text(column),
                    "total": "silver_n",
                    "distinct": distinct,
                    "duplicates": f"silver_n - {distinct}",
                },
            )
        )
    return checks


def email_format(df: DataFrame, column: str = "email", layer: str = "silver") -> Check:
    check_name = f"email_format_{layer}"
    if column not in df.columns:
        return _absent(check_name, column, layer, bare=True)
    return Check(
        name=check_name,
        status=pass_if("bad_emails = 0"),
        message=sql.message(sql.plain(layer) + ": {bad_emails} invalid email(s)"),
        aggregates={"bad_emails": _silver_count_if(bad.malformed(column))},
        metrics={"invalid_emails": "bad_emails", "layer": sql.text(layer)},
    )


def amount_positive(df: DataFrame, column: str = "amount", layer: str = "silver") -> Check:
    check_name = f"amount_positive_{layer}"
    if column not in df.columns:
        return _absent(check_name, column, layer, bare=True)
    return Check(
        name=check_name,
        status=pass_if("bad_amounts = 0"),
        message=sql.message(sql.plain(layer) + ": {bad_amounts} non-positive/null amount(s)"),
        aggregates={"bad_amounts": _silver_count_if(bad.not_positive(column))},
        metrics={"bad_amounts": "bad_amounts", "layer": sql.text(layer)},
    )


def allowed_values(
    df: DataFrame, column: str, allowed: Sequence[str], layer: str = "silver"
) -> Check:
    check_name = f"allowed_values_{layer}_{column}"
    if column not in df.columns:
        return _absent(check_name, column, layer, bare=True)
    alias = f"outside_{column}"
    count = sql.name(alias)
    return Check(
        name=check_name,
        status=pass_if(f"{count} = 0"),
        message=sql.message(
            sql.plain(f"{layer}.{column}: ")
            + "{n} value(s) outside "
            + sql.plain(_listing(allowed)),
            n=count,
        ),
        aggregates={alias: _silver_count_if(bad.not_in(column, allowed))},
        metrics={
            "bad_values": count,
            "allowed": sql.strings(allowed),
            "layer": sql.text(layer),
            "column": sql.text(column),
        },
    )


def _absent(check_name: str, column: str, layer: str, bare: bool = False) -> Check:
    metrics = {} if bare else {"column": sql.text(column), "layer": sql.text(layer)}
    return Check(
        name=check_name,
        status=sql.text(FAIL),
        message=sql.text(f"Column '{column}' not found in {layer}"),
        metrics=metrics,
    )


# -------------------------------------------------------------- whole suites


def table_checks(
    tagged: DataFrame,
    spec: CheckSpec,
    *,
    bronze_columns: Sequence[str],
    silver_columns: Sequence[str],
    reconcile: bool,
    has_reason: bool = True,
) -> list[Check]:
    """The checks a spec asks for, in report order."""
    balance = quarantine_reconciliation(has_reason) if reconcile else row_count_delta(spec)
    drift = schema_drift(
        bronze_columns,
        silver_columns,
        spec.bronze_columns,
        spec.silver_columns,
        flag_extra=spec.flag_extra_columns,
    )
    visible = tagged.select(*[c for c in tagged.columns if c in silver_columns])
    checks = [balance, drift]
    checks += null_rates(visible, spec.max_null_pct)
    checks += uniqueness(visible, spec.unique_columns, long=spec.long_columns)
    if spec.email_column:
        checks.append(email_format(visible, spec.email_column))
    if spec.positive_column:
        checks.append(amount_positive(visible, spec.positive_column))
    for column, values in spec.allowed.items():
        checks.append(allowed_values(visible, column, values))
    return checks


def check_layers(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame | None, spec: CheckSpec
) -> DataFrame:
    """All checks of a table from its layer tables. Without a quarantine, the share of
    dropped rows is judged instead of the reconciliation."""
    tagged = tag_layers(silver, bronze, quarantine)
    checks = table_checks(
        tagged,
        spec,
        bronze_columns=bronze.columns,
        silver_columns=silver.columns,
        reconcile=quarantine is not None,
        has_reason=quarantine is not None and "rejection_reason" in quarantine.columns,
    )
    return named(evaluate(tagged, checks), spec.table)


def check_classified(classified: DataFrame, intake: Intake, spec: CheckSpec) -> DataFrame:
    """All checks of a table in one pass over its classified rows."""
    tagged = tag_classified(classified, intake)
    checks = table_checks(
        tagged,
        spec,
        bronze_columns=intake.bronze_columns,
        silver_columns=intake.silver_columns,
        reconcile=True,
    )
    return named(evaluate(tagged, checks), spec.table)


def check_references(
    child: DataFrame | None,
    parent: DataFrame | None,
    column: str,
    parent_column: str,
    *,
    what: str = "order(s) with missing customer",
    layer: str = "silver",
    table: str = "_cross_",
) -> DataFrame:
    """Child rows without a partner. Where either table is missing the check is passed as
    skipped."""
    check_name = f"referential_integrity_{layer}"
    if child is None or parent is None:
        absent = "parent" if parent is None else "child"
        note = sql.text(f"Skipped referential checks (no {absent} table)")
        one = SparkSession.active().range(1)
        return named(_unfold(one, [Check(check_name, sql.text(PASS), note)]), table)
    check = Check(
        name=check_name,
        status=pass_if("unmatched = 0"),
        message=sql.message(sql.plain(layer) + ": {unmatched} " + sql.plain(what)),
        metrics={"orphan_orders": "unmatched", "layer": sql.text(layer)},
    )
    counted = count_unmatched(child, column, parent, parent_column)
    return named(_unfold(counted, [check]), table)


def named(rows: DataFrame, table: str) -> DataFrame:
    """Check rows under the name of the table they belong to."""
    return rows.selectExpr(f"{sql.text(table)} AS table_name", "*")


# ------------------------------------------------------------ lead-time suite
# Each gold table is reduced on its own to a few (fact, n) rows; the facts are
# united and folded into one row. Inputs of different size meet without a join.


def fact(label: str) -> str:
    return f"max(if(fact = {sql.text(label)}, n, NULL))"


def _fold(*labels: str) -> dict[str, str]:
    return {label: fact(label) for label in labels}


def _facts(one_row: DataFrame, labels: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"struct({sql.text(x)} AS fact, {sql.name(x)} AS n)" for x in labels)
    return one_row.selectExpr(f"inline(array({pairs}))")


def event_facts(events: DataFrame, model: StageModel) -> DataFrame:
    """Facts about the stage events. Rows are first folded per batch and stage, which
    also shows repeated pairs."""
    counts = {"bad_stages": f"count_if({bad.present_but_not_in('stage', model.stages)})"}
    for column in model.max_null_pct:
        if column in events.columns:
            counts[f"nulls_{column}"] = f"count_if({bad.blank(column)})"
    folded = events.groupBy(
        F.col("batch_id").alias("_batch"), F.col("stage").alias("_stage")
    ).agg(F.count(F.lit(1)).alias("events"), *[F.expr(c).alias(n) for n, c in counts.items()])
    labels = ["events", *counts]
    totals = folded.selectExpr(
        *[f"coalesce(sum({sql.name(n)}), 0L) AS {sql.name(n)}" for n in labels],
        "count(1) AS pairs",
    )
    return _facts(totals, [*labels, "pairs"])


def span_facts(
    spans: DataFrame, column: str, prefix: str, target: float | None = None
) -> DataFrame:
    """How many spans are negative, and how many exceed the target."""
    days = sql.name(column)
    counts = {f"{prefix}_negative": f"count_if({days} < 0)"}
    if target is not None:
        counts[f"{prefix}_over"] = f"count_if({days} > {sql.double(target)})"
    counted = spans.selectExpr(*[f"{how} AS {label}" for label, how in counts.items()])
    return _facts(counted, list(counts))


def layer_facts(summary: DataFrame) -> DataFrame:
    """Facts from a one-row layer summary."""
    layers = ("bronze", "silver", "quarantine")
    counts = summary.selectExpr(*[f"{x} AS {x}_rows" for x in layers])
    return _facts(counts, counts.columns)


def check_lead_times(
    events: DataFrame,
    stage_times: DataFrame,
    d2d: DataFrame,
    e2e: DataFrame,
    model: StageModel,
    summary: DataFrame | None = None,
    *,
    table: str = "lead_time",
    reconciliation_name: str = "movement_quarantine_reconciliation",
) -> DataFrame:
    """The lead-time suite; with a layer summary the reconciliation is checked too."""
    parts = [
        event_facts(events, model),
        span_facts(stage_times, "stage_lead_time_days", "stage"),
        span_facts(d2d, "d2d_lead_time_days", "d2d", model.d2d_target_days),
        span_facts(e2e, "e2e_lead_time_days", "e2e", model.e2e_target_days),
    ]
    checks = []
    if summary is not None:
        parts.append(layer_facts(summary))
        checks.append(movement_reconciliation(reconciliation_name))
    checks += stage_null_rates(model, events.columns)
    checks += [
        allowed_stages(),
        unique_batch_stage(),
        non_negative_lead_times(),
        e2e_target_breach(model),
        d2d_target_breach(model),
    ]
    return named(evaluate(union_results(parts), checks), table)


def movement_reconciliation(check_name: str) -> Check:
    """Counts only: silver and quarantine account for bronze."""
    return Check(
        name=check_name,
        status=pass_if("silver_rows + quarantine_rows = bronze_rows"),
        message=sql.message(
            "Bronze={bronze_rows}, Silver={silver_rows}, Quarantine={quarantine_rows}"
        ),
        aggregates=_fold("bronze_rows", "silver_rows", "quarantine_rows"),
        metrics={
            "bronze": "bronze_rows", "silver": "silver_rows", "quarantine": "quarantine_rows"
        },
    )


def stage_null_rates(model: StageModel, event_columns: Sequence[str]) -> list[Check]:
    total = "greatest(events, 1L)"
    checks = []
    for column, limit in model.max_null_pct.items():
        check_name = f"null_pct_stage_{column}"
        if column not in event_columns:
            checks.append(_absent(check_name, column, "stage_events"))
            continue
        label = f"nulls_{column}"
        nulls = sql.name(label)
        checks.append(
            Check(
                name=check_name,
                status=pass_if(f"{percentage(nulls, total)} <= {sql.double(limit)}"),
                message=sql.message(
                    sql.plain(f"stage_events.{column}: ") + "{nulls}/{total} ({pct}%)",
                    nulls=nulls,
                    total=total,
                    pct=percentage_text(nulls, total),
                ),
                aggregates=_fold("events", label),
            )
        )
    return checks


def allowed_stages() -> Check:
    """Stages outside the model; an unknown (NULL) stage is the null check's matter."""
    return Check(
        name="allowed_stages",
        status=pass_if("bad_stages = 0"),
        message=sql.message("invalid stage rows: {bad_stages}"),
        aggregates=_fold("bad_stages"),
    )


def unique_batch_stage() -> Check:
    return Check(
        name="unique_batch_stage",
        status=pass_if("events = pairs"),
        message=sql.message("duplicate batch+stage: {surplus}", surplus="(events - pairs)"),
        aggregates=_fold("events", "pairs"),
    )


def non_negative_lead_times() -> Check:
    labels = ("stage_negative", "d2d_negative", "e2e_negative")
    negative = f"({' + '.join(labels)})"
    return Check(
        name="non_negative_lead_times",
        status=pass_if(f"{negative} = 0"),
        message=sql.message("negative lead-time rows: {n}", n=negative),
        aggregates=_fold(*labels),
    )


def e2e_target_breach(model: StageModel) -> Check:
    return _breach("e2e", f"batch(es) above E2E target {model.e2e_target_days}d")


def d2d_target_breach(model: StageModel) -> Check:
    return _breach("d2d", f"handoff(s) above D2D target {model.d2d_target_days}d")


def _breach(prefix: str, what: str) -> Check:
    """Late is a warning, never a failure."""
    over = f"{prefix}_over"
    return Check(
        name=f"{prefix}_target_breach",
        status=pass_if(f"{over} = 0", WARN),
        message=sql.message(f"{{{over}}} {what}"),
        aggregates=_fold(over),
        metrics={"over_target": over},
    )


# -------------------------------------------------------- folding and gating


def severity(status: Column) -> Column:
    return F.when(status == FAIL, 2).when(status == WARN, 1).otherwise(0)


def status_of(level: Column) -> Column:
    return F.when(level == 2, F.lit(FAIL)).when(level == 1, F.lit(WARN)).otherwise(F.lit(PASS))


def overall_status(results: DataFrame) -> DataFrame:
    """One row: FAIL over WARN over PASS; no checks at all is a PASS."""
    worst = F.coalesce(F.max(severity(F.col("status"))), F.lit(0))
    return results.agg(status_of(worst).alias("overall_status"))


def with_overall(results: DataFrame) -> DataFrame:
    """Every result row with its run's overall status. The window spans the checks of
    one run, a number set by the contracts and not by the data."""
    worst = F.max(severity(F.col("status"))).over(Window.partitionBy("run_id"))
    return results.withColumn("overall_status", status_of(worst))


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def enforce_gate(results: DataFrame) -> None:
    """Raise if any check failed, naming all that did; WARN passes. Call it after the
    results are stored. The contracts set the number of checks."""
    failed = results.filter(F.col("status") == FAIL).orderBy("table_name", "check_name")
    rows = failed.select("table_name", "check_name", "message").collect()
    if rows:
        shown = "; ".join(f"{r.table_name}.{r.check_name}: {r.message}" for r in rows)
        raise QualityGateError(f"quality gate failed, {len(rows)} check(s): {shown}")
