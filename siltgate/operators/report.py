"""Run history: result rows, the report as one JSON value, findings and advice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltgate.context import RunContext
from siltgate.functions import sql
from siltgate.operators.checks import PASS, severity, status_of, with_overall

RESULT_COLUMNS = [
    "run_id",
    "table_name",
    "check_name",
    "status",
    "message",
    "metrics_json",
    "overall_status",
    "checked_at",
]

REPORT_SCHEMA = (
    "overall_status STRING, tables ARRAY<STRUCT<`table`: STRING, overall_status: STRING, "
    "checks ARRAY<STRUCT<name: STRING, status: STRING, message: STRING, metrics: STRING>>>>"
)

KPI_SCHEMA = (
    "avg_e2e_days DOUBLE, avg_d2d_days DOUBLE, avg_stage_days_by_stage MAP<STRING, DOUBLE>, "
    "batches_with_e2e BIGINT, d2d_handoffs BIGINT, stage_count_expected INT"
)

# What to do about a failed check: order of urgency and advice, by check family.
ADVICE = {
    "quarantine_reconciliation": (1, "Find the rows that reached neither silver nor quarantine."),
    "schema_drift": (2, "Align the table with its contract before loading it again."),
    "unique": (3, "Deduplicate on the key before the silver write."),
    "null_pct": (4, "Quarantine rows with blank required fields."),
    "email_format": (5, "Quarantine malformed addresses."),
    "amount_positive": (6, "Keep only amounts above zero."),
    "allowed_values": (7, "Map or quarantine values outside the allowed set."),
    "referential_integrity": (8, "Quarantine rows whose parent is missing."),
    "row_count_delta": (9, "Review what the transform drops and keep it in quarantine."),
    "non_negative_lead_times": (10, "Check event times of batches that end before they start."),
    "allowed_stages": (11, "Extend the code map or quarantine unknown stages."),
    "unique_batch_stage": (12, "Fold events to one row per batch and stage."),
    "e2e_target_breach": (13, "Look at the slowest stages of the late batches."),
    "d2d_target_breach": (14, "Start with the longest waits between stages."),
}

# Of a check outside the families above, which a caller may have named or made.
NO_ADVICE = "See what the check measures."
NO_MESSAGE = "no message"


def result_rows(checks: DataFrame, ctx: RunContext) -> DataFrame:
    """Check rows of a run with run id, overall status and clock; ``check_no`` is kept
    so that reports can follow the order of the suite."""
    stamped = checks.select(
        ctx.run_id_column().alias("run_id"), "*", ctx.timestamp_column().alias("checked_at")
    )
    return with_overall(stamped)


def history_rows(results: DataFrame) -> DataFrame:
    return results.select(*RESULT_COLUMNS)


def failed_checks_by_table(results: DataFrame) -> DataFrame:
    """Per table: its own status and how many checks did not pass."""
    return results.groupBy("table_name").agg(
        status_of(F.max(severity(F.col("status")))).alias("table_status"),
        F.count_if(F.col("status") != PASS).alias("failed_checks"),
    )


def latest_run(results: DataFrame) -> DataFrame:
    """Rows of the greatest run id, by table and check. Run ids start with a UTC stamp."""
    newest = results.agg(F.max("run_id")).scalar()
    return (
        results.filter(F.col("run_id") == newest)
        .select("run_id", "table_name", "check_name", "status", "message")
        .orderBy("table_name", "check_name")
    )


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    return snapshots.orderBy(F.desc("created_at"), F.desc("run_id")).limit(1)


def of_run(kpis: DataFrame, ctx: RunContext) -> DataFrame:
    """A KPI summary under the run it belongs to: ``run_id`` and ``kpi_summary``."""
    return kpis.select(ctx.run_id_column().alias("run_id"), F.struct(*kpis.columns).alias("kpi_summary"))


def run_snapshot(results: DataFrame, kpis: DataFrame | None = None) -> DataFrame:
    """One row per run: the nested report as JSON, with the KPI summary of the run if
    ``kpis`` (of ``of_run``) are given. The lists hold checks, whose number is set by the
    contracts."""
    check = F.struct(
        "check_no",
        F.col("check_name").alias("name"),
        "status",
        "message",
        F.col("metrics_json").alias("metrics"),
    )
    tables = results.groupBy("run_id", "overall_status", "checked_at", "table_name").agg(
        status_of(F.max(severity(F.col("status")))).alias("table_status"),
        F.array_sort(F.collect_list(check)).alias("checks"),
    )
    entry = F.struct(
        F.col("table_name").alias("table"),
        F.col("table_status").alias("overall_status"),
        F.transform("checks", lambda c: c.dropFields("check_no")).alias("checks"),
    )
    runs = tables.groupBy("run_id", "overall_status", "checked_at").agg(
        F.array_sort(F.collect_list(entry)).alias("tables")
    )
    parts = ["overall_status", "tables"]
    if kpis is not None:
        runs = runs.join(kpis, "run_id", "left")
        parts.append("kpi_summary")
    return runs.select(
        "run_id",
        F.to_json(F.struct(*parts)).alias("report_json"),
        "overall_status",
        F.col("checked_at").alias("created_at"),
    )


def advised(results: DataFrame) -> DataFrame:
    """Result rows with the urgency and advice of their check family."""
    urgency = sql.map_value({k: v[0] for k, v in ADVICE.items()}, "_family")
    advice = sql.map_value({k: v[1] for k, v in ADVICE.items()}, "_family")
    return (
        results.selectExpr("*", f"{check_family('check_name')} AS _family")
        .selectExpr("*", f"{urgency} AS urgency", f"{advice} AS advice")
        .drop("_family")
    )


def findings(results: DataFrame) -> DataFrame:
    """Checks that did not pass, with their urgency and advice."""
    return advised(results.filter(F.col("status") != PASS)).select(
        "run_id", "table_name", "check_name", "status", "message", "urgency", "advice"
    )


def check_family(column: str) -> str:
    """The check's kind, without the layer and column that its name carries, as SQL."""
    named = [k for k in ADVICE if k not in ("null_pct", "unique", "unique_batch_stage")]
    tests = [
        (f"startswith({column}, 'null_pct_')", "null_pct"),
        (f"{column} = 'unique_batch_stage'", "unique_batch_stage"),
        (f"startswith({column}, 'unique_')", "unique"),
        *[(f"contains({column}, '{kind}')", kind) for kind in named],
    ]
    return "CASE " + " ".join(f"WHEN {test} THEN '{kind}'" for test, kind in tests) + " END"


def decode_snapshot(snapshots: DataFrame) -> DataFrame:
    """Snapshots back to one row per check."""
    report = snapshots.select(
        "run_id", F.from_json("report_json", REPORT_SCHEMA).alias("report")
    )
    tables = report.select("run_id", F.inline("report.tables"))
    return tables.select(
        "run_id", F.col("table").alias("table_name"), F.inline("checks")
    ).select(
        "run_id",
        "table_name",
        F.col("name").alias("check_name"),
        "status",
        "message",
        F.col("metrics").alias("metrics_json"),
    )


def decode_kpis(snapshots: DataFrame) -> DataFrame:
    """The KPI summaries of snapshots, one row per run."""
    report = F.from_json("report_json", f"kpi_summary STRUCT<{KPI_SCHEMA}>")
    return snapshots.select("run_id", report["kpi_summary"].alias("kpi")).select("run_id", "kpi.*")


def narrative(results: DataFrame, mode: str = "offline", kpis: DataFrame | None = None) -> DataFrame:
    """One Markdown report per run: the status of the run and of its tables, its lead times
    if ``kpis`` (of ``of_run``) are given, and findings ordered by table and urgency."""
    finding = F.when(
        F.col("status") != PASS,
        F.struct(
            "table_name",
            F.coalesce("urgency", F.lit(len(ADVICE) + 1)).alias("urgency"),
            F.concat(
                F.lit("- **"), "status", F.lit("** `"), "table_name", F.lit("."), "check_name",
                F.lit("`: "), F.coalesce("message", F.lit(NO_MESSAGE)), F.lit(" - "),
                F.coalesce("advice", F.lit(NO_ADVICE)),
            ).alias("line"),
        ),
    )
    lines = F.transform(F.array_sort(F.collect_list(finding)), lambda f: f["line"])
    of_table = F.max(severity(F.col("status"))).over(Window.partitionBy("run_id", "table_name"))
    tables = F.concat(F.lit("- `"), "table_name", F.lit("`: "), status_of(of_table))
    runs = (
        advised(results)
        .withColumn("_table", tables)
        .groupBy("run_id", "overall_status", "checked_at")
        .agg(
            F.concat_ws("\n", F.array_sort(F.collect_set("_table"))).alias("_tables"),
            F.concat_ws("\n", lines).alias("_lines"),
        )
    )
    if kpis is None:
        lead_times = F.lit("")
    else:
        runs = runs.join(kpis, "run_id", "left")
        lead_times = F.coalesce(_lead_times(), F.lit(""))
    return runs.select(
        "run_id",
        F.lit(mode).alias("agent_mode"),
        F.concat(
            F.lit("## Summary\n\nOverall status: **"), "overall_status", F.lit("**\n\n## Tables\n\n"),
            "_tables", lead_times, F.lit("\n\n## Findings\n\n"),
            F.when(F.col("_lines") == "", F.lit("None.")).otherwise(F.col("_lines")),
            F.lit("\n"),
        ).alias("analysis_md"),
        "overall_status",
        F.col("checked_at").alias("created_at"),
    )


def _lead_times() -> Column:
    """The section on a run's lead times; NULL without a KPI summary."""

    def days(value: Column) -> Column:
        return F.coalesce(F.concat(value.cast("string"), F.lit(" days")), F.lit("none"))

    kpi = F.col("kpi_summary")
    by_stage = F.array_sort(F.map_entries(kpi["avg_stage_days_by_stage"]))
    stages = F.transform(
        by_stage, lambda e: F.concat(F.lit("\n- Stage `"), e["key"], F.lit("`: "), days(e["value"]))
    )
    return F.when(
        kpi.isNotNull(),
        F.concat(
            F.lit("\n\n## Lead times\n\n- End to end: "), days(kpi["avg_e2e_days"]),
            F.lit("\n- Between stages: "), days(kpi["avg_d2d_days"]),
            F.concat_ws("", stages),
        ),
    )
