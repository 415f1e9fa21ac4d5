"""End-to-end runs that store every layer.

Before a table is split, the keys that decide its verdicts (repeated keys, keys
without a parent) are stored. The bronze rows are then judged and written once, into
one folder for silver and one for quarantine, and with few such keys the wide rows
cross no exchange. Checks read the written layers. Results
are stored before the gate may raise, so a failed run leaves its history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from siltgate.context import RunContext
from siltgate.contracts import CheckSpec, Intake, StageModel
from siltgate.operators import checks, process, report
from siltgate.operators.classify import QUARANTINE, SILVER, classify, layered, split, summary_of_layers
from siltgate.operators.dedup import ARRIVAL
from siltgate.plans import shop
from siltgate.plans.goods import (
    LIFE_CYCLE,
    SAP_COLUMNS,
    MovementColumns,
    movement_intake,
    movement_stage_events,
)
from siltgate.sources.files import is_catalog_of_its_own
from siltgate.sources.layers import LayerNames
from siltgate.sources.readers import read_layer, read_layer_if_present
from siltgate.sources.staging import Staging
from siltgate.sources.writers import append_history, land, write_layer, write_layers


@dataclass(frozen=True)
class TableRun:
    """A table to load: its raw rows (None if its bronze table is stored already), its
    intake, the table its lookup refers to, and its code table."""

    bronze: DataFrame | None
    intake: Intake
    parent: str | None = None
    codes: DataFrame | None = None


def load_layers(
    spark: SparkSession, tables: list[TableRun], layers: LayerNames, ctx: RunContext
) -> DataFrame:
    """Write bronze, silver and quarantine of each table, parents before children.

    Returns one summary row per table.
    """
    summaries = []
    for table in tables:
        name = table.intake.name
        parent = read_layer(spark, layers.silver(table.parent)) if table.parent else None
        _store_bronze(table, layers.bronze(name))
        bronze = read_layer(spark, layers.bronze(name))
        with Staging(spark) as staging:
            judged = classify(bronze, table.intake, parent, staging, table.codes)
            _store_judged(judged, table.intake, layers, ctx)
        stored = [read_layer(spark, at(name)) for at in (layers.silver, layers.quarantine)]
        summaries.append(summary_of_layers(bronze, *stored, name))
    return checks.union_results(summaries)


def _store_judged(judged: DataFrame, intake: Intake, layers: LayerNames, ctx: RunContext) -> None:
    """Rows are judged and written once, to both layers; where the layers' columns don't go
    together, once for each."""
    places = {SILVER: layers.silver(intake.name), QUARANTINE: layers.quarantine(intake.name)}
    both = layered(judged, intake, ctx)
    if both is None or any(is_catalog_of_its_own(judged.sparkSession, w) for w in places.values()):
        for view, where in zip(split(judged, intake, ctx), places.values(), strict=True):
            write_layer(view, where)
        return
    rows, schemas = both
    write_layers(rows, {layer: (where, schemas[layer]) for layer, where in places.items()})


def _store_bronze(table: TableRun, where: str) -> None:
    """Rows whose intake goes by arrival, but that carry no arrival number, get one."""
    if table.bronze is None:
        return
    if ARRIVAL in table.intake.order_by and ARRIVAL not in table.bronze.columns:
        land(table.bronze, where)
    else:
        write_layer(table.bronze, where)


def check_tables(
    spark: SparkSession,
    specs: list[CheckSpec],
    layers: LayerNames,
    ctx: RunContext,
    bronze_columns: dict[str, tuple[str, ...]],
    references: list[tuple[str, str, str, str]] = (),
) -> DataFrame:
    """Result rows of a run over written layers.

    ``references`` lists ``(child, column, parent, parent_column)`` between silver
    tables. ``bronze_columns`` names the contract columns of each bronze table, so
    that helper columns such as an arrival number are not taken for drift. A table
    without a stored quarantine is judged by the share of dropped rows instead; a
    reference from or to a table that is not stored is skipped.
    """
    parts = []
    for spec in specs:
        bronze = read_layer(spark, layers.bronze(spec.table))
        parts.append(
            checks.check_layers(
                bronze.select(*bronze_columns[spec.table]),
                read_layer(spark, layers.silver(spec.table)),
                read_layer_if_present(spark, layers.quarantine(spec.table)),
                spec,
            )
        )
    for child, column, parent, parent_column in references:
        parts.append(
            checks.check_references(
                read_layer_if_present(spark, layers.silver(child)),
                read_layer_if_present(spark, layers.silver(parent)),
                column,
                parent_column,
            )
        )
    return report.result_rows(checks.union_results(parts), ctx)


def load_lead_times(
    spark: SparkSession,
    layers: LayerNames,
    columns: MovementColumns = SAP_COLUMNS,
    model: StageModel = LIFE_CYCLE,
    table: str = "movements",
) -> None:
    """Write stage events, the three gold tables and the KPI summary from silver movements."""
    silver = read_layer(spark, layers.silver(table))
    write_layer(movement_stage_events(silver, columns, model), layers.silver("stage_events"))
    events = read_layer(spark, layers.silver("stage_events"))
    write_layer(process.stage_lead_times(events), layers.gold("stage_lead_times"))
    write_layer(process.d2d_lead_times(events), layers.gold("d2d_lead_times"))
    write_layer(process.e2e_lead_times(events, model), layers.gold("e2e_lead_times"))
    gold = [read_layer(spark, layers.gold(f"{kind}_lead_times")) for kind in ("stage", "d2d", "e2e")]
    write_layer(process.kpi_summary(*gold, model), layers.gold("kpi_summary"))


def check_lead_time_layers(
    spark: SparkSession,
    layers: LayerNames,
    summary: DataFrame,
    ctx: RunContext,
    model: StageModel = LIFE_CYCLE,
    reconciliation_name: str = "mseg_quarantine_reconciliation",
) -> DataFrame:
    """Result rows of the lead-time suite over the written gold tables."""
    rows = checks.check_lead_times(
        read_layer(spark, layers.silver("stage_events")),
        read_layer(spark, layers.gold("stage_lead_times")),
        read_layer(spark, layers.gold("d2d_lead_times")),
        read_layer(spark, layers.gold("e2e_lead_times")),
        model,
        summary,
        reconciliation_name=reconciliation_name,
    )
    return report.result_rows(rows, ctx)


def store_and_gate(results: DataFrame, layers: LayerNames, kpis: DataFrame | None = None) -> None:
    """Append results, snapshot and narrative to the history, the latter two with the KPIs
    of the run (see ``report.of_run``) if given, then apply the gate."""
    with Staging(results.sparkSession) as staging:
        stored = staging.table(results, "dq-results")
        append_history(report.history_rows(stored), layers.history("dq_results"))
        append_history(report.run_snapshot(stored, kpis), layers.history("dq_run_snapshots"))
        append_history(report.narrative(stored, kpis=kpis), layers.history("dq_agent_reports"))
        checks.enforce_gate(stored)


def run_shop(
    spark: SparkSession,
    customers: DataFrame,
    orders: DataFrame,
    layers: LayerNames,
    ctx: RunContext,
    customer: Intake | None = None,
    order: Intake | None = None,
) -> DataFrame:
    """Load, check, store and gate customers and orders. Returns the layer summary."""
    customer = customer or shop.customer_intake(_contract_columns(customers))
    order = order or shop.order_intake(_contract_columns(orders))
    tables = [TableRun(customers, customer), TableRun(orders, order, parent=customer.name)]
    summary = load_layers(spark, tables, layers, ctx)
    results = check_tables(
        spark,
        [shop.customer_checks(customer), shop.order_checks(order)],
        layers,
        ctx,
        {t.intake.name: t.intake.bronze_columns for t in tables},
        [(order.name, "customer_id", customer.name, "customer_id")],
    )
    store_and_gate(results, layers)
    return summary


def run_goods(
    spark: SparkSession,
    movements: DataFrame,
    layers: LayerNames,
    ctx: RunContext,
    columns: MovementColumns = SAP_COLUMNS,
    model: StageModel = LIFE_CYCLE,
) -> DataFrame:
    """Load movements, derive all lead times, check, store and gate. Returns the layer
    summary."""
    intake = movement_intake(_contract_columns(movements), columns, model)
    summary = load_layers(spark, [TableRun(movements, intake)], layers, ctx)
    load_lead_times(spark, layers, columns, model, intake.name)
    kpis = report.of_run(read_layer(spark, layers.gold("kpi_summary")), ctx)
    store_and_gate(check_lead_time_layers(spark, layers, summary, ctx, model), layers, kpis)
    return summary


def _contract_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ARRIVAL]
