"""The sample tables give the known rows, counts and verdicts."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timezone

import pytest
import samples
from pyspark.sql import functions as F

from siltgate.context import RunContext
from siltgate.operators import checks, process, report
from siltgate.operators.classify import classify, layer_summary, split
from siltgate.plans import goods, shop
from siltgate.sources.staging import Staging

CTX = RunContext("20240131T000000Z-00000001", datetime(2024, 1, 31, tzinfo=timezone.utc))


@pytest.fixture(scope="module")
def shop_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    customer = shop.customer_intake(samples.columns(samples.CUSTOMER_SCHEMA))
    order = shop.order_intake(samples.columns(samples.ORDER_SCHEMA))
    customers = samples.stored(spark, folder, "customers", samples.CUSTOMERS, samples.CUSTOMER_SCHEMA)
    orders = samples.stored(spark, folder, "orders", samples.ORDERS, samples.ORDER_SCHEMA)
    with Staging(spark) as staging:
        judged_customers = classify(customers, customer, staging=staging)
        silver_customers, _ = split(judged_customers, customer, CTX)
        judged_orders = classify(orders, order, silver_customers, staging=staging)
        yield customer, judged_customers, order, judged_orders


def test_customers(shop_tables):
    intake, judged, _, _ = shop_tables
    silver, quarantine = split(judged, intake, CTX)
    rows = {r.customer_id: r for r in silver.collect()}
    assert sorted(rows) == ["K1", "K2", "K6"]
    assert (rows["K1"].name, rows["K2"].country, rows["K6"].signup_date) == ("Anna Test", "UNKNOWN", None)
    assert silver.columns == list(shop.CUSTOMER_SILVER)
    assert {(r.customer_id, r.rejection_reason) for r in quarantine.collect()} == {
        ("K1", "duplicate_customer_id"),
        ("K3", "blank_name"),
        ("K4", "invalid_or_blank_email"),
        ("K5", "invalid_or_blank_email"),
    }
    assert quarantine.columns == [*intake.bronze_columns, "rejection_reason", "rejected_at"]


def test_orders(shop_tables):
    _, _, intake, judged = shop_tables
    silver, quarantine = split(judged, intake, CTX)
    assert sorted((r.order_id, r.amount) for r in silver.collect()) == [("P1", 10.5), ("P6", 12.25)]
    assert {(r.order_id, r.rejection_reason) for r in quarantine.collect()} == {
        ("P1", "duplicate_order_id"),
        ("P2", "non_positive_or_null_amount"),
        ("P3", "invalid_status"),
        ("P4", "blank_customer_id"),
        ("P5", "orphan_customer_id"),
        ("P7", "non_positive_or_null_amount"),
    }


def test_shop_gate(shop_tables):
    customer, judged_customers, order, judged_orders = shop_tables
    silver_customers, _ = split(judged_customers, customer, CTX)
    silver_orders, _ = split(judged_orders, order, CTX)
    parts = [
        checks.check_classified(judged_customers, customer, shop.customer_checks(customer)),
        checks.check_classified(judged_orders, order, shop.order_checks(order)),
        checks.check_references(silver_orders, silver_customers, "customer_id", "customer_id"),
    ]
    rows = report.result_rows(checks.union_results(parts), CTX).collect()
    assert [r.check_name for r in rows if r.table_name == "customers"] == [
        "quarantine_reconciliation", "schema_drift", "null_pct_silver_email",
        "null_pct_silver_name", "null_pct_silver_country", "unique_silver_customer_id",
        "unique_silver_email", "email_format_silver",
    ]
    balance = next(r for r in rows if r.check_name == "quarantine_reconciliation")
    assert balance.message == "Bronze=7, Silver=3, Quarantine=4, accounted=7, blank_reasons=0"
    assert {r.status for r in rows} == {"PASS"} and {r.overall_status for r in rows} == {"PASS"}


@pytest.fixture(scope="module")
def movement_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("goods")
    intake = goods.movement_intake(samples.columns(samples.MOVEMENT_SCHEMA))
    moves = samples.stored(spark, folder, "moves", samples.movements_text(), samples.MOVEMENT_SCHEMA)
    with Staging(spark) as staging:
        judged = classify(moves, intake, staging=staging)
        silver, quarantine = split(judged, intake, CTX)
        events = staging.table(goods.movement_stage_events(silver), "events")
        yield moves, judged, silver, quarantine, events


def test_movements(movement_tables):
    _, judged, silver, quarantine, _ = movement_tables
    kept = 2 * sum(stages for stages, _, _ in samples.BATCHES.values())
    assert layer_summary(judged, "movements").collect()[0][1:] == (kept + 5, kept, 5)
    assert {(r.MBLNR, r.ZEILE, r.rejection_reason) for r in quarantine.collect()} == {
        (1, 0, "duplicate_mseg_key"),
        (9, 1, "missing_matnr_charg_bwart_or_werks"),
        (9, 2, "missing_matnr_charg_bwart_or_werks"),
        (9, 3, "unmapped_bwart"),
        (9, 4, "invalid_menge"),
    }
    assert silver.columns == [*samples.columns(samples.MOVEMENT_SCHEMA), "stage", "event_ts"]


def test_lead_times(movement_tables):
    events = movement_tables[4]
    assert {(r.line_count, r.total_quantity, r.uom) for r in events.collect()} == {(2, 140.0, "KG")}
    days = lambda hours: round(hours / 24, 2)
    stage_rows = process.stage_lead_times(events).collect()
    assert Counter((r.batch_id, r.stage_lead_time_days) for r in stage_rows) == Counter(
        {(lot, days(work)): stages for lot, (stages, work, _) in samples.BATCHES.items()}
    )
    order = goods.LIFE_CYCLE.stage_order
    handoffs = process.d2d_lead_times(events).collect()
    assert all(order[r.to_stage] == order[r.from_stage] + 1 for r in handoffs)
    assert Counter((r.batch_id, r.d2d_lead_time_days) for r in handoffs) == Counter(
        {(lot, days(wait)): stages - 1 for lot, (stages, _, wait) in samples.BATCHES.items()}
    )
    whole = process.e2e_lead_times(events, goods.LIFE_CYCLE).orderBy("batch_id").collect()
    assert [(r.batch_id, r.material, r.e2e_lead_time_days, r.stages_present) for r in whole] == [
        (lot, f"MAT{n}", days(stages * work + (stages - 1) * wait), 12)
        for n, (lot, (stages, work, wait)) in enumerate(samples.BATCHES.items(), start=1)
        if stages == 12
    ]


def test_lead_time_gate_warns(movement_tables):
    _, judged, _, _, events = movement_tables
    stage_days = process.stage_lead_times(events)
    d2d = process.d2d_lead_times(events)
    e2e = process.e2e_lead_times(events, goods.LIFE_CYCLE)
    results = checks.check_lead_times(
        events, stage_days, d2d, e2e, goods.LIFE_CYCLE,
        layer_summary(judged, "movements"),
        reconciliation_name="mseg_quarantine_reconciliation",
    )
    rows = report.result_rows(results, CTX)
    found = {r.check_name: (r.status, r.message) for r in rows.collect()}
    assert len(found) == 10
    assert found["d2d_target_breach"] == ("WARN", "11 handoff(s) above D2D target 2.0d")
    assert {s for s, _ in found.values()} == {"PASS", "WARN"}
    checks.enforce_gate(rows)
    kpis = process.kpi_summary(stage_days, d2d, e2e, goods.LIFE_CYCLE).collect()[0]
    assert (kpis.batches_with_e2e, kpis.d2d_handoffs, kpis.stage_count_expected) == (2, 24, 12)
    assert len(kpis.avg_stage_days_by_stage) == 12
    slowest = process.slowest_handoffs(d2d, 1).collect()
    assert [(r.batch_id, r.d2d_lead_time_days) for r in slowest] == [("LOT-B", 2.25)]
    assert events.filter(F.col("stage_order").isNull()).isEmpty()


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_lead_times_do_not_depend_on_partitioning(movement_tables, partitions):
    moves, _, _, _, events = movement_tables
    intake = goods.movement_intake(samples.columns(samples.MOVEMENT_SCHEMA))
    again = goods.movement_stage_events(split(classify(moves.repartition(partitions), intake), intake, CTX)[0])
    assert Counter(again.collect()) == Counter(events.collect())
