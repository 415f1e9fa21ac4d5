"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.context import RunContext
from siltgate.contracts import CheckSpec, CodeTable
from siltgate.functions import predicates as bad
from siltgate.functions import sql
from siltgate.functions.timestamps import first_timestamp
from siltgate.operators import checks, dedup, lookups, process, report
from siltgate.operators.classify import (
    classify,
    layer_summary,
    quarantine_view,
    reason_histogram,
    silver_view,
    summary_of_layers,
    union_quarantines,
)
from siltgate.plans import goods, runs, shop
from siltgate.sources import readers, writers
from siltgate.sources.layers import LayerNames
from siltgate.sources.staging import Staging
from siltgate_queries import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

CTX = RunContext("20240131T000000Z-00000001", datetime(2024, 1, 31, tzinfo=timezone.utc))
LATER = RunContext("20240201T000000Z-00000002", datetime(2024, 2, 1, tzinfo=timezone.utc))

CUSTOMERS = shop.customer_intake(b.CUSTOMER_BRONZE, b.CUSTOMER_SILVER, ("seq",))
ORDERS = shop.order_intake(b.ORDER_BRONZE, b.ORDER_SILVER, ("seq",))
MOVEMENTS = goods.movement_intake(b.MOVEMENT_BRONZE, b.EVENT_COLUMNS, b.EVENT_STAGES, ("seq",))
MOVEMENTS_BY_CODES = goods.movement_intake(
    b.MOVEMENT_BRONZE, b.EVENT_COLUMNS, b.EVENT_STAGES, ("seq",),
    CodeTable("code", "code", {"stage": "stage"}),
)
CUSTOMER_CHECKS = shop.customer_checks(CUSTOMERS)
ORDER_CHECKS = shop.order_checks(ORDERS)

# ------------------------------------------------------------------ shared steps


# Verdicts are found with staging: the keys that repeat, and the keys without a
# parent, are stored first, so the wide rows meet tables of known size.


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return classify(
        b.bronze_customers(spark, sf), CUSTOMERS, staging=Staging.until_exit(spark)
    )


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return silver_view(customers(spark, sf), CUSTOMERS)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return shop_tables(spark, sf)["orders"]


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver_view(orders(spark, sf), ORDERS)


def movements(spark: SparkSession, sf: str) -> DataFrame:
    return classify(
        b.bronze_movements(spark, sf), MOVEMENTS, staging=Staging.until_exit(spark)
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    silver = silver_view(movements(spark, sf), MOVEMENTS)
    return goods.movement_stage_events(silver, b.EVENT_COLUMNS, b.EVENT_STAGES)


def staged_events(spark: SparkSession, sf: str) -> DataFrame:
    """Stage events as a stored table, for queries that read them more than once."""
    return Staging.until_exit(spark).table(events(spark, sf), "stage-events")


def shop_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Customers and orders, both judged; the orders' lookup uses the same verdicts."""
    judged = customers(spark, sf)
    return {
        "customers": judged,
        "orders": classify(
            b.bronze_orders(spark, sf),
            ORDERS,
            silver_view(judged, CUSTOMERS),
            Staging.until_exit(spark),
        ),
    }


def quarantines(spark: SparkSession, sf: str) -> DataFrame:
    shop_rows = shop_tables(spark, sf)
    return union_quarantines(
        {
            "customers": quarantine_view(shop_rows["customers"], CUSTOMERS, CTX),
            "orders": quarantine_view(shop_rows["orders"], ORDERS, CTX),
            "movements": quarantine_view(movements(spark, sf), MOVEMENTS, CTX),
        },
        ["customer_id", "order_id", "doc_id", "seq"],
    )


def stored_shop(spark: SparkSession, sf: str, as_tables: bool = False) -> LayerNames:
    """Customers and orders judged once, with all layers stored, in folders or as tables."""
    staging = Staging.until_exit(spark)
    root = staging.database("shop") if as_tables else staging.folder("shop-layers")
    layers = LayerNames(root, as_tables)
    tables = [
        runs.TableRun(b.bronze_customers(spark, sf), CUSTOMERS),
        runs.TableRun(b.bronze_orders(spark, sf), ORDERS, parent="customers"),
    ]
    runs.load_layers(spark, tables, layers, CTX)
    return layers


def stored_movements(spark: SparkSession, sf: str) -> tuple[LayerNames, DataFrame]:
    """Movements judged once, with all layers stored, and their counts."""
    layers = LayerNames(Staging.until_exit(spark).folder("goods-layers"))
    table = runs.TableRun(b.bronze_movements(spark, sf), MOVEMENTS)
    return layers, runs.load_layers(spark, [table], layers, CTX)


def stage_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The stage map as a stored table, made of the event types that occur."""
    staging = Staging.until_exit(spark)
    kinds = b.table(spark, sf, "events").select(F.col("event_type").alias("code")).distinct()
    order = F.expr(sql.map_value(b.EVENT_STAGES.stage_order, "code"))
    kinds = kinds.filter(order.isNotNull())
    return staging.table(kinds.select("code", F.col("code").alias("stage"), order.alias("place")), "code-table")


def shop_results(spark: SparkSession, sf: str, ctx: RunContext = CTX) -> DataFrame:
    """All shop checks over the stored layers."""
    return runs.check_tables(
        spark,
        [CUSTOMER_CHECKS, ORDER_CHECKS],
        stored_shop(spark, sf),
        ctx,
        {"customers": b.CUSTOMER_BRONZE, "orders": b.ORDER_BRONZE},
        [("orders", "customer_id", "customers", "customer_id")],
    )


def bronze_results(spark: SparkSession, sf: str, ctx: RunContext = CTX) -> DataFrame:
    """The shop checks put to the raw tables, which fail most of them."""
    raw_customers, raw_orders = b.bronze_customers(spark, sf), b.bronze_orders(spark, sf)
    customer_rows = checks.evaluate(
        checks.as_silver(raw_customers),
        [
            *checks.null_rates(raw_customers, CUSTOMER_CHECKS.max_null_pct, "bronze"),
            *checks.uniqueness(raw_customers, CUSTOMER_CHECKS.unique_columns, "bronze"),
            checks.email_format(raw_customers, layer="bronze"),
        ],
    )
    order_rows = checks.evaluate(
        checks.as_silver(raw_orders),
        [
            *checks.null_rates(raw_orders, ORDER_CHECKS.max_null_pct, "bronze"),
            *checks.uniqueness(raw_orders, ORDER_CHECKS.unique_columns, "bronze"),
            checks.amount_positive(raw_orders, layer="bronze"),
            checks.allowed_values(raw_orders, "status", shop.ALLOWED_STATUS, "bronze"),
        ],
    )
    parts = [
        checks.named(customer_rows, "customers"),
        checks.named(order_rows, "orders"),
        checks.check_references(
            raw_orders, raw_customers, "customer_id", "customer_id", layer="bronze"
        ),
    ]
    return report.result_rows(checks.union_results(parts), ctx)


# ------------------------------------------------------- scalar and scan queries


def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "lineitem")
    return dedup.first_rows(lines, b.LINE_KEY, b.LINE_ORDER, Staging.until_exit(spark))


def code_to_stage_map(spark: SparkSession, sf: str) -> DataFrame:
    stage = sql.map_value(b.EVENT_STAGES.code_to_stage, "event_type")
    order = sql.map_value(b.EVENT_STAGES.stage_order, "event_type")
    return b.table(spark, sf, "events").selectExpr(
        "event_id", "event_type", f"{stage} AS stage", f"{order} AS stage_order"
    )


def code_to_stage_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a code table, joined by its size."""
    return lookups.with_codes(
        b.table(spark, sf, "events").select("event_id", "event_type"),
        stage_codes(spark, sf),
        CodeTable("event_type", "code", {"stage": "stage", "stage_order": "place"}),
        Staging.until_exit(spark),
    )


def silver_movements_by_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Movements judged with the stage map as a table."""
    judged = classify(
        b.bronze_movements(spark, sf),
        MOVEMENTS_BY_CODES,
        staging=Staging.until_exit(spark),
        codes=stage_codes(spark, sf),
    )
    return _shown(silver_view(judged, MOVEMENTS_BY_CODES))


def dedup_by_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """The first event of each user and type as raw files bring them: events go out as CSV
    files whose names follow their order, and are landed and read back."""
    staging = Staging.until_exit(spark)
    folder, landed = staging.folder("csv-events"), staging.folder("landed-events")
    rows = b.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    writers.write_csv(rows.repartitionByRange("event_id").sortWithinPartitions("event_id"), folder)
    writers.land(readers.read_csv(spark, folder, rows.schema), landed)
    bronze = readers.read_layer(spark, landed)
    first = dedup.first_rows(bronze, ["user_id", "event_type"], [dedup.ARRIVAL], staging)
    return first.drop(dedup.ARRIVAL)


def event_ts_fallback(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_movements(spark, sf)
    event_ts = first_timestamp(raw.schema, "entry_ts", "posting_date")
    return raw.selectExpr("doc_id", "seq", f"{event_ts} AS event_ts")


def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_customers(spark, sf)
    folder = Staging.until_exit(spark).folder("csv-customers")
    writers.write_csv(raw, folder)
    return readers.read_csv(spark, folder, raw.schema)


def scan_csv_escaped(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts, with line breaks, quotes and backslashes, through CSV files that can be
    split."""
    texts = b.table(spark, sf, "documents").select("doc_id", "text", "lang")
    folder = Staging.until_exit(spark).folder("csv-documents")
    writers.write_csv(texts, folder, escaped=True)
    return readers.read_csv(spark, folder, texts.schema, escaped=True)


def layers_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Layers stored as tables and read by their names."""
    names = stored_shop(spark, sf, as_tables=True)
    sold = readers.read_layer(spark, names.silver("orders")).groupBy("customer_id", "status").count()
    known = readers.read_layer(spark, names.silver("customers")).select("customer_id", "country")
    return (
        sold.join(known, "customer_id")
        .groupBy("country", "status")
        .agg(F.sum("count").alias("orders"), F.count(F.lit(1)).alias("customers"))
    )


def sink_overwrite_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A layer replaced by one with another schema: only the second is left."""
    folder = Staging.until_exit(spark).folder("layer-orders")
    raw = b.bronze_orders(spark, sf)
    writers.write_layer(raw.select("order_id", "seq"), folder)
    writers.write_layer(raw.select("order_id", "seq", "status", "amount"), folder)
    return readers.read_layer(spark, folder)


# ------------------------------------------------------- classification queries


def silver_movements(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(silver_view(movements(spark, sf), MOVEMENTS))


def quarantine_customers(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine_view(customers(spark, sf), CUSTOMERS, CTX)


def quarantine_orders(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine_view(orders(spark, sf), ORDERS, CTX)


def quarantine_movements(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(quarantine_view(movements(spark, sf), MOVEMENTS, CTX))


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("posting_date", F.date_format("posting_date", "yyyy-MM-dd"))


def orphan_orders_anti(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.unmatched(
        b.bronze_orders(spark, sf),
        "customer_id",
        silver_customers(spark, sf),
        "customer_id",
        Staging.until_exit(spark),
    )


def valid_orders_semi(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.matched(
        b.bronze_orders(spark, sf),
        "customer_id",
        silver_customers(spark, sf),
        "customer_id",
        Staging.until_exit(spark),
    )


def quarantine_reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reason_histogram(quarantines(spark, sf), "table_name")


def layer_summaries(spark: SparkSession, sf: str) -> DataFrame:
    judged = shop_tables(spark, sf) | {"movements": movements(spark, sf)}
    return checks.union_results([layer_summary(df, name) for name, df in judged.items()])


# ---------------------------------------------------------------- check queries


def recon_customers(spark: SparkSession, sf: str) -> DataFrame:
    tagged = checks.tag_classified(customers(spark, sf), CUSTOMERS)
    return checks.named(
        checks.evaluate(tagged, [checks.quarantine_reconciliation()]), "customers"
    )


def recon_orders(spark: SparkSession, sf: str) -> DataFrame:
    tagged = checks.tag_classified(orders(spark, sf), ORDERS)
    return checks.named(checks.evaluate(tagged, [checks.quarantine_reconciliation()]), "orders")


def recon_movements(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = stored_movements(spark, sf)
    return _movement_recon(summary, "movements")


def recon_stored_movements(spark: SparkSession, sf: str) -> DataFrame:
    """Stored movement layers as they are, and with rows lost from either."""
    layers, _ = stored_movements(spark, sf)
    bronze, silver, quarantine = (
        readers.read_layer(spark, at("movements"))
        for at in (layers.bronze, layers.silver, layers.quarantine)
    )
    cases = {
        "sound": (silver, quarantine),
        "lost_silver": (silver.filter("doc_id % 7 <> 0"), quarantine),
        "lost_quarantine": (silver, quarantine.filter("doc_id % 7 <> 0")),
    }
    return checks.union_results(
        [
            _movement_recon(summary_of_layers(bronze, accepted, rejected, case), case)
            for case, (accepted, rejected) in cases.items()
        ]
    )


def _movement_recon(summary: DataFrame, table: str) -> DataFrame:
    facts = checks.layer_facts(summary)
    check = checks.movement_reconciliation("movement_quarantine_reconciliation")
    return checks.named(checks.evaluate(facts, [check]), table)


def check_stored_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Stored order layers, damaged in one way a case, and references between them."""
    layers = stored_shop(spark, sf)
    bronze, silver, quarantine, parents = (
        readers.read_layer(spark, where)
        for where in (
            layers.bronze("orders"),
            layers.silver("orders"),
            layers.quarantine("orders"),
            layers.silver("customers"),
        )
    )
    why = F.when(F.col("order_id") % 2 == 0, F.lit(" ")).otherwise(F.col("rejection_reason"))
    cases = {
        "sound": (silver, quarantine),
        "lost_rows": (silver.filter("order_id % 7 <> 0"), quarantine),
        "blank_reason": (silver, quarantine.withColumn("rejection_reason", why)),
        "no_reason": (silver, quarantine.drop("rejection_reason")),
        "no_quarantine": (silver, None),
    }
    parts = []
    for case, (accepted, rejected) in cases.items():
        spec = CheckSpec(case, ORDERS.bronze_columns, ORDERS.silver_columns, max_drop_pct=50.0)
        parts.append(checks.check_layers(bronze, accepted, rejected, spec))
    references = {
        "no_parent": (silver, None),
        "no_child": (None, parents),
        "lost_parents": (silver, parents.filter("customer_id % 7 <> 0")),
    }
    for case, (child, parent) in references.items():
        parts.append(
            checks.check_references(child, parent, "customer_id", "customer_id", table=case)
        )
    return checks.union_results(parts)


def check_row_count_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables against three sets of limits."""
    shop_rows = shop_tables(spark, sf)
    cases = [
        (shop_rows["customers"], CUSTOMERS, CUSTOMER_CHECKS),
        (shop_rows["orders"], ORDERS, ORDER_CHECKS),
        (
            movements(spark, sf),
            MOVEMENTS,
            CheckSpec("movements", max_drop_pct=50.0, warn_drop_pct=5.0, fail_drop_pct=60.0),
        ),
    ]
    return checks.union_results(
        [
            checks.named(
                checks.evaluate(
                    checks.tag_classified(rows, intake), [checks.row_count_delta(spec)]
                ),
                spec.table,
            )
            for rows, intake, spec in cases
        ]
    )


def check_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Contract kept, contract broken, and the variant that tolerates extra columns.
    The number of rows under the judged schema is reported along."""
    raw = {"customers": b.bronze_customers(spark, sf), "orders": b.bronze_orders(spark, sf)}
    expected_orders = ["order_id", "customer_id", "amount", "channel"]
    cases = [
        ("customers", b.CUSTOMER_SILVER, b.CUSTOMER_BRONZE, b.CUSTOMER_SILVER, True),
        ("orders", b.ORDER_SILVER, expected_orders, b.ORDER_SILVER, True),
        ("orders", b.ORDER_SILVER, expected_orders[:3], b.ORDER_SILVER, False),
    ]
    parts = []
    for table, silver, expected_bronze, expected_silver, strict in cases:
        drift = checks.schema_drift(
            raw[table].columns, silver, expected_bronze, expected_silver, flag_extra=strict
        )
        counted = replace(drift, metrics={**drift.metrics, "rows": "_rows"})
        parts.append(checks.named(checks.evaluate(raw[table], [counted]), table))
    return checks.union_results(parts)


def check_null_pct(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_customers(spark, sf)
    limits = {"email": 5.0, "name": 5.0, "country": 0.0, "phone": 0.0}
    judged = customers(spark, sf)
    silver = checks.tag_classified(judged, CUSTOMERS)
    return checks.union_results(
        [
            checks.evaluate(checks.as_silver(raw), checks.null_rates(raw, limits, "bronze")),
            checks.evaluate(silver, checks.null_rates(silver, limits, "silver"), 5),
        ]
    )


def check_null_pct_stages(spark: SparkSession, sf: str) -> DataFrame:
    stage_rows = events(spark, sf)
    facts = checks.event_facts(stage_rows, b.EVENT_STAGES)
    return checks.evaluate(facts, checks.stage_null_rates(b.EVENT_STAGES, stage_rows.columns))


def check_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_customers(spark, sf)
    texts = b.table(spark, sf, "documents").select("doc_id", "text")
    lines = b.table(spark, sf, "lineitem").select("l_orderkey")
    cases = {
        "customers": (raw, ["customer_id", "email", "phone"]),
        "documents": (texts, ["doc_id", "text"]),
        "lineitem": (lines, ["l_orderkey"]),
    }
    return checks.union_results(
        [
            checks.named(
                checks.evaluate(
                    checks.as_silver(df), checks.uniqueness(df, columns, "bronze", long=("text",))
                ),
                table,
            )
            for table, (df, columns) in cases.items()
        ]
    )


def check_email_format(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_customers(spark, sf)
    return checks.evaluate(checks.as_silver(raw), [checks.email_format(raw, layer="bronze")])


def check_amount_positive(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_orders(spark, sf)
    accounts = b.table(spark, sf, "customer")
    return checks.union_results(
        [
            checks.named(
                checks.evaluate(
                    checks.as_silver(raw), [checks.amount_positive(raw, layer="bronze")]
                ),
                "orders",
            ),
            checks.named(
                checks.evaluate(
                    checks.as_silver(accounts),
                    [checks.amount_positive(accounts, "c_acctbal", "bronze")],
                ),
                "customer",
            ),
        ]
    )


def check_allowed_values(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.bronze_orders(spark, sf)
    return checks.evaluate(
        checks.as_silver(raw),
        [checks.allowed_values(raw, "status", shop.ALLOWED_STATUS, "bronze")],
    )


def check_referential_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return checks.union_results(
        [
            checks.check_references(
                b.table(spark, sf, "documents"),
                b.table(spark, sf, "labels"),
                "doc_id",
                "doc_id",
                what="document(s) without a label",
                layer="bronze",
                table="documents",
            ),
            checks.check_references(
                b.bronze_orders(spark, sf),
                b.table(spark, sf, "customer"),
                "customer_id",
                "c_custkey",
                layer="bronze",
                table="orders",
            ),
        ]
    )


def dq_metrics_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    """All row-level measures of the raw orders in one aggregate over one scan."""
    return b.bronze_orders(spark, sf).selectExpr(
        "count(1) AS total_rows",
        f"count_if({bad.blank('customer_id')}) AS blank_customer_id",
        f"count_if({bad.blank('amount')}) AS blank_amount",
        f"count_if({bad.not_positive('amount')}) AS bad_amount",
        f"count_if({bad.not_in('status', shop.ALLOWED_STATUS)}) AS bad_status",
    )


# ------------------------------------------------------------ lead-time queries


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf)


def stages_present(spark: SparkSession, sf: str) -> DataFrame:
    return process.stages_present(events(spark, sf))


def stage_lead_times(spark: SparkSession, sf: str) -> DataFrame:
    return process.stage_lead_times(events(spark, sf))


def d2d_lead_times(spark: SparkSession, sf: str) -> DataFrame:
    return process.d2d_lead_times(events(spark, sf))


def e2e_lead_times(spark: SparkSession, sf: str) -> DataFrame:
    return process.e2e_lead_times(events(spark, sf), b.EVENT_STAGES)


def topk_handoffs(spark: SparkSession, sf: str) -> DataFrame:
    return process.slowest_handoffs(d2d_lead_times(spark, sf), 20)


def avg_stage_days(spark: SparkSession, sf: str) -> DataFrame:
    return process.mean_stage_days(stage_lead_times(spark, sf))


def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    stage_rows = staged_events(spark, sf)
    kpis = process.kpi_summary(
        process.stage_lead_times(stage_rows),
        process.d2d_lead_times(stage_rows),
        process.e2e_lead_times(stage_rows, b.EVENT_STAGES),
        b.EVENT_STAGES,
    )
    return kpis.withColumn("avg_stage_days_by_stage", F.to_json("avg_stage_days_by_stage"))


def check_allowed_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Against a model that lacks the last stage."""
    short = replace(b.EVENT_STAGES, stages=b.EVENT_STAGES.stages[:3])
    facts = checks.event_facts(events(spark, sf), short)
    return checks.evaluate(facts, [checks.allowed_stages()])


def check_unique_batch_stage(spark: SparkSession, sf: str) -> DataFrame:
    facts = checks.event_facts(events(spark, sf), b.EVENT_STAGES)
    return checks.evaluate(facts, [checks.unique_batch_stage()])


def check_non_negative_lead_times(spark: SparkSession, sf: str) -> DataFrame:
    rows = staged_events(spark, sf)
    stage_days, d2d = process.stage_lead_times(rows), process.d2d_lead_times(rows)
    e2e = process.e2e_lead_times(rows, b.EVENT_STAGES)
    facts = [
        checks.span_facts(stage_days, "stage_lead_time_days", "stage"),
        checks.span_facts(d2d, "d2d_lead_time_days", "d2d"),
        checks.span_facts(e2e, "e2e_lead_time_days", "e2e"),
    ]
    return checks.evaluate(checks.union_results(facts), [checks.non_negative_lead_times()])


def check_e2e_target(spark: SparkSession, sf: str) -> DataFrame:
    model = b.EVENT_STAGES
    facts = checks.span_facts(
        e2e_lead_times(spark, sf), "e2e_lead_time_days", "e2e", model.e2e_target_days
    )
    return checks.evaluate(facts, [checks.e2e_target_breach(model)])


def check_d2d_target(spark: SparkSession, sf: str) -> DataFrame:
    model = b.EVENT_STAGES
    facts = checks.span_facts(
        d2d_lead_times(spark, sf), "d2d_lead_time_days", "d2d", model.d2d_target_days
    )
    return checks.evaluate(facts, [checks.d2d_target_breach(model)])


# --------------------------------------------------------------- report queries


def dq_results_table(spark: SparkSession, sf: str) -> DataFrame:
    return report.history_rows(shop_results(spark, sf))


def dq_results_lead_time(spark: SparkSession, sf: str) -> DataFrame:
    """Movements are judged, folded and stored; the suite reads the stored layers."""
    layers, summary = stored_movements(spark, sf)
    runs.load_lead_times(spark, layers, b.EVENT_COLUMNS, b.EVENT_STAGES)
    return report.history_rows(
        runs.check_lead_time_layers(
            spark, layers, summary, CTX, b.EVENT_STAGES, "movement_quarantine_reconciliation"
        )
    )


def overall_status(spark: SparkSession, sf: str) -> DataFrame:
    return checks.overall_status(bronze_results(spark, sf))


def failed_checks_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return report.failed_checks_by_table(bronze_results(spark, sf))


def findings_by_table(spark: SparkSession, sf: str) -> DataFrame:
    return report.findings(bronze_results(spark, sf))


def latest_run_results(spark: SparkSession, sf: str) -> DataFrame:
    """Two different runs kept in a history, the raw checks and later the silver ones; the
    later run is shown."""
    folder = Staging.until_exit(spark).folder("history-results")
    for results in (shop_results(spark, sf, LATER), bronze_results(spark, sf)):
        writers.append_history(report.history_rows(results), folder)
    return report.latest_run(readers.read_history(spark, folder))


def history_table_new_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs in a history table, the second with columns that the first lacked."""
    where = LayerNames(Staging.until_exit(spark).database("history"), True).history("dq_results")
    first = report.history_rows(bronze_results(spark, sf))
    writers.append_history(first.select("run_id", "table_name", "check_name", "status"), where)
    second = report.history_rows(bronze_results(spark, sf, LATER))
    second = second.select("message", "run_id", "status", "check_name", "table_name", "metrics_json")
    writers.append_history(second, where)
    return readers.read_history(spark, where)


def report_snapshot_json(spark: SparkSession, sf: str) -> DataFrame:
    return report.run_snapshot(bronze_results(spark, sf))


def findings_from_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    decoded = report.decode_snapshot(report.run_snapshot(bronze_results(spark, sf)))
    return report.findings(decoded)


def narrative_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.narrative(bronze_results(spark, sf))


def history_append_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs appended to a stored history, then the newest snapshot read back."""
    folder = Staging.until_exit(spark).folder("history-snapshots")
    first = bronze_results(spark, sf)
    writers.append_history(report.run_snapshot(first), folder)
    second = shop_results(spark, sf, LATER)
    writers.append_history(report.run_snapshot(second), folder)
    newest = report.latest_snapshot(readers.read_history(spark, folder))
    return report.decode_snapshot(newest)


def narrative_history_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs' narratives appended to a stored history, then the newest read back."""
    folder = Staging.until_exit(spark).folder("history-narratives")
    for results in (bronze_results(spark, sf, LATER), shop_results(spark, sf)):
        writers.append_history(report.narrative(results), folder)
    newest = report.latest_snapshot(readers.read_history(spark, folder))
    return newest.select("run_id", "agent_mode", "analysis_md", "overall_status", "created_at")


def kpis_from_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over movements, judged, folded, stored and checked; its KPIs are read
    back from the snapshot in the history."""
    layers, summary = stored_movements(spark, sf)
    runs.load_lead_times(spark, layers, b.EVENT_COLUMNS, b.EVENT_STAGES)
    results = runs.check_lead_time_layers(spark, layers, summary, CTX, b.EVENT_STAGES)
    kpis = report.of_run(readers.read_layer(spark, layers.gold("kpi_summary")), CTX)
    writers.append_history(report.run_snapshot(results, kpis), layers.history("dq_run_snapshots"))
    stored = readers.read_history(spark, layers.history("dq_run_snapshots"))
    return report.decode_kpis(stored).withColumn(
        "avg_stage_days_by_stage", F.to_json("avg_stage_days_by_stage")
    )


REGISTRY: dict[str, Query] = {
    "dedup_first_seen": dedup_first_seen,
    "dedup_by_arrival": dedup_by_arrival,
    "code_to_stage_map": code_to_stage_map,
    "code_to_stage_table": code_to_stage_table,
    "silver_movements_by_codes": silver_movements_by_codes,
    "event_ts_fallback": event_ts_fallback,
    "silver_customers": silver_customers,
    "quarantine_customers": quarantine_customers,
    "silver_orders": silver_orders,
    "quarantine_orders": quarantine_orders,
    "silver_movements": silver_movements,
    "quarantine_movements": quarantine_movements,
    "quarantine_all_tables": quarantines,
    "orphan_orders_anti": orphan_orders_anti,
    "valid_orders_semi": valid_orders_semi,
    "quarantine_reason_histogram": quarantine_reason_histogram,
    "layer_summary": layer_summaries,
    "recon_customers": recon_customers,
    "recon_orders": recon_orders,
    "recon_movements": recon_movements,
    "recon_stored_movements": recon_stored_movements,
    "check_stored_layers": check_stored_layers,
    "check_row_count_delta": check_row_count_delta,
    "check_schema_drift": check_schema_drift,
    "check_null_pct": check_null_pct,
    "check_null_pct_stages": check_null_pct_stages,
    "check_uniqueness": check_uniqueness,
    "check_email_format": check_email_format,
    "check_amount_positive": check_amount_positive,
    "check_allowed_values": check_allowed_values,
    "check_referential_integrity": check_referential_integrity,
    "dq_metrics_single_pass": dq_metrics_single_pass,
    "stage_events": stage_events,
    "stages_present": stages_present,
    "stage_lead_times": stage_lead_times,
    "d2d_lead_times": d2d_lead_times,
    "e2e_lead_times": e2e_lead_times,
    "topk_handoffs": topk_handoffs,
    "avg_stage_days": avg_stage_days,
    "kpi_summary": kpi_summary,
    "check_allowed_stages": check_allowed_stages,
    "check_unique_batch_stage": check_unique_batch_stage,
    "check_non_negative_lead_times": check_non_negative_lead_times,
    "check_e2e_target": check_e2e_target,
    "check_d2d_target": check_d2d_target,
    "dq_results_table": dq_results_table,
    "dq_results_lead_time": dq_results_lead_time,
    "overall_status": overall_status,
    "failed_checks_by_table": failed_checks_by_table,
    "latest_run_results": latest_run_results,
    "findings_by_table": findings_by_table,
    "history_table_new_columns": history_table_new_columns,
    "report_snapshot_json": report_snapshot_json,
    "findings_from_snapshot": findings_from_snapshot,
    "narrative_report": narrative_report,
    "history_append_latest": history_append_latest,
    "narrative_history_latest": narrative_history_latest,
    "kpis_from_snapshot": kpis_from_snapshot,
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "scan_csv_escaped": scan_csv_escaped,
    "layers_by_name": layers_by_name,
    "sink_overwrite_roundtrip": sink_overwrite_roundtrip,
}
