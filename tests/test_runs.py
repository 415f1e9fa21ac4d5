"""End-to-end runs over stored layers, sources and sinks."""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
import samples
from pyspark.sql import functions as F

from siltgate.context import RunContext
from siltgate.operators import checks, dedup, report
from siltgate.contracts import StageModel
from siltgate.plans import goods, runs, shop
from siltgate.sources import readers, writers
from siltgate.sources.layers import LayerNames, ensure_namespace
from siltgate.sources.staging import Staging, staging_root

FIRST = RunContext("20240131T000000Z-00000001", datetime(2024, 1, 31, tzinfo=timezone.utc))
SECOND = RunContext("20240201T000000Z-00000002", datetime(2024, 2, 1, tzinfo=timezone.utc))


def customers_of(spark, folder):
    return samples.stored(spark, folder, "customers", samples.CUSTOMERS, samples.CUSTOMER_SCHEMA)


def test_shop_run(spark, tmp_path):
    layers = LayerNames(str(tmp_path))
    # raw rows without an arrival number: one input split, so landing keeps their order
    people = customers_of(spark, tmp_path).drop("_arrival")
    orders = samples.stored(spark, tmp_path, "orders", samples.ORDERS, samples.ORDER_SCHEMA)
    orders = orders.drop("_arrival")
    for ctx in (FIRST, SECOND, SECOND):  # the second run is retried
        summary = runs.run_shop(spark, people, orders, layers, ctx)
    assert {tuple(r) for r in summary.collect()} == {("customers", 7, 3, 4), ("orders", 8, 2, 6)}
    history = readers.read_history(spark, layers.history("dq_results"))
    assert {r.run_id: r["count"] for r in history.groupBy("run_id").count().collect()} == {
        FIRST.run_id: 18, SECOND.run_id: 18,
    }
    assert set(history.columns) == set(report.RESULT_COLUMNS)
    newest = report.latest_run(history).collect()
    assert len(newest) == 18 and {r.status for r in newest} == {"PASS"}
    snapshot = report.latest_snapshot(
        readers.read_history(spark, layers.history("dq_run_snapshots"))
    ).collect()[0]
    assert snapshot.run_id == SECOND.run_id
    content = json.loads(snapshot.report_json)
    assert [t["table"] for t in content["tables"]] == ["_cross_", "customers", "orders"]
    assert content["overall_status"] == "PASS"
    assert json.loads(content["tables"][1]["checks"][0]["metrics"])["silver_count"] == 3
    story = readers.read_history(spark, layers.history("dq_agent_reports")).collect()
    assert all("None." in r.analysis_md for r in story) and len(story) == 2


def test_failed_gate_leaves_history(spark, tmp_path):
    layers = LayerNames(str(tmp_path))
    customer = shop.customer_intake(samples.columns(samples.CUSTOMER_SCHEMA))
    runs.load_layers(
        spark, [runs.TableRun(customers_of(spark, tmp_path), customer)], layers, FIRST
    )
    lost = readers.read_layer(spark, layers.quarantine("customers")).limit(1)
    with Staging(spark) as staging:
        writers.write_layer(staging.table(lost, "lost"), layers.quarantine("customers"))
    results = runs.check_tables(
        spark, [shop.customer_checks(customer)], layers, FIRST,
        {"customers": customer.bronze_columns},
    )
    with pytest.raises(checks.QualityGateError, match="quarantine_reconciliation"):
        runs.store_and_gate(results, layers)
    stored = readers.read_history(spark, layers.history("dq_results"))
    assert stored.filter("overall_status = 'FAIL'").count() == 8
    story = readers.read_history(spark, layers.history("dq_agent_reports")).collect()[0]
    assert "quarantine_reconciliation" in story.analysis_md


def test_without_quarantine_the_drop_is_judged(spark, tmp_path):
    layers = LayerNames(str(tmp_path))
    customer = shop.customer_intake(samples.columns(samples.CUSTOMER_SCHEMA))
    rows = customers_of(spark, tmp_path)
    writers.write_layer(rows, layers.bronze("customers"))
    kept = rows.filter("email IS NOT NULL").select(*shop.CUSTOMER_SILVER)
    writers.write_layer(kept, layers.silver("customers"))
    results = runs.check_tables(
        spark, [shop.customer_checks(customer)], layers, FIRST,
        {"customers": customer.bronze_columns},
    )
    found = {r.check_name: (r.status, r.message) for r in results.collect()}
    assert "quarantine_reconciliation" not in found
    assert found["row_count_delta"] == ("WARN", "Bronze=7, Silver=6, dropped=1 (14.3%)")
    assert readers.read_layer_if_present(spark, "no_such_table") is None


def test_lead_time_run(spark, tmp_path):
    layers = LayerNames(str(tmp_path))
    moves = samples.stored(spark, tmp_path, "moves", samples.movements_text(), samples.MOVEMENT_SCHEMA)
    summary = runs.run_goods(spark, moves, layers, FIRST)
    assert [tuple(r) for r in summary.collect()] == [("movements", 59, 54, 5)]
    sizes = {
        name: readers.read_layer(spark, where).count()
        for name, where in {
            "events": layers.silver("stage_events"),
            "stage": layers.gold("stage_lead_times"),
            "d2d": layers.gold("d2d_lead_times"),
            "e2e": layers.gold("e2e_lead_times"),
        }.items()
    }
    assert sizes == {"events": 27, "stage": 27, "d2d": 24, "e2e": 2}
    results = runs.check_lead_time_layers(spark, layers, summary, FIRST)
    stored = readers.read_history(spark, layers.history("dq_results"))
    assert {r.overall_status for r in stored.collect()} == {"WARN"}
    found = {r.check_name: r.advice for r in report.findings(results).collect()}
    assert list(found) == ["d2d_target_breach"] and found["d2d_target_breach"]
    snapshots = readers.read_history(spark, layers.history("dq_run_snapshots"))
    kpis = report.decode_kpis(snapshots).first()
    assert (kpis.run_id, kpis.batches_with_e2e, kpis.d2d_handoffs) == (FIRST.run_id, 2, 24)
    assert len(kpis.avg_stage_days_by_stage) == 12 and kpis.avg_d2d_days > 0
    story = readers.read_history(spark, layers.history("dq_agent_reports")).first().analysis_md
    assert f"- Between stages: {kpis.avg_d2d_days} days" in story
    assert "- Stage `customer`: " in story and "- `lead_time`: WARN" in story


def test_staged_tables_are_removed(spark):
    root = staging_root(spark)
    with Staging(spark) as staging:
        stored = staging.table(spark.range(5), "probe")
        assert stored.count() == 5
        path = stored.inputFiles()[0]
        assert root in path
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


class _Session:
    """As much of a session as the choice of the staging folder looks at."""

    def __init__(self, configured, checkpoint_dir, master):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = self
        self.master = master
        self._dir = checkpoint_dir

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


def test_choice_of_the_staging_folder():
    assert staging_root(_Session("s3a://x/", None, "yarn")) == "s3a://x"
    assert staging_root(_Session(None, "hdfs://y", "yarn")) == "hdfs://y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(_Session(None, None, "yarn"))
    local = _Session(None, None, "local[2]")
    assert staging_root(local) == staging_root(local) == local.getCheckpointDir()


def test_csv_pads_short_rows_and_keeps_text(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text("code,qty,note\n007,1,\n008,2\n,3,x\n")
    declared = readers.read_csv(spark, str(source), "code STRING, qty INT, note STRING")
    assert [tuple(r) for r in declared.collect()] == [
        ("007", 1, None), ("008", 2, None), (None, 3, "x"),
    ]
    assert readers.read_csv(spark, str(source)).schema["code"].dataType.simpleString() == "int"
    target = str(tmp_path / "out")
    df = spark.createDataFrame([("  ", 1), (None, 2), ('say "hi"', 3)], "note STRING, n INT")
    writers.write_csv(df, target)
    back = readers.read_csv(spark, target, "note STRING, n INT").orderBy("n")
    assert [r.note for r in back.collect()] == ["  ", None, 'say "hi"']


def test_empty_csv_has_its_header(spark, tmp_path):
    target = str(tmp_path / "empty")
    writers.write_csv(spark.createDataFrame([], "a STRING, b INT"), target)
    assert spark.read.text(target).collect()[0].value == "a,b"
    assert readers.read_csv(spark, target, "a STRING, b INT").count() == 0


def test_stage_model_from_mapping():
    model = StageModel.from_mapping(
        {
            "stages": ["a", "b"],
            "codes": {101: "a", "Z1": "b"},
            "rules": {"max_null_pct_stages": {"stage": 0}},
            "targets": {"d2d_days": 3},
        },
        "codes",
    )
    assert (model.first, model.last, model.stage_order) == ("a", "b", {"a": 1, "b": 2})
    assert model.code_to_stage == {"101": "a", "Z1": "b"}
    assert (model.d2d_target_days, model.e2e_target_days) == (3.0, 60.0)
    assert len(goods.LIFE_CYCLE.stages) == 12 and len(goods.LIFE_CYCLE.code_to_stage) == 31
    assert set(goods.LIFE_CYCLE.code_to_stage.values()) == set(goods.LIFE_CYCLE.stages)


def test_write_layer_counts_and_replaces_schema(spark, tmp_path):
    where = str(tmp_path / "layer")
    assert writers.write_layer(spark.range(7), where).get["rows"] == 7
    writers.write_layer(spark.range(2).withColumn("x", F.lit("a")), where)
    assert readers.read_layer(spark, where).columns == ["id", "x"]


def test_landing_gives_a_stable_arrival(spark, tmp_path):
    where = str(tmp_path / "landed")
    writers.land(spark.range(100).repartition(5), where)
    landed = readers.read_layer(spark, where)
    assert landed.select("_arrival").distinct().count() == 100
    assert readers.preview(landed, ["_arrival"], 3).count() == 3


def test_history_with_another_schema(spark, tmp_path):
    where = str(tmp_path / "history")
    writers.append_history(spark.createDataFrame([("r1", 1)], "run_id STRING, a INT"), where)
    writers.append_history(
        spark.createDataFrame([("r2", 2, 3)], "run_id STRING, a INT, b INT"), where
    )
    rows = {r.run_id: r.b for r in readers.read_history(spark, where).collect()}
    assert rows == {"r1": None, "r2": 3}


def test_namespace_falls_back_to_a_database(spark):
    used = ensure_namespace(spark, "no_such_catalog", "silt_db")
    assert used == "silt_db"
    layers = LayerNames(used, as_tables=True)
    writers.write_layer(spark.range(3), layers.silver("things"))
    assert readers.read_layer(spark, layers.silver("things")).count() == 3
    assert layers.registry(["things"])["quarantine_things"] == "silt_db.quarantine_things"
    with pytest.raises(ValueError, match="unknown history"):
        layers.history("other")
    spark.sql("DROP DATABASE silt_db CASCADE")
    spark.sql("USE default")


def test_run_context():
    ctx = RunContext.start()
    assert ctx.run_id[8] == "T" and ctx.run_id[15:17] == "Z-" and len(ctx.run_id) == 25
    assert ctx.iso_now.endswith("+00:00")


def test_history_in_a_table_keeps_run_ids(spark):
    for table in ("gate_history", "default.gate_history_2"):
        for run in ("007", "2024-01-31", "007"):
            writers.append_history(spark.createDataFrame([(run, 1)], "run_id STRING, a INT"), table)
        rows = readers.read_history(spark, table).collect()
        assert sorted((r.run_id, r.a) for r in rows) == [("007", 1), ("2024-01-31", 1)]


def test_history_in_a_folder_keeps_run_ids(spark, tmp_path):
    where = str(tmp_path / "history")
    for run in ("007", "2024-01-31", "007"):
        writers.append_history(spark.createDataFrame([(run, 1)], "run_id STRING, a INT"), where)
    rows = readers.read_history(spark, where).collect()
    assert sorted((r.run_id, r.a) for r in rows) == [("007", 1), ("2024-01-31", 1)]


def test_csv_keeps_line_breaks(spark, tmp_path):
    where = str(tmp_path / "csv")
    rows = [(1, "a\nb"), (2, "c")]
    writers.write_csv(spark.createDataFrame(rows, "k INT, v STRING"), where)
    back = readers.read_csv(spark, where, "k INT, v STRING", multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_unknown_checks_are_told(spark):
    from siltgate.operators import checks, report

    columns = (
        "run_id STRING, check_no INT, table_name STRING, check_name STRING, status STRING, "
        "message STRING, metrics_json STRING, overall_status STRING, checked_at STRING"
    )
    rows = [("r", n, "t", f"ledger_{n}", "FAIL", None if n else "off", "{}", "FAIL", "now") for n in range(9)]
    results = spark.createDataFrame(rows, columns)
    story = report.narrative(results).first().analysis_md
    assert all(f"t.ledger_{n}`" in story for n in range(9)) and "None." not in story
    with pytest.raises(checks.QualityGateError) as gate:
        checks.enforce_gate(results)
    assert all(f"t.ledger_{n}:" in str(gate.value) for n in range(9))


def test_runs_in_table_form(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS silt_runs")
    layers = LayerNames("silt_runs", as_tables=True)
    people = customers_of(spark, tmp_path)
    orders = samples.stored(spark, tmp_path, "orders", samples.ORDERS, samples.ORDER_SCHEMA)
    for run in ("007", "2024-01-31", "007"):
        runs.run_shop(spark, people, orders, layers, RunContext(run, FIRST.now))
    moves = samples.stored(spark, tmp_path, "moves", samples.movements_text(), samples.MOVEMENT_SCHEMA)
    runs.run_goods(spark, moves, layers, RunContext("008", SECOND.now))
    history = readers.read_history(spark, layers.history("dq_results"))
    counts = {r.run_id: r["count"] for r in history.groupBy("run_id").count().collect()}
    assert counts == {"007": 18, "2024-01-31": 18, "008": 10}
    for table in ("dq_run_snapshots", "dq_agent_reports"):
        kept = readers.read_history(spark, layers.history(table)).collect()
        assert sorted(r.run_id for r in kept) == ["007", "008", "2024-01-31"]
    assert readers.read_layer(spark, layers.silver("customers")).count() == 3
    spark.sql("DROP DATABASE silt_runs CASCADE")


@pytest.mark.parametrize("first_rows, second_rows", [(1, 400), (400, 1)])
def test_arrival_follows_names_and_not_sizes(spark, tmp_path, first_rows, second_rows):
    source = tmp_path / "in"
    source.mkdir()
    for name, rows in (("a.csv", first_rows), ("b.csv", second_rows)):
        lines = [f"1,{name}", *[f"{name}{n},x" for n in range(rows)]]
        (source / name).write_text("\n".join(["k,v", *lines]) + "\n")
    where = str(tmp_path / "landed")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
        writers.land(readers.read_csv(spark, str(source), "k STRING, v STRING"), where)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landed = readers.read_layer(spark, where)
    assert landed.filter("k = '1'").orderBy("_arrival").first().v == "a.csv"
    numbered = landed.filter("v = 'x'").orderBy("_arrival").collect()
    wanted = [f"{f}{n}" for f, n in (("a.csv", first_rows), ("b.csv", second_rows)) for n in range(n)]
    assert [r.k for r in numbered] == wanted


def test_arrival_is_one_number_found_by_hashing(spark, tmp_path):
    """Names with blanks and signs; no path in the rows, no sort for the least arrival."""
    source = tmp_path / "in put"
    source.mkdir()
    for name in ("b%20 c.csv", "a+ä.csv"):
        (source / name).write_text("k,v\n" + "".join(f"{n % 3},{name}\n" for n in range(9)))
    where = str(tmp_path / "landed")
    writers.land(readers.read_csv(spark, str(source), "k STRING, v STRING"), where)
    landed = readers.read_layer(spark, where)
    assert landed.schema["_arrival"].dataType.simpleString() == "decimal(38,0)"
    assert landed.select("_arrival").distinct().count() == 18
    keys = dedup._repeated_keys(landed, ["k"], ["_arrival"], ["_key0"])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and plan.count("Exchange") == 1
    with Staging(spark) as staging:
        first = dedup.first_rows(landed, ["k"], ["_arrival"], staging).collect()
    assert {(r.k, r.v) for r in first} == {("0", "a+ä.csv"), ("1", "a+ä.csv"), ("2", "a+ä.csv")}


def test_history_table_takes_new_columns(spark, tmp_path):
    spark.sql(f"CREATE DATABASE silt_history LOCATION '{tmp_path}/db'")
    where = "silt_history.dq_results"
    for rows, schema in (
        ([("r1", 1)], "run_id STRING, a INT"),
        ([("r2", "x", [1.5])], "run_id STRING, B STRING, c ARRAY<DOUBLE>"),
        ([("r3", "y", 3)], "run_id STRING, b STRING, a SMALLINT"),
        ([("r2", "z", 4)], "run_id STRING, b STRING, A INT"),
    ):
        writers.append_history(spark.createDataFrame(rows, schema), where)
    stored = readers.read_history(spark, where)
    assert stored.columns == ["a", "B", "c", "run_id"]
    assert sorted(map(tuple, stored.collect()), key=lambda r: r[3]) == [
        (1, None, None, "r1"), (4, "z", None, "r2"), (3, "y", None, "r3"),
    ]
    wrong = spark.createDataFrame([("r4", "text", 9)], "run_id STRING, a STRING, d INT")
    with pytest.raises(ValueError, match="'a' is int in the history and string"):
        writers.append_history(wrong, where)
    assert readers.read_history(spark, where).columns == ["a", "B", "c", "run_id"]
    spark.sql("DROP DATABASE silt_history CASCADE")


@pytest.mark.parametrize("as_tables", [False, True])
def test_a_failed_replace_leaves_the_old_layer(spark, tmp_path, as_tables):
    if as_tables:
        spark.sql(f"CREATE DATABASE silt_swap LOCATION '{tmp_path}/db'")
    where = LayerNames("silt_swap" if as_tables else str(tmp_path), as_tables).silver("x")
    writers.write_layer(spark.range(5), where)
    # Half of the tasks write, then one fails.
    broken = spark.range(0, 100, 1, 8).select(F.expr("if(id = 90, raise_error('cut'), id)").alias("n"))
    with pytest.raises(Exception, match="cut"):
        writers.write_layer(broken, where)
    assert sorted(r.id for r in readers.read_layer(spark, where).collect()) == list(range(5))
    both = broken.select("n", F.when(F.col("n") % 2 == 0, "even").otherwise("odd").alias("_layer"))
    targets = {k: (where if k == "even" else f"{where}_odd", spark.range(0).schema) for k in ("even", "odd")}
    with pytest.raises(Exception, match="cut"):
        writers.write_layers(both, targets)
    assert readers.read_layer(spark, where).count() == 5
    writers.write_layer(spark.range(3).withColumn("more", F.lit("b")), where)
    writers.write_layer(spark.range(4).withColumn("more", F.lit("b")), where)
    assert readers.read_layer(spark, where).count() == 4
    left = [p.name for p in tmp_path.rglob("*") if p.is_dir() and (".new-" in p.name or ".before" in p.name)]
    assert left == []
    if as_tables:
        spark.sql("DROP DATABASE silt_swap CASCADE")


def test_a_swap_cut_off_between_its_moves_is_mended(spark, tmp_path):
    where = tmp_path / "silver_x"
    writers.write_layer(spark.range(5), str(where))
    where.rename(tmp_path / "_silver_x.before")
    assert readers.read_layer(spark, str(where)).count() == 5
    where.rename(tmp_path / "_silver_x.before")
    writers.write_layer(spark.range(2), str(where))
    assert readers.read_layer(spark, str(where)).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_layer(spark, str(tmp_path / "silver_y"))


@pytest.mark.parametrize("as_tables", [False, True])
def test_rows_are_judged_and_written_once(spark, tmp_path, as_tables, monkeypatch):
    """One job stores both layers; the plan that it runs has one scan of bronze."""
    if as_tables:
        spark.sql(f"CREATE DATABASE silt_once LOCATION '{tmp_path}/db'")
    layers = LayerNames("silt_once" if as_tables else str(tmp_path / "layers"), as_tables)
    customer = shop.customer_intake(samples.columns(samples.CUSTOMER_SCHEMA))
    plans = []
    write = runs.write_layers

    def seen(rows, targets):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, targets)

    monkeypatch.setattr(runs, "write_layers", seen)
    summary = runs.load_layers(spark, [runs.TableRun(customers_of(spark, tmp_path), customer)], layers, FIRST)
    assert [tuple(r) for r in summary.collect()] == [("customers", 7, 3, 4)]
    assert len(plans) == 1
    assert plans[0].count("FileScan") == 2  # bronze, and the stored keys
    silver, quarantine = (readers.read_layer(spark, at("customers")) for at in (layers.silver, layers.quarantine))
    assert silver.columns == list(shop.CUSTOMER_SILVER)
    assert quarantine.columns == [*samples.columns(samples.CUSTOMER_SCHEMA), "rejection_reason", "rejected_at"]
    assert silver.filter("country IS NULL").isEmpty() and quarantine.filter("rejection_reason IS NULL").isEmpty()
    none = customers_of(spark, tmp_path).limit(0)
    runs.load_layers(spark, [runs.TableRun(none, customer)], layers, SECOND)
    again = [readers.read_layer(spark, at("customers")) for at in (layers.silver, layers.quarantine)]
    assert [df.count() for df in again] == [0, 0] and again[0].columns == silver.columns
    if as_tables:
        spark.sql("DROP DATABASE silt_once CASCADE")


def test_rows_of_no_layer_stop_the_write(spark, tmp_path):
    rows = spark.range(4).withColumn("_layer", F.when(F.col("id") > 1, "a").when(F.col("id") > 0, "b"))
    with pytest.raises(ValueError, match="2 row"):
        writers.write_layers(rows, {"a": (str(tmp_path / "a"), spark.range(0).schema)})
    assert not (tmp_path / "a").exists()
