"""Edge cases of the single operators."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from siltgate.context import RunContext
from siltgate.contracts import CheckSpec, Intake, Lookup, Rule, StageModel
from siltgate.functions import numbers, predicates, sql, timestamps
from siltgate.operators import checks, dedup, lookups, process, report
from siltgate.operators.classify import classify, reason_histogram, split, union_quarantines

CTX = RunContext("20240131T000000Z-00000001", datetime(2024, 1, 31, tzinfo=timezone.utc))


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def only(df, **wanted):
    rows = df.collect()
    match = [r for r in rows if all(r[k] == v for k, v in wanted.items())]
    assert len(match) == 1, rows
    return match[0]


# ------------------------------------------------------------------ expressions


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("\t",), ("a",)], "v STRING")
    got = column(df.selectExpr(predicates.blank("v") + " AS x"))
    assert got == [True, True, True, False, False]
    assert column(spark.range(1).selectExpr(predicates.blank("id") + " AS x")) == [False]


def test_malformed_email(spark):
    values = [("a.b+c@x-y.org",), ("a@b",), ("a b@c.de",), (None,), ("",)]
    df = spark.createDataFrame(values, "v STRING")
    assert column(df.selectExpr(predicates.malformed("v") + " AS x")) == [
        False, True, True, True, True,
    ]


def test_amount_predicates_on_text_and_nan(spark):
    df = spark.createDataFrame(
        [("1.5",), ("0",), ("-2",), ("abc",), (None,), ("NaN",)], "v STRING"
    )
    assert column(df.selectExpr(predicates.not_positive("v") + " AS x")) == [
        False, True, True, True, True, False,
    ]
    assert column(df.selectExpr(predicates.negative_or_missing("v") + " AS x")) == [
        False, False, True, True, True, False,
    ]


def test_membership_and_null(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "v STRING")
    assert column(df.selectExpr(predicates.not_in("v", ["a"]) + " AS x")) == [False, True, True]
    assert column(df.selectExpr(predicates.present_but_not_in("v", ["a"]) + " AS x")) == [
        False, True, False,
    ]


def test_first_timestamp_of_text(spark):
    df = spark.createDataFrame(
        [("2024-01-02 03:04:05", "2024-01-01"), ("soon", "2024-01-01"), ("", None)],
        "entry STRING, day STRING",
    )
    got = column(df.selectExpr(timestamps.first_timestamp(df.schema, "entry", "day") + " AS x"))
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 1), None]


def test_first_timestamp_of_typed_columns(spark):
    df = spark.createDataFrame([(None, date(2024, 1, 1))], "entry TIMESTAMP_NTZ, day DATE")
    df = df.selectExpr("*", timestamps.first_timestamp(df.schema, "entry", "day") + " AS x")
    assert df.schema["x"].dataType.simpleString() == "timestamp_ntz"
    assert column(df) == [datetime(2024, 1, 1)]
    zoned = df.withColumn("entry", F.col("entry").cast("timestamp"))
    x = timestamps.first_timestamp(zoned.schema, "entry", "day")
    assert zoned.selectExpr(f"{x} AS x").schema["x"].dataType.simpleString() == "timestamp"


def test_days_cut_both_ends_to_seconds(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00.9' AS a, TIMESTAMP_NTZ'2024-01-01 03:28:48.1' b"
    )
    assert column(df.select(numbers.days_between(F.col("a"), F.col("b")).alias("x"))) == [0.15]
    assert column(df.select(numbers.days_between(F.col("b"), F.col("a")).alias("x"))) == [-0.15]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "v DOUBLE")
    assert column(df.select(numbers.clamp_negative(F.col("v")).alias("x"))) == [0.0, None, 2.0]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (1, 8), (2, 3)], "p BIGINT, t BIGINT")
    assert column(df.selectExpr(numbers.percentage_text("p", "t") + " AS x")) == [
        "33.3", "0.0", "12.5", "66.7",
    ]
    rounded = df.selectExpr(numbers.percentage_2("p", "t") + " AS x")
    assert column(rounded) == [33.33, 0.0, 12.5, 66.67]


def test_mean_of_hundredths(spark):
    df = spark.createDataFrame([(8.58,), (10.63,), (None,)], "v DOUBLE")
    assert column(df.agg(numbers.mean_of_hundredths(F.col("v")).alias("x"))) == [9.61]
    minus = df.select((-F.col("v")).alias("v"))
    assert column(minus.agg(numbers.mean_of_hundredths(F.col("v")).alias("x"))) == [-9.61]
    none = df.filter("v > 100")
    assert column(none.agg(numbers.mean_of_hundredths(F.col("v")).alias("x"))) == [None]


def test_quoting(spark):
    odd = "it's {a} \\ `b`"
    df = spark.createDataFrame([(odd, 1)], "x STRING, `a ``b` INT")
    row = df.selectExpr(
        f"x = {sql.text(odd)} AS same",
        f"{sql.message(sql.plain(odd) + '={n}', n=sql.name('a `b'))} AS shown",
        f"{sql.map_value({odd: 2}, 'x')} AS found",
        f"{sql.map_value({'other': 2}, 'x')} AS missing",
        f"{sql.strings([])} AS none",
    ).collect()[0]
    assert tuple(row) == (True, f"{odd}=1", 2, None, [])


# ---------------------------------------------------------------------- dedup


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame(
        [(None, 2), (None, 1), ("a", 1), ("b", 5), ("b", 4)], "k STRING, o INT"
    )
    first = {(r.k, r.o) for r in dedup.first_rows(df, ["k"], ["o"]).collect()}
    assert first == {(None, 1), ("a", 1), ("b", 4)}
    marked = dedup.mark_repeats(df, ["k"], ["o"]).filter("_repeat")
    assert {(r.k, r.o) for r in marked.collect()} == {(None, 2), ("b", 5)}


def test_order_may_hold_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", 2)], "k STRING, o INT")
    marked = dedup.mark_repeats(df, ["k"], ["o"])
    assert {(r.k, r.o) for r in marked.filter("NOT _repeat").collect()} == {("a", None), ("b", 2)}


def test_first_rows_keeps_one_of_identical_copies(spark):
    df = spark.createDataFrame([("a", 1, "x")] * 5 + [("a", 1, "w")], "k STRING, o INT, v STRING")
    assert [tuple(r) for r in dedup.first_rows(df, ["k"], ["o"]).collect()] == [("a", 1, "w")]


def test_ties_fall_to_the_remaining_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "b", {"x": 1}), (1, 5, "a", {"x": 2}), (1, 6, "c", {}), (None, None, "d", None),
         (None, None, "d", None), (2, 1, "e", None)],
        "k INT, o INT, v STRING, m MAP<STRING, INT>",
    )
    marked = dedup.mark_repeats(df, ["k"], ["o"])
    assert marked.count() == 6
    kept = marked.filter("NOT _repeat").collect()
    assert sorted((str(r.k), r.v) for r in kept) == [("1", "a"), ("2", "e"), ("None", "d")]


# ------------------------------------------------------------------- classify


INTAKE = Intake(
    name="t",
    key=("k",),
    order_by=("o",),
    duplicate_reason="repeat",
    rules=(
        Rule("bad_v", predicates.not_positive("v")),
        Rule("odd", "w = 'odd'"),
    ),
    bronze_columns=("k", "o", "v", "w"),
    silver_columns=("k", "v"),
)
SCHEMA = "k STRING, o INT, v STRING, w STRING"


def test_first_failure_wins_and_dedup_comes_first(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "-1", "x"),  # a bad first copy is rejected for its own reason
            ("a", 2, "5", "x"),  # and the good later copy is still a repeat
            ("b", 1, "-1", "odd"),
            ("c", 1, "5", "odd"),
            ("d", 1, "abc", "x"),  # not a number: rejected, not lost
            ("e", 1, "5", None),  # undecidable: rejected, not lost
            ("f", 1, "5", "x"),
        ],
        SCHEMA,
    )
    silver, quarantine = split(classify(df, INTAKE), INTAKE, CTX)
    assert [tuple(r) for r in silver.collect()] == [("f", "5")]
    assert {(r.k, r.o, r.rejection_reason) for r in quarantine.collect()} == {
        ("a", 1, "bad_v"), ("a", 2, "repeat"), ("b", 1, "bad_v"), ("c", 1, "odd"),
        ("d", 1, "bad_v"), ("e", 1, "odd"),
    }
    assert {r.rejected_at for r in quarantine.collect()} == {"2024-01-31T00:00:00+00:00"}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    judged = classify(df, INTAKE)
    assert judged.count() == 0
    spec = CheckSpec(
        "t", INTAKE.bronze_columns, INTAKE.silver_columns, {"k": 0.0}, ("k",), positive_column="v"
    )
    rows = checks.check_classified(judged, INTAKE, spec).collect()
    assert {r.status for r in rows} == {"PASS"} and len(rows) == 5


def test_lookup_needs_parent(spark):
    intake = replace(INTAKE, lookup=Lookup("k", "k", "orphan"))
    with pytest.raises(ValueError, match="parent"):
        classify(spark.createDataFrame([], SCHEMA), intake)


def test_lookups_and_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k STRING")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "p STRING")
    assert sorted(column(lookups.matched(child, "k", parent, "p"), "k")) == ["a", "a"]
    assert set(column(lookups.unmatched(child, "k", parent, "p"), "k")) == {"z", None}
    assert column(lookups.count_unmatched(child, "k", parent, "p"), "unmatched") == [2]
    marked = {
        (r.k, r._unmatched) for r in lookups.mark_unmatched(child, "k", parent, "p").collect()
    }
    assert marked == {("a", False), ("z", True), (None, True)}
    assert column(lookups.count_unmatched(child.limit(0), "k", parent, "p"), "unmatched") == [0]


def test_union_of_quarantines_and_histogram(spark):
    a = spark.createDataFrame(
        [(1, "r1", "t")], "x INT, rejection_reason STRING, rejected_at STRING"
    )
    b = spark.createDataFrame(
        [(2, "r2", "t"), (3, "r2", "t")], "y INT, rejection_reason STRING, rejected_at STRING"
    )
    merged = union_quarantines({"a": a, "b": b}, ["x", "y"])
    assert {(r.table_name, r.x, r.y) for r in merged.collect()} == {
        ("a", 1, None), ("b", None, 2), ("b", None, 3),
    }
    assert [tuple(r) for r in reason_histogram(merged).collect()] == [("r2", 2), ("r1", 1)]


# --------------------------------------------------------------------- checks


@pytest.mark.parametrize(
    ("bronze", "silver", "status", "shown"),
    [
        (100, 100, "PASS", "0.0%"),
        (100, 96, "PASS", "4.0%"),
        (100, 95, "WARN", "5.0%"),
        (100, 85, "FAIL", "15.0%"),
        (100, 120, "PASS", "0.0%"),
        (0, 0, "PASS", "0.0%"),
    ],
)
def test_row_count_limits(spark, bronze, silver, status, shown):
    spec = CheckSpec("t", max_drop_pct=50)
    rows = checks.check_layers(spark.range(bronze), spark.range(silver), None, spec)
    found = only(rows, check_name="row_count_delta")
    assert found.status == status and shown in found.message


def test_max_drop_is_its_own_trigger(spark):
    spec = CheckSpec("t", max_drop_pct=3.0, warn_drop_pct=5.0, fail_drop_pct=15.0)
    rows = checks.check_layers(spark.range(100), spark.range(96), None, spec)
    assert only(rows, check_name="row_count_delta").status == "FAIL"


def test_reconciliation_and_blank_reasons(spark):
    bronze, silver = spark.range(3), spark.range(2)
    good = spark.createDataFrame([(1, "why")], "id INT, rejection_reason STRING")
    blank = spark.createDataFrame([(1, " ")], "id INT, rejection_reason STRING")
    bare = spark.createDataFrame([(1,)], "id INT")
    name = "quarantine_reconciliation"
    for quarantine, status in ((good, "PASS"), (blank, "FAIL"), (bare, "FAIL")):
        rows = checks.check_layers(bronze, silver, quarantine, CheckSpec("t"))
        assert only(rows, check_name=name).status == status
    rows = checks.check_layers(bronze, spark.range(3), good, CheckSpec("t"))
    assert only(rows, check_name=name).status == "FAIL"


def test_schema_drift_variants():
    drift = checks.schema_drift
    ok = drift(["a", "b"], ["a"], ["a", "b"], ["a"])
    assert "PASS" in str(ok.status)
    assert "FAIL" in str(drift(["a", "b", "c"], ["a"], ["a", "b"], ["a"]).status)
    assert "FAIL" in str(drift(["a"], ["a", "x"], ["a"], ["a"]).status)
    assert "PASS" in str(drift(["a"], ["a", "x"], ["a"], ["a"], flag_extra=False).status)
    assert "FAIL" in str(drift(["a", "B"], ["a"], ["a", "b"], ["a"], flag_extra=False).status)
    # without expectations every dropped column is unexpected
    assert "FAIL" in str(drift(["a", "b"], ["a"]).status)
    assert "PASS" in str(drift(["a"], ["a"]).status)


def test_nulls_uniqueness_and_absent_columns(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), (" ",)], "v STRING")
    rows = checks.evaluate(
        checks.as_silver(df),
        [
            *checks.null_rates(df, {"v": 75.0, "w": 0.0}),
            *checks.uniqueness(df, ["v", "w"]),
            checks.email_format(df, "w"),
            checks.amount_positive(df, "w"),
            checks.allowed_values(df, "w", ["a"]),
            checks.allowed_values(df, "v", ["a"]),
        ],
    )
    found = {r.check_name: r for r in rows.collect()}
    assert found["null_pct_silver_v"].status == "PASS"
    assert "3/4" in found["null_pct_silver_v"].message
    assert found["unique_silver_v"].message == "silver.v: 1 duplicate value(s)"
    assert found["allowed_values_silver_v"].message == "silver.v: 3 value(s) outside [a]"
    for name in ("null_pct_silver_w", "unique_silver_w", "email_format_silver",
                 "amount_positive_silver", "allowed_values_silver_w"):
        assert found[name].status == "FAIL"
        assert found[name].message == "Column 'w' not found in silver"


def test_spec_from_mapping():
    spec = CheckSpec.from_mapping(
        "orders",
        {
            "expected_columns": {"bronze": ["a", "b"], "silver": ["a"]},
            "rules": {
                "max_row_drop_pct": 50,
                "max_null_pct": {"a": 0},
                "unique_columns": ["a"],
                "amount_positive": True,
                "allowed_status": ["x"],
            },
        },
        {"warn_row_drop_pct": 1, "fail_row_drop_pct": 2},
    )
    assert spec == CheckSpec(
        "orders", ("a", "b"), ("a",), {"a": 0.0}, ("a",), None, "amount", {"status": ("x",)},
        50.0, 1.0, 2.0,
    )


def test_skipped_references(spark):
    rows = checks.check_references(spark.range(3), None, "id", "id").collect()
    assert [(r.status, r.message[:7]) for r in rows] == [("PASS", "Skipped")]


def test_status_folding_and_gate(spark):
    def results(*statuses):
        rows = [("r", "t", str(i), s, "m") for i, s in enumerate(statuses)]
        names = ("run_id", "table_name", "check_name", "status", "message")
        schema = ", ".join(f"{n} STRING" for n in names)
        return spark.createDataFrame(rows, schema)

    for statuses, expected in (
        ((), "PASS"), (("PASS",), "PASS"), (("PASS", "WARN"), "WARN"), (("WARN", "FAIL"), "FAIL"),
    ):
        assert column(checks.overall_status(results(*statuses)), "overall_status") == [expected]
    checks.enforce_gate(results("PASS", "WARN"))
    with pytest.raises(checks.QualityGateError, match="t.1: m"):
        checks.enforce_gate(results("PASS", "FAIL"))


def test_check_families(spark):
    names = {
        "null_pct_silver_email": "null_pct",
        "null_pct_stage_batch_id": "null_pct",
        "unique_silver_order_id": "unique",
        "unique_batch_stage": "unique_batch_stage",
        "mseg_quarantine_reconciliation": "quarantine_reconciliation",
        "allowed_values_silver_status": "allowed_values",
        "d2d_target_breach": "d2d_target_breach",
    }
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = {r.n: r.x for r in df.selectExpr("n", report.check_family("n") + " AS x").collect()}
    assert got == names


# -------------------------------------------------------------------- process


MODEL = StageModel(stages=("s1", "s2", "s3"), code_to_stage={}, e2e_target_days=1.0)


def events(spark, *rows):
    data = [
        (b, s, f"p-{s}", f"m-{s}", datetime.fromisoformat(a), datetime.fromisoformat(z), o)
        for b, s, a, z, o in rows
    ]
    schema = (
        "batch_id STRING, stage STRING, plant STRING, material STRING, start_ts TIMESTAMP_NTZ, "
        "end_ts TIMESTAMP_NTZ, stage_order INT"
    )
    return spark.createDataFrame(data, schema).withColumn("line_count", F.lit(1).cast("bigint"))


def test_handoffs_clamp_overlap_and_skip_gaps(spark):
    df = events(
        spark,
        ("overlap", "s1", "2024-01-01", "2024-01-05", 1),
        ("overlap", "s2", "2024-01-03", "2024-01-06", 2),
        ("gap", "s1", "2024-01-01", "2024-01-02", 1),
        ("gap", "s3", "2024-01-04", "2024-01-05", 3),
    )
    rows = process.d2d_lead_times(df).collect()
    assert [(r.batch_id, r.from_stage, r.to_stage, r.d2d_lead_time_days) for r in rows] == [
        ("overlap", "s1", "s2", 0.0)
    ]
    assert (rows[0].material, rows[0].plant) == ("m-s1", "p-s1")


def test_end_to_end_keeps_its_sign(spark):
    df = events(
        spark,
        ("back", "s1", "2024-01-05", "2024-01-06", 1),
        ("back", "s3", "2024-01-01", "2024-01-02", 3),
        ("open", "s1", "2024-01-01", "2024-01-02", 1),
        ("late", "s1", "2024-01-01", "2024-01-02", 1),
        ("late", "s3", "2024-01-02", "2024-01-03", 3),
    )
    e2e = process.e2e_lead_times(df, MODEL)
    got = {r.batch_id: (r.e2e_lead_time_days, r.stages_present) for r in e2e.collect()}
    assert got == {"back": (-3.0, 2), "late": (2.0, 2)}
    rows = checks.check_lead_times(
        df, process.stage_lead_times(df), process.d2d_lead_times(df), e2e, MODEL
    )
    assert only(rows, check_name="non_negative_lead_times").status == "FAIL"
    breach = only(rows, check_name="e2e_target_breach")
    assert (breach.status, breach.metrics_json) == ("WARN", '{"over_target":1}')


def test_target_itself_is_no_breach(spark):
    df = events(
        spark,
        ("b", "s1", "2024-01-01", "2024-01-01", 1),
        ("b", "s3", "2024-01-02", "2024-01-02", 3),
    )
    facts = checks.span_facts(
        process.e2e_lead_times(df, MODEL), "e2e_lead_time_days", "e2e", MODEL.e2e_target_days
    )
    assert checks.evaluate(facts, [checks.e2e_target_breach(MODEL)]).collect()[0].status == "PASS"


def test_event_checks_see_repeats_and_unknown_stages(spark):
    df = events(
        spark,
        ("b", "s1", "2024-01-01", "2024-01-01", 1),
        ("b", "s1", "2024-01-01", "2024-01-01", 1),
        ("b", "zz", "2024-01-01", "2024-01-01", 1),
    ).withColumn("stage", F.when(F.col("stage") != "zz", F.col("stage")).otherwise("zz"))
    unknown = df.unionByName(df.limit(1).withColumn("stage", F.lit(None).cast("string")))
    facts = checks.event_facts(unknown, MODEL)
    rows = checks.evaluate(facts, [checks.allowed_stages(), checks.unique_batch_stage()])
    assert [r.message for r in rows.collect()] == [
        "invalid stage rows: 1", "duplicate batch+stage: 1",
    ]
    nulls = checks.evaluate(facts, checks.stage_null_rates(MODEL, df.columns))
    assert only(nulls, check_name="null_pct_stage_stage").status == "FAIL"


def test_empty_gold(spark):
    df = events(spark, ("b", "s1", "2024-01-01", "2024-01-01", 1)).limit(0)
    stage_days, d2d = process.stage_lead_times(df), process.d2d_lead_times(df)
    e2e = process.e2e_lead_times(df, MODEL)
    kpis = process.kpi_summary(stage_days, d2d, e2e, MODEL).collect()[0]
    assert kpis.avg_e2e_days is None and kpis.d2d_handoffs == 0
    assert kpis.avg_stage_days_by_stage == {}
    rows = checks.check_lead_times(df, stage_days, d2d, e2e, MODEL).collect()
    assert {r.status for r in rows} == {"PASS"} and len(rows) == 9


def test_attributes_take_earliest_value_present(spark):
    df = spark.createDataFrame(
        [("b", "s1", 3, "x", "2024-01-03"), ("b", "s1", 1, None, "2024-01-01"),
         ("b", "s1", 2, "w", "2024-01-02")],
        "batch STRING, stage STRING, qty INT, unit STRING, day STRING",
    ).withColumn("event_ts", F.to_timestamp("day"))
    row = process.stage_events(
        df, MODEL, batch="batch", quantity="qty", attributes={"uom": "unit"},
        order_by=("event_ts", "qty"),
    ).collect()[0]
    assert (row.uom, row.line_count, row.total_quantity, row.stage_order) == ("w", 3, 6.0, 1)


def test_references_of_absent_tables_are_skipped(spark):
    one = spark.range(3)
    for child, parent in ((None, one), (one, None), (None, None)):
        found = only(checks.check_references(child, parent, "id", "id"), table_name="_cross_")
        assert found.status == "PASS" and found.message.startswith("Skipped")
