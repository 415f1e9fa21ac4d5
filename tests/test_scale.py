"""Hot keys, partition independence, and the shape of the plans."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from siltgate.contracts import CodeTable, Intake, Lookup, Rule
from siltgate.functions.numbers import exact_sum
from siltgate.functions.predicates import not_positive
from siltgate.operators import checks, dedup, lookups
from siltgate.operators.classify import REASON, classify
from siltgate.sources import readers, writers
from siltgate.sources.staging import Staging
from siltgate_queries.registry import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
HOT_INTAKE = Intake(
    name="hot",
    key=("k",),
    order_by=("o",),
    duplicate_reason="repeat",
    rules=(Rule("bad", not_positive("v")),),
    lookup=Lookup("fk", "p", "orphan"),
    bronze_columns=("k", "o", "fk", "v"),
    silver_columns=("k", "v"),
)


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 rows; one key, and one parent, hold a third each; some keys are NULL."""
    i = F.col("id")
    return spark.range(60000).select(
        F.when(i % 3 == 0, F.lit(-1)).when(i % 101 == 0, F.lit(None)).otherwise(i).alias("k"),
        ((i * 7919) % 60000).alias("o"),
        F.when(i % 3 == 1, F.lit(5)).when(i % 97 == 0, F.lit(None)).otherwise(i % 1000).alias("fk"),
        (i % 11).cast("double").alias("v"),
    )


@pytest.fixture(scope="module")
def parents(spark):
    return spark.range(0, 1000, 2).withColumnRenamed("id", "p").union(
        spark.createDataFrame([(5,)], "p BIGINT")
    )


def expected(hot, parents):
    """The same verdicts by plain Python, row by row."""
    rows, known = hot.collect(), {r.p for r in parents.collect()}
    first: dict = {}
    for r in rows:
        first[r.k] = min(first.get(r.k, r.o), r.o)
    out = []
    for r in rows:
        reason = None
        if r.o != first[r.k]:
            reason = "repeat"
        elif r.v <= 0:
            reason = "bad"
        elif r.fk not in known:
            reason = "orphan"
        out.append((r.k, r.o, r.fk, r.v, reason))
    return Counter(out)


def verdicts(df):
    return Counter((r.k, r.o, r.fk, r.v, r[REASON]) for r in df.collect())


def test_hot_key_verdicts_match_brute_force(spark, hot, parents):
    wanted = expected(hot, parents)
    assert verdicts(classify(hot, HOT_INTAKE, parents)) == wanted
    with Staging(spark) as staging:
        assert verdicts(classify(hot, HOT_INTAKE, parents, staging)) == wanted


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_verdicts_do_not_depend_on_partitioning(hot, parents, partitions):
    assert verdicts(classify(hot.repartition(partitions), HOT_INTAKE, parents)) == verdicts(
        classify(hot, HOT_INTAKE, parents)
    )


def test_split_without_broadcast(spark, hot, parents):
    """With small limits the sort-merge joins run, and their hot partitions are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        source = hot.repartition(16)
        marked = dedup.mark_repeats(source, ["k"], ["o"])
        assert marked.filter("_repeat").count() == 60000 - hot.select("k").distinct().count()
        marked.collect()
        assert "SortMergeJoin(skew=true)" in formatted(marked)
        joined = lookups.mark_unmatched(source, "fk", parents, "p")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in formatted(joined)
        assert verdicts(classify(source, HOT_INTAKE, parents)) == expected(hot, parents)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_rows_of_unique_keys_cross_no_exchange(spark, hot):
    few = hot.filter("k > 0").unionByName(hot.filter("k > 0 AND k < 40").withColumn("o", F.lit(-1)))
    with Staging(spark) as staging:
        first = dedup.first_rows(few, ["k"], ["o"], staging)
        assert "Exchange hashpartitioning" not in formatted(first)
        assert first.count() == first.select("k").distinct().count()
        assert first.filter("k < 40 AND o >= 0").isEmpty()


@pytest.mark.parametrize("partitions", [1, 7])
def test_hot_ties_leave_one_row(spark, partitions):
    """A third of the rows are one row repeated, a third one key at one position."""
    i = F.col("id")
    rows = spark.range(6000).select(
        F.when(i % 3 == 0, -1).when(i % 3 == 1, -2).otherwise(i).alias("k"),
        F.lit(1).alias("o"),
        F.when(i % 3 == 0, 0).otherwise(i).alias("v"),
    )
    with Staging(spark) as staging:
        marked = dedup.mark_repeats(rows.repartition(partitions), ["k"], ["o"], staging)
        assert marked.count() == 6000
        kept = marked.filter("NOT _repeat")
        assert kept.count() == kept.select("k").distinct().count() == 2002
        assert kept.filter("k = -2").first().v == 1


def test_distinct_counts_are_taken_apart(spark):
    df = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    columns = ["c_custkey", "c_name"]
    plan = formatted(checks.evaluate(checks.as_silver(df), checks.uniqueness(df, columns)))
    assert "Expand" not in plan and plan.count("FileScan parquet") == 1
    found = {r.check_name: r.metrics_json for r in checks.evaluate(checks.as_silver(df), checks.uniqueness(df, columns)).collect()}
    assert len(found) == 2 and plan.count("Exchange hashpartitioning") == 1


def test_count_unmatched_folds_before_joining(hot, parents):
    plan = formatted(lookups.count_unmatched(hot, "fk", parents, "p"))
    join = plan.index("LeftAnti")
    assert plan.index("partial_count(1)") > join
    counted = lookups.count_unmatched(hot, "fk", parents, "p").collect()[0].unmatched
    known = {r.p for r in parents.collect()}
    assert counted == sum(r.fk not in known for r in hot.select("fk").collect())


def test_staging_decides_the_join_by_size(spark, hot):
    stored = hot.filter("k IS NOT NULL AND k > 0").unionByName(hot.filter("k < 0").limit(40))
    with Staging(spark) as staging:
        marked = dedup.mark_repeats(stored, ["k"], ["o"], staging)
        assert "BroadcastHashJoin" in formatted(marked)
        assert "SortMergeJoin" not in formatted(marked)
        wide_rows_moved = "Exchange hashpartitioning(coalesce(k" in formatted(marked)
        assert not wide_rows_moved
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
            assert "SortMergeJoin" in formatted(dedup.mark_repeats(stored, ["k"], ["o"], staging))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_one_scan_feeds_all_row_checks(spark):
    df = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    rows = checks.evaluate(
        checks.as_silver(df),
        [
            *checks.null_rates(df, {"c_name": 0.0, "c_acctbal": 0.0}),
            checks.amount_positive(df, "c_acctbal"),
            checks.allowed_values(df, "c_mktsegment", ["BUILDING"]),
        ],
    )
    plan = formatted(rows)
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<c_name:string,c_acctbal:double,c_mktsegment:string>" in plan


PLANNED = [
    "silver_orders", "quarantine_orders", "quarantine_movements", "orphan_orders_anti",
    "valid_orders_semi", "code_to_stage_table", "d2d_lead_times", "e2e_lead_times", "check_uniqueness",
    "check_referential_integrity", "dq_results_table",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_on_the_jvm_without_cross_joins(spark, name):
    plan = formatted(REGISTRY[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobin"):
        assert unwanted not in plan
    assert "FileScan parquet" in plan


def test_verdicts_move_no_wide_rows_when_exceptions_are_few(spark):
    """Neither the repeats nor the orphans make the order rows cross an exchange."""
    plan = formatted(REGISTRY["silver_orders"](spark, SF_DIR))
    assert plan.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in plan


def test_long_texts_are_shuffled_as_digests(spark):
    plan = formatted(REGISTRY["check_uniqueness"](spark, SF_DIR))
    # The digest is made where rows become pairs; what crosses the exchange is a pair.
    made = [line for line in plan.splitlines() if "sha2(cast(text#" in line]
    assert made and all("inline(" in line for line in made)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("text#" in line for line in exchanges)
    assert all("_value#" in line for line in exchanges if "_no#" in line)


def formatted(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_code_tables_join_by_size_and_split_hot_codes(spark, threshold):
    """A third of the rows have one code, a third none."""
    i = F.col("id")
    rows = spark.range(30000).select("id", F.when(i % 3 == 0, 7).when(i % 3 == 1, i % 500).alias("code"))
    codes = spark.range(400).select(F.col("id").cast("string").alias("c"), (F.col("id") * 2).alias("v"))
    spec = CodeTable("code", "c", {"value": "v"})
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        with Staging(spark) as staging:
            met = lookups.with_codes(rows.repartition(9), codes, spec, staging)
            found = met.agg(F.count("*"), F.count("value"), F.sum("value")).first()
            met.collect()
            assert ("BroadcastHashJoin" in formatted(met)) == (threshold != "-1")
            assert threshold != "-1" or "SortMergeJoin(skew=true)" in formatted(met)
            with pytest.raises(lookups.RepeatedCodeError, match="'7'"):
                lookups.with_codes(rows, codes.union(codes.filter("c = '7'")), spec, staging)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    known = [7 if n % 3 == 0 else n % 500 for n in range(30000) if n % 3 != 2]
    known = [c for c in known if c < 400]
    assert tuple(found) == (30000, len(known), 2 * sum(known))


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_quantities_sum_alike_however_rows_are_dealt(spark, partitions):
    i = F.col("id")
    value = F.when(i % 4 == 0, 0.1).when(i % 4 == 1, 1e15 + 0.3).when(i % 4 == 2, -1e15).otherwise(i / 7)
    rows = spark.range(4000).select((i % 2).alias("g"), value.alias("v"), F.xxhash64("id").alias("h"))
    total = rows.repartition(partitions, "h").groupBy("g").agg(exact_sum(F.col("v")).alias("s"))
    exact = {0: Decimal(0), 1: Decimal(0)}
    for n in range(4000):
        v = [0.1, 1e15 + 0.3, -1e15, n / 7][n % 4]
        exact[n % 2] += Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
    assert {r.g: r.s for r in total.collect()} == {g: float(s) for g, s in exact.items()}


def test_quantities_that_are_no_numbers(spark):
    texts = [("a", "1.5"), ("a", "x"), ("a", None), ("a", "NaN"), ("a", "Infinity"), ("a", "2"),
             ("b", "none"), ("c", "1e30"), ("c", "1"), ("d", "-9e21")]
    rows = spark.createDataFrame(texts, "g string, v string").groupBy("g").agg(exact_sum(F.col("v")).alias("s"))
    assert {r.g: r.s for r in rows.collect()} == {"a": 3.5, "b": None, "c": None, "d": -9e21}


def test_texts_with_breaks_stay_rows_in_split_files(spark, tmp_path):
    texts = ["a\nb", 'say "x", \\ and\r\n%0A %25', "\\", '"', "", None, " lead\n", "end\\\n", 'a\\"b,c"', "%", "ä\u2028b"]
    rows = [(n, t) for n, t in enumerate(texts * 40)]
    df = spark.createDataFrame(rows, "n INT, t STRING").coalesce(1)
    where = str(tmp_path / "csv")
    writers.write_csv(df, where, escaped=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
        back = readers.read_csv(spark, where, "n INT, t STRING", escaped=True)
        assert back.rdd.getNumPartitions() > 5
        assert sorted(map(tuple, back.collect())) == [(n, t or None) for n, t in rows]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_distinct_values_of_every_type(spark):
    columns = "s string, b binary, d double, m decimal(20,2), t timestamp, a array<int>, x boolean"
    t = datetime(2024, 10, 27, tzinfo=timezone.utc)
    rows = [
        ("a", b"a", 0.0, Decimal(1), t, [1], True), ("A", b"b", -0.0, Decimal(1), t, [1, None], True),
        (None, None, None, None, None, None, None), (None, b"", float("nan"), Decimal(2), t, [], False),
    ]
    df = spark.createDataFrame(rows, columns)
    results = checks.evaluate(checks.as_silver(df), checks.uniqueness(df, df.columns))
    counted = {r.check_name: json.loads(r.metrics_json)["distinct"] for r in results.collect()}
    assert list(counted.values()) == [3, 4, 3, 3, 2, 4, 3]
