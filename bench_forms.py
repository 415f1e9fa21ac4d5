"""Compares ways to split orders into silver and quarantine, and to check them.

``cascade``  row-number window, then one filter pair per rule, quarantine as a union
``lazy``     one verdict per row, joins planned without knowing the key tables' sizes
``staged``   one verdict per row, exception keys stored first
``once``     the same, judged once for both layers

``each``     one action for each check
``together`` all checks in one aggregate

Usage: ``python bench_forms.py [copies]``. The table is made from the orders of
``BENCH_SF_DIR`` (default sf0.1) by repeating them; in the ``hot`` case one order
key and one customer hold a third of the rows each. Printed are seconds, and per form the
jobs, how often the table's rows were read, and the MB shuffled.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bench import session  # noqa: E402
from siltgate.operators import checks  # noqa: E402
from siltgate.operators.classify import classify, layered, split  # noqa: E402
from siltgate.plans.shop import ALLOWED_STATUS  # noqa: E402
from siltgate.sources.staging import Staging  # noqa: E402
from siltgate_queries import bindings, registry  # noqa: E402


def enlarged(spark: SparkSession, sf_dir: str, copies: int, hot: bool) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    rows = bindings.bronze_orders(spark, sf_dir).withColumn("_copy", copy)
    number = F.col("order_id") * copies + F.col("_copy")
    rows = rows.withColumn("seq", F.col("seq") * 1_000_000_000 + number)
    if hot:
        fk = F.when(F.col("seq") % 3 == 1, F.lit(5)).otherwise(F.col("customer_id"))
        rows = rows.withColumn("customer_id", fk)
        number = F.when(number % 3 == 0, F.lit(-1)).otherwise(number)
    return rows.withColumn("order_id", number).drop("_copy")


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def cascade(bronze: DataFrame, parents: DataFrame) -> None:
    order = Window.partitionBy("order_id").orderBy("seq")
    ranked = bronze.withColumn("_rn", F.row_number().over(order))
    rejected = [ranked.filter("_rn > 1").withColumn("why", F.lit("duplicate"))]
    left = ranked.filter("_rn = 1")
    allowed = ", ".join(f"'{s}'" for s in ALLOWED_STATUS)
    for why, test in (
        ("amount", "amount IS NULL OR amount <= 0"),
        ("status", f"status IS NULL OR status NOT IN ({allowed})"),
        ("blank key", "customer_id IS NULL"),
    ):
        rejected.append(left.filter(test).withColumn("why", F.lit(why)))
        left = left.filter(f"NOT ({test})")
    keys = parents.select("customer_id").distinct()
    orphans = left.join(keys, "customer_id", "left_anti").select(*left.columns)
    rejected.append(orphans.withColumn("why", F.lit("orphan")))
    quarantine = rejected[0]
    for part in rejected[1:]:
        quarantine = quarantine.unionByName(part)
    discard(left.join(keys, "customer_id").select(*bindings.ORDER_SILVER))
    discard(quarantine.drop("_rn"))


def lazy(bronze: DataFrame, parents: DataFrame) -> None:
    for part in split(classify(bronze, registry.ORDERS, parents), registry.ORDERS, registry.CTX):
        discard(part)


def staged(bronze: DataFrame, parents: DataFrame) -> None:
    with Staging(bronze.sparkSession) as staging:
        judged = classify(bronze, registry.ORDERS, parents, staging)
        for part in split(judged, registry.ORDERS, registry.CTX):
            discard(part)


def once(bronze: DataFrame, parents: DataFrame) -> None:
    with Staging(bronze.sparkSession) as staging:
        judged = classify(bronze, registry.ORDERS, parents, staging)
        discard(layered(judged, registry.ORDERS, registry.CTX)[0])


def order_checks(bronze: DataFrame) -> tuple[DataFrame, list[checks.Check]]:
    tagged = checks.as_silver(bronze)
    return tagged, [
        *checks.null_rates(bronze, dict.fromkeys(bindings.ORDER_SILVER, 0.0)),
        checks.amount_positive(bronze),
        checks.allowed_values(bronze, "status", ALLOWED_STATUS),
    ]


def each(bronze: DataFrame, parents: DataFrame) -> None:
    tagged, listed = order_checks(bronze)
    for check in listed:
        discard(checks.evaluate(tagged, [check]))


def together(bronze: DataFrame, parents: DataFrame) -> None:
    discard(checks.evaluate(*order_checks(bronze)))


def counted(spark: SparkSession, name: str, rows: int) -> dict[str, float]:
    """What the jobs of a form did, from Spark's own status store."""
    tracker = spark.sparkContext.statusTracker()
    store = spark._jsparkSession.sparkContext().statusStore()
    jobs = tracker.getJobIdsForGroup(name)
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    seen = [store.lastStageAttempt(s) for s in stages]
    ran = [s for s in seen if s.status().toString() != "SKIPPED"]
    read = sum(s.inputRecords() for s in ran if s.inputRecords() >= rows)
    shuffled = sum(s.shuffleWriteBytes() for s in ran)
    return {"jobs": len(jobs), "scans": round(read / rows, 1), "shuffled_mb": round(shuffled / 1e6, 2)}


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 60
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    forms: dict[str, Callable[[DataFrame, DataFrame], None]] = {
        "cascade": cascade, "lazy": lazy, "staged": staged, "once": once, "each": each, "together": together,
    }
    spark = session()
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    seconds: dict[str, float] = {}
    work: dict[str, dict[str, float]] = {}
    with Staging(spark) as tables:
        parents = tables.table(registry.silver_customers(spark, sf_dir), "parents")
        for case in ("even", "hot"):
            bronze = tables.table(enlarged(spark, sf_dir, copies, case == "hot"), case)
            rows = bronze.count()
            for name, run in forms.items():
                spark.sparkContext.setJobGroup(f"{case}_{name}", name)
                began = time.perf_counter()
                run(bronze, parents)
                seconds[f"{case}_{name}"] = round(time.perf_counter() - began, 1)
                work[f"{case}_{name}"] = counted(spark, f"{case}_{name}", rows)
    spark.stop()
    print(json.dumps({"metric": "forms", "unit": "sec", "copies": copies, "queries": seconds, "work": work}))


if __name__ == "__main__":
    main()
