"""The given tables read as bronze tables.

The tables are clean, so defects are derived from the source key by plain
arithmetic, the same in Spark and in SQL. Every view is one scan of its source:
repeated copies come out of an ``explode``, not out of a union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.contracts import StageModel
from siltgate.plans.goods import MovementColumns

EVENT_STAGES = StageModel(
    stages=("signup", "view", "click", "purchase"),
    code_to_stage={e: e for e in ("signup", "view", "click", "purchase")},
    e2e_target_days=0.5,
    d2d_target_days=0.25,
)

EVENT_COLUMNS = MovementColumns(
    key=("doc_id", "doc_year", "doc_line"),
    material="material",
    plant="plant",
    batch="batch_id",
    code="code",
    quantity="qty",
    unit="unit",
    entry_time="entry_ts",
    posting_date="posting_date",
    vendor="vendor",
    customer="customer",
    duplicate_reason="duplicate_movement_key",
    missing_reason="missing_required_field",
    unmapped_reason="unmapped_code",
    quantity_reason="invalid_quantity",
    time_reason="invalid_timestamp",
)

CUSTOMER_BRONZE = (
    "customer_id", "name", "email", "country", "signup_seq", "raw_source", "seq",
)
CUSTOMER_SILVER = ("customer_id", "name", "email", "country", "signup_seq")
ORDER_BRONZE = (
    "order_id", "customer_id", "order_date", "amount", "currency", "status", "ingested_at", "seq",
)
ORDER_SILVER = ("order_id", "customer_id", "order_date", "amount", "currency", "status")
MOVEMENT_BRONZE = (
    "doc_id", "doc_year", "doc_line", "material", "plant", "batch_id", "code", "qty", "unit",
    "entry_ts", "posting_date", "vendor", "customer", "seq",
)
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(key: Column, step: int) -> Column:
    return key % step == 0


def copies(key: Column, step: int) -> Column:
    """0 for each row, and a second row numbered 1 for every ``step``-th key."""
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return F.explode(F.when(every(key, step), twice).otherwise(once)).alias("seq")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rows.select(
        k.alias("customer_id"),
        F.when(every(k, 41), F.lit(None))
        .when(every(k, 43), F.lit("  "))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.when(every(k, 29), F.lit(None))
        .when(every(k, 31), F.lit("not-an-email"))
        .otherwise(F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")))
        .alias("email"),
        F.when(every(k, 23), F.lit("")).otherwise(F.col("n_name")).alias("country"),
        (k % 1000).alias("signup_seq"),
        F.when(every(k, 2), F.lit("crm")).otherwise(F.lit("web")).alias("raw_source"),
        copies(k, 37),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    state = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        k.alias("order_id"),
        F.when(every(k, 61), F.lit(None))
        .when(every(k, 67), F.col("o_custkey") + F.lit(1_000_000_000))
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.when(every(k, 47), F.lit(None))
        .when(every(k, 59), -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        F.when(every(k, 3), F.lit("USD")).otherwise(F.lit("EUR")).alias("currency"),
        F.when(every(k, 53), F.lit("UNKNOWN"))
        .when(state == "F", F.lit("paid"))
        .when(state == "O", F.lit("pending"))
        .otherwise(F.lit("shipped"))
        .alias("status"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
        copies(k, 71),
    )


def bronze_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    day = F.datediff(ts.cast("date"), F.lit("2024-01-01").cast("date"))
    return table(spark, sf_dir, "events").select(
        k.alias("doc_id"),
        F.year(ts).alias("doc_year"),
        F.lit(1).alias("doc_line"),
        F.concat(F.lit("M"), (user % 20).cast("string")).alias("material"),
        F.concat(F.lit("P"), (user % 4).cast("string")).alias("plant"),
        F.when(~every(k, 89), (user * 100 + day).cast("string")).alias("batch_id"),
        F.col("event_type").alias("code"),
        F.when(every(k, 83), -F.col("value")).otherwise(F.col("value")).alias("qty"),
        F.when(every(k, 3), F.lit(None))
        .when(every(k, 2), F.lit("KG"))
        .otherwise(F.lit("EA"))
        .alias("unit"),
        F.when(~(every(k, 73) | every(k, 79)), ts).alias("entry_ts"),
        F.when(~every(k, 79), ts.cast("date")).alias("posting_date"),
        F.when(
            F.col("event_type") == "signup", F.concat(F.lit("V"), (user % 10).cast("string"))
        ).alias("vendor"),
        F.when(
            F.col("event_type") == "purchase", F.concat(F.lit("C"), user.cast("string"))
        ).alias("customer"),
        copies(k, 97),
    )
