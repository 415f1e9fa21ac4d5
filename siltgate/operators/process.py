"""Timestamped movements folded into ordered stages, and the lead times between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltgate.contracts import StageModel
from siltgate.functions import sql
from siltgate.functions.numbers import clamp_negative, days_between, exact_sum, mean_of_hundredths


def earliest(name: str, order_by: Sequence[str]) -> Column:
    """The column's non-NULL value with the least order; NULL if there is none."""
    return F.min_by(name, F.when(F.col(name).isNotNull(), F.struct(*order_by)))


def stage_events(
    silver: DataFrame,
    model: StageModel,
    *,
    batch: str,
    quantity: str,
    attributes: Mapping[str, str],
    order_by: Sequence[str],
) -> DataFrame:
    """One row per batch and stage: its span, line count, quantity and attributes.

    ``attributes`` maps output names to source columns; each takes its earliest
    non-NULL value. ``order_by`` must be unique within a batch and stage. The quantity
    is an ``exact_sum``. All aggregates combine on the map side, so a hot batch
    shuffles as few rows.
    """
    folded = silver.groupBy(F.col(batch).alias("batch_id"), "stage").agg(
        *[earliest(source, order_by).alias(name) for name, source in attributes.items()],
        F.min("event_ts").alias("start_ts"),
        F.max("event_ts").alias("end_ts"),
        F.count(F.lit(1)).alias("line_count"),
        exact_sum(F.col(quantity)).alias("total_quantity"),
    )
    return folded.withColumn("stage_order", F.expr(sql.map_value(model.stage_order, "stage")))


def stage_lead_times(events: DataFrame) -> DataFrame:
    """Days spent inside each stage."""
    return _timed(events).select(
        "batch_id",
        "material",
        "plant",
        "stage",
        "stage_order",
        "start_ts",
        "end_ts",
        days_between(F.col("start_ts"), F.col("end_ts")).alias("stage_lead_time_days"),
        "line_count",
    )


def d2d_lead_times(events: DataFrame) -> DataFrame:
    """Days waited between neighbouring stages; an overlap counts as no wait.

    A batch has at most one row per stage here, so the window group is bounded
    by the number of stages.
    """
    following = F.lead(F.struct("stage", "stage_order", "start_ts")).over(
        Window.partitionBy("batch_id").orderBy("stage_order")
    )
    handoffs = (
        _timed(events)
        .withColumn("_next", following)
        .filter(F.col("_next.stage_order") == F.col("stage_order") + 1)
    )
    wait = days_between(F.col("end_ts"), F.col("_next.start_ts"))
    return handoffs.select(
        "batch_id",
        "material",
        "plant",
        F.col("stage").alias("from_stage"),
        F.col("_next.stage").alias("to_stage"),
        F.col("end_ts").alias("from_end_ts"),
        F.col("_next.start_ts").alias("to_start_ts"),
        clamp_negative(wait).alias("d2d_lead_time_days"),
    )


def e2e_lead_times(events: DataFrame, model: StageModel) -> DataFrame:
    """Days from the start of the first stage to the end of the last, where both exist.

    One aggregation per batch; the sign is kept, a negative span is a finding.
    """
    at_first = F.col("stage") == model.first
    at_last = F.col("stage") == model.last
    folded = events.groupBy("batch_id").agg(
        F.max(F.when(at_first, F.col("material"))).alias("material"),
        F.max(F.when(at_first, F.col("plant"))).alias("plant"),
        F.max(F.when(at_first, F.col("start_ts"))).alias("lifecycle_start"),
        F.max(F.when(at_last, F.col("end_ts"))).alias("lifecycle_end"),
        F.count_if(at_first).alias("_firsts"),
        F.count_if(at_last).alias("_lasts"),
        _distinct("stage").alias("stages_present"),
    )
    return folded.filter((F.col("_firsts") > 0) & (F.col("_lasts") > 0)).select(
        "batch_id",
        "material",
        "plant",
        "lifecycle_start",
        "lifecycle_end",
        days_between(F.col("lifecycle_start"), F.col("lifecycle_end")).alias(
            "e2e_lead_time_days"
        ),
        "stages_present",
    )


def _distinct(column: str) -> Column:
    """How many values a group has; for few, as the model's stages are. Unlike a distinct
    count it shares the group's one exchange with other aggregates."""
    return F.size(F.collect_set(column)).cast("long")


def stages_present(events: DataFrame) -> DataFrame:
    """Distinct stages per batch; NULL is not a stage."""
    return events.groupBy("batch_id").agg(_distinct("stage").alias("stages_present"))


def slowest_handoffs(d2d: DataFrame, limit: int = 20) -> DataFrame:
    """The longest waits, ties broken by batch and stage."""
    return d2d.orderBy(F.desc("d2d_lead_time_days"), "batch_id", "from_stage").limit(limit)


def mean_stage_days(stage_times: DataFrame) -> DataFrame:
    """Average of the (already rounded) days per stage."""
    return stage_times.groupBy("stage").agg(
        mean_of_hundredths(F.col("stage_lead_time_days")).alias("avg_days")
    )


def kpi_summary(
    stage_times: DataFrame, d2d: DataFrame, e2e: DataFrame, model: StageModel
) -> DataFrame:
    """One row of KPIs: the averages, the counts, and a map of stage to average days.

    The three gold tables are reduced on their own and their few result rows
    are folded together, without a join.
    """
    empty = F.lit(None)
    per_stage = mean_stage_days(stage_times).select(
        F.lit("stage").alias("kind"),
        "stage",
        F.col("avg_days").alias("days"),
        empty.cast("bigint").alias("n"),
    )

    def whole(frame: DataFrame, kind: str, column: str) -> DataFrame:
        return frame.agg(
            mean_of_hundredths(F.col(column)).alias("days"), F.count(F.lit(1)).alias("n")
        ).select(F.lit(kind).alias("kind"), empty.cast("string").alias("stage"), "days", "n")

    facts = per_stage.unionByName(whole(d2d, "d2d", "d2d_lead_time_days")).unionByName(
        whole(e2e, "e2e", "e2e_lead_time_days")
    )
    kind = F.col("kind")
    stage_days = F.collect_list(F.when(kind == "stage", F.struct("stage", "days")))
    return facts.agg(
        F.max(F.when(kind == "e2e", F.col("days"))).alias("avg_e2e_days"),
        F.max(F.when(kind == "d2d", F.col("days"))).alias("avg_d2d_days"),
        F.map_from_entries(F.array_sort(stage_days)).alias("avg_stage_days_by_stage"),
        F.max(F.when(kind == "e2e", F.col("n"))).alias("batches_with_e2e"),
        F.max(F.when(kind == "d2d", F.col("n"))).alias("d2d_handoffs"),
    ).withColumn("stage_count_expected", F.lit(len(model.stages)))


def _timed(events: DataFrame) -> DataFrame:
    return events.filter(F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
