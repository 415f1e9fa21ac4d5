"""Judge every bronze row once; silver and quarantine are two views of the verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.context import RunContext
from siltgate.contracts import Intake
from siltgate.functions import sql
from siltgate.operators.dedup import REPEAT, mark_repeats
from siltgate.operators.lookups import UNMATCHED, mark_unmatched, with_codes
from siltgate.sources.staging import Staging

REASON = "_reason"
SILVER, QUARANTINE = "silver", "quarantine"


def classify(
    bronze: DataFrame,
    intake: Intake,
    parent: DataFrame | None = None,
    staging: Staging | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Bronze rows plus derived columns and ``_reason`` (NULL means accepted).

    The first failing test wins: repeated key, then the rules in their order,
    then the lookup. One row gets one reason, no row is lost: a rule that
    cannot be decided counts as failed.
    """
    rows = mark_repeats(bronze, intake.key, intake.order_by, staging)
    if intake.codes is not None:
        if codes is None:
            raise ValueError(f"{intake.name}: a code table is needed for its codes")
        rows = with_codes(rows, codes, intake.codes, staging)
    for name, value in intake.derived:
        expression = value if isinstance(value, str) else value(bronze.schema)
        rows = rows.withColumn(name, F.expr(expression))
    if intake.lookup is not None:
        if parent is None:
            raise ValueError(f"{intake.name}: a parent table is needed for its lookup")
        lookup = intake.lookup
        rows = mark_unmatched(rows, lookup.column, parent, lookup.parent_column, staging)
    kept = [F.col(c) for c in rows.columns if c not in (REPEAT, UNMATCHED)]
    return rows.select(*kept, F.expr(first_failure(intake)).alias(REASON))


def first_failure(intake: Intake) -> str:
    tests = [(REPEAT, intake.duplicate_reason)]
    tests += [(f"coalesce({rule.bad}, true)", rule.reason) for rule in intake.rules]
    if intake.lookup is not None:
        tests.append((UNMATCHED, intake.lookup.reason))
    branches = [f"WHEN {test} THEN {sql.text(reason)}" for test, reason in tests]
    return f"CASE {' '.join(branches)} END"


def silver_view(classified: DataFrame, intake: Intake) -> DataFrame:
    """Accepted rows in contract order, with default values filled in."""
    return classified.filter(F.col(REASON).isNull()).select(*silver_projection(intake))


def silver_projection(intake: Intake) -> list[Column]:
    return [
        F.expr(intake.fills[name]).alias(name) if name in intake.fills else F.col(name)
        for name in intake.silver_columns
    ]


def quarantine_view(classified: DataFrame, intake: Intake, ctx: RunContext) -> DataFrame:
    """Rejected rows as they arrived, with the reason and the time of the run."""
    return classified.filter(F.col(REASON).isNotNull()).select(
        *intake.bronze_columns,
        F.col(REASON).alias("rejection_reason"),
        F.lit(ctx.iso_now).alias("rejected_at"),
    )


def split(
    classified: DataFrame, intake: Intake, ctx: RunContext
) -> tuple[DataFrame, DataFrame]:
    return silver_view(classified, intake), quarantine_view(classified, intake, ctx)


def layered(
    classified: DataFrame, intake: Intake, ctx: RunContext
) -> tuple[DataFrame, dict[str, T.StructType]] | None:
    """Silver and quarantine as one table: every row under the columns of both, NULL
    where its layer has none, and ``_layer``. With it the columns of each layer. None if
    the layers hold a column of one name under two types."""
    views = dict(zip((SILVER, QUARANTINE), split(classified, intake, ctx), strict=True))
    schemas = {layer: view.schema for layer, view in views.items()}
    kinds: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema.fields:
            if kinds.setdefault(f.name, f.dataType) != f.dataType:
                return None
    accepted = F.col(REASON).isNull()
    rejected = {"rejection_reason": F.col(REASON), "rejected_at": F.lit(ctx.iso_now)}

    def value(name: str) -> Column:
        as_silver = F.expr(intake.fills[name]) if name in intake.fills else F.col(name)
        if name not in schemas[QUARANTINE].names:
            return F.when(accepted, as_silver)
        as_rejected = rejected[name] if name in rejected else F.col(name)
        if name not in schemas[SILVER].names:
            return F.when(~accepted, as_rejected)
        return F.when(accepted, as_silver).otherwise(as_rejected) if name in intake.fills else F.col(name)

    layer = F.when(accepted, SILVER).otherwise(QUARANTINE)
    return classified.select(*[value(c).alias(c) for c in kinds], layer.alias("_layer")), schemas


def layer_summary(classified: DataFrame, table: str) -> DataFrame:
    """One row: bronze, silver and quarantine counts of a table, in one pass."""
    return classified.agg(
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(F.col(REASON).isNull()).alias("silver"),
        F.count_if(F.col(REASON).isNotNull()).alias("quarantine"),
    ).select(F.lit(table).alias("table_name"), "bronze", "silver", "quarantine")


def summary_of_layers(
    bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, table: str
) -> DataFrame:
    """The same row from stored layers; the counts come from file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(layer))
        for layer, df in (("bronze", bronze), ("silver", silver), ("quarantine", quarantine))
    ]
    merged = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return merged.agg(
        *[
            F.max(F.when(F.col("layer") == x, F.col("n"))).alias(x)
            for x in ("bronze", "silver", "quarantine")
        ]
    ).select(F.lit(table).alias("table_name"), "bronze", "silver", "quarantine")


def reason_histogram(quarantine: DataFrame, *by: str) -> DataFrame:
    """Rejected rows per reason (and per ``by`` columns), most frequent first."""
    return (
        quarantine.groupBy(*by, "rejection_reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *by, "rejection_reason")
    )


def union_quarantines(parts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Several quarantines under one schema; columns a table lacks are NULL."""
    frames = [
        part.withColumn("table_name", F.lit(name)) for name, part in parts.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.select("table_name", *columns, "rejection_reason", "rejected_at")
