"""Key membership between tables: semi, anti, and a per-row marker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.contracts import CodeTable
from siltgate.functions import sql
from siltgate.sources.staging import Staging

UNMATCHED = "_unmatched"


def key_set(parent: DataFrame, column: str) -> DataFrame:
    """The distinct non-NULL keys of a parent table, as column ``_parent_key``."""
    return (
        parent.select(F.col(column).alias("_parent_key"))
        .filter(F.col("_parent_key").isNotNull())
        .distinct()
    )


def matched(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    staging: Staging | None = None,
) -> DataFrame:
    """Child rows whose key exists in the parent; rows are never multiplied."""
    if staging is not None:
        marked = mark_unmatched(child, column, parent, parent_column, staging)
        return marked.filter(~F.col(UNMATCHED)).drop(UNMATCHED)
    return child.join(
        key_set(parent, parent_column), F.col(column).eqNullSafe(F.col("_parent_key")), "left_semi"
    )


def unmatched(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    staging: Staging | None = None,
) -> DataFrame:
    """Child rows whose key does not exist in the parent; a NULL key never matches."""
    if staging is not None:
        marked = mark_unmatched(child, column, parent, parent_column, staging)
        return marked.filter(UNMATCHED).drop(UNMATCHED)
    return child.join(
        key_set(parent, parent_column), F.col(column).eqNullSafe(F.col("_parent_key")), "left_anti"
    )


def mark_unmatched(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    staging: Staging | None = None,
) -> DataFrame:
    """Child rows plus ``_unmatched``: true when the key has no partner.

    With ``staging``, the child's partnerless keys are found first on the key
    columns alone and stored; they are few in sound data, and then the wide rows
    meet them in a broadcast join of known size. Without it, the rows are joined
    to the parent's keys directly.

    The null-safe comparison (the right side holds no NULL, so a NULL child key
    finds nothing) gives both join sides their own exchange, so a hot child key
    is split by adaptive execution.
    """
    if staging is None:
        joined = child.join(
            key_set(parent, parent_column), F.col(column).eqNullSafe(F.col("_parent_key")), "left"
        )
        return joined.select(*child.columns, F.col("_parent_key").isNull().alias(UNMATCHED))
    orphans = staging.table(
        key_set(child, column).join(
            parent.select(F.col(parent_column).alias("_known")),
            F.col("_parent_key") == F.col("_known"),
            "left_anti",
        ),
        "orphan-keys",
    )
    joined = child.join(orphans, F.col(column).eqNullSafe(F.col("_parent_key")), "left")
    lacking = F.col(column).isNull() | F.col("_parent_key").isNotNull()
    return joined.select(*child.columns, lacking.alias(UNMATCHED))


def count_unmatched(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row ``(unmatched)``: how many child rows lack a partner.

    Child rows are counted per key before anything is joined, so a key with a
    third of all rows meets the join as a single row.
    """
    per_key = child.groupBy(F.col(column).alias("_child_key")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    orphans = per_key.join(
        parent.select(F.col(parent_column).alias("_parent_key")),
        F.col("_child_key") == F.col("_parent_key"),
        "left_anti",
    )
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("unmatched"))


class RepeatedCodeError(ValueError):
    """Raised where a code table has two rows for a code."""


def with_codes(
    rows: DataFrame, codes: DataFrame, spec: CodeTable, staging: Staging | None = None
) -> DataFrame:
    """Rows plus the values of their codes; NULL where the code table lacks the code.

    Codes are compared as text, as in a literal map; a NULL code has no value. A table
    with several rows for a code, whatever their values, is refused, as rows would be
    multiplied. The table is stored first, so its size is known when the join is
    planned: a small one leaves the rows where they are, beyond the broadcast
    threshold it is a sort-merge join. The null-safe comparison gives both sides an
    exchange of their own, so that adaptive execution can split a hot code.
    """
    staging = staging or Staging.until_exit(rows.sparkSession)
    code = F.col(sql.name(spec.code)).cast("string").alias("_code")
    values = [F.col(sql.name(source)).alias(name) for name, source in spec.values.items()]
    known = staging.table(codes.select(code, *values).filter("_code IS NOT NULL"), "codes")
    repeated = known.groupBy("_code").count().filter("count > 1").orderBy("_code").limit(5).collect()
    if repeated:
        raise RepeatedCodeError(f"codes with several rows: {[r['_code'] for r in repeated]}")
    met = rows.join(known, F.col(sql.name(spec.column)).cast("string").eqNullSafe(F.col("_code")), "left")
    kept = [F.col(sql.name(c)) for c in rows.columns if c not in spec.values]
    return met.select(*kept, *[known[name] for name in spec.values])
