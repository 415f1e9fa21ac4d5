"""First-seen deduplication that does not gather a key's rows in one task.

A row-number window over the key would send every copy of a hot key to one
task. Both operators here fold the copies on the map side instead: a key with a
third of all rows leaves each map task as one partial row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltgate.sources.staging import Staging

REPEAT = "_repeat"
ARRIVAL = "_arrival"  # what ``land`` numbers rows by; no two rows share one


def first_rows(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], staging: Staging | None = None
) -> DataFrame:
    """One row per key, the one that ``mark_repeats`` leaves unmarked."""
    return mark_repeats(df, key, order_by, staging).filter(~F.col(REPEAT)).drop(REPEAT)


def mark_repeats(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], staging: Staging | None = None
) -> DataFrame:
    """Every row of ``df`` plus ``_repeat``: true unless the row is its key's first.

    1. Keys and order columns alone are scanned once and folded to the first position of
       every key that occurs more than once, and whether several rows have it; unique
       keys drop out here. The key table is stored.
    2. The rows are left-joined to those keys, whose size is known when the join is
       planned: if it is small, the wide rows are neither shuffled nor sorted. Otherwise
       it is a sort-merge join whose hot partitions Spark splits.
    3. Where a key has several rows at its first position, those rows are stored with a
       number, and the least by the remaining columns, then by the number, is the
       first (``_break_ties``).

    So each key, NULL being one like any other, has exactly one unmarked row. ``df`` is
    read twice and must give the same rows each time; tables of a run without
    ``staging`` stay until the driver program ends.

    The join compares keys null-safely. That matches the grouping (NULL is a
    key like any other), and because the join keys then differ from the
    grouping keys, both sides get their own exchange, which is what adaptive
    execution needs before it may split a skewed partition.
    """
    staging = staging or Staging.until_exit(df.sparkSession)
    keys = [f"_key{i}" for i in range(len(key))]
    repeated = staging.table(_repeated_keys(df, key, order_by, keys), "repeated-keys")
    order = _order(df, order_by)
    joined = df.join(repeated.drop("_tied"), _same_key(key, keys), "left").withColumn(
        "_at_first", F.col("_seen_again").isNotNull() & order.eqNullSafe(F.col("_first"))
    )
    repeat = (F.col("_seen_again").isNotNull() & ~F.col("_at_first")).alias(REPEAT)
    tied = repeated.filter("_tied").select(*keys)
    if tied.isEmpty():
        return joined.select(*df.columns, repeat)
    placed = joined.join(_renamed(tied), _same_key(keys, [f"_tied{k}" for k in keys]), "left")
    alone = placed.filter("NOT _at_first OR _is_tied IS NULL").select(*df.columns, repeat)
    return alone.union(_break_ties(placed.filter("_at_first AND _is_tied"), df, key, staging))


def _repeated_keys(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """(keys, _first, _tied, _seen_again) of the keys that occur more than once.

    Rows are counted by key and position first, then a key's least position is taken with
    its count, so one scan tells the ties too. Where positions are unique by
    construction a key folds at once."""
    order = _order(df, order_by)
    slim = df.select(
        *[F.col(k).alias(a) for k, a in zip(key, keys, strict=True)], order.alias("_order")
    )
    if list(order_by) == [ARRIVAL]:
        slim = slim.withColumn("_n", F.lit(1).cast("long"))
    else:
        slim = slim.groupBy(*keys, "_order").agg(F.count(F.lit(1)).alias("_n"))
    # NULL comes first, as in an ordering; a struct is never NULL.
    has_null = F.max(F.col("_order").isNull())
    at_null = F.max(F.when(F.col("_order").isNull(), F.col("_n")))
    folded = slim.groupBy(*keys).agg(
        F.when(~has_null, F.min("_order")).alias("_first"),
        F.when(has_null, at_null).otherwise(F.min_by("_n", "_order")).alias("_alike"),
        F.sum("_n").alias("_copies"),
    )
    return folded.filter("_copies > 1").select(
        *keys, "_first", (F.col("_alike") > 1).alias("_tied"), F.lit(True).alias("_seen_again")
    )


def _break_ties(tied: DataFrame, df: DataFrame, key: Sequence[str], staging: Staging) -> DataFrame:
    """Rows that share their key's first position, all but one a key marked. They are
    numbered and stored, so that even rows alike in all columns can be told apart; the
    least of a key folds on the map side."""
    rows = staging.table(
        tied.select(*df.columns, F.monotonically_increasing_id().alias("_tie")), "tied-rows"
    )
    rest = [_comparable(f) for f in df.schema.fields if f.name not in key]
    firsts = rows.groupBy(*key).agg(F.min(F.struct(*rest, "_tie"))["_tie"].alias("_winner"))
    chosen = rows.join(firsts.select("_winner"), F.col("_tie") == F.col("_winner"), "left")
    return chosen.select(*df.columns, F.col("_winner").isNull().alias(REPEAT))


def _same_key(left: Sequence[str], right: Sequence[str]) -> Column:
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)]
    return reduce(lambda a, b: a & b, pairs)


def _renamed(tied: DataFrame) -> DataFrame:
    return tied.select(*[F.col(k).alias(f"_tied{k}") for k in tied.columns], F.lit(True).alias("_is_tied"))


def _comparable(column: T.StructField) -> Column:
    """The column, or its JSON where Spark has no order for its type."""
    unordered = "map<" in column.dataType.simpleString() or "variant" in column.dataType.simpleString()
    return F.to_json(F.struct(column.name)) if unordered else F.col(column.name)


# Types whose aggregation buffer is updated in place, so that min() can hash.
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _order(df: DataFrame, order_by: Sequence[str]) -> Column:
    """A row's position. Several columns are compared as a struct, whose minimum needs a
    sort; one fixed-width column is aggregated by hashing."""
    if len(order_by) == 1 and isinstance(df.schema[order_by[0]].dataType, _FIXED_WIDTH):
        return F.col(order_by[0])
    return F.struct(*order_by)
