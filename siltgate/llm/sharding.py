"""Karmarkar-Karp sharding: indivisible groups of rows into shards of near equal bytes."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.llm.common import parts_for
from siltgate.sources.staging import Staging


def difference(loads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp differencing of partial partitions.

    ``loads`` has one row per partial partition and one column per shard. The two
    partitions of the largest spread are repeatedly combined, the fullest shard of one
    with the emptiest of the other, until one is left. Returns, for every input row,
    the shard that each of its columns ends in, and the loads of those shards. Ties are
    taken in row order, so the result depends on the input alone.
    """
    rows, shards = loads.shape
    made: list[tuple[int, int, np.ndarray]] = []  # of each combination: its two parts, turned how
    heap = []
    for i, row in enumerate(loads):
        order = np.argsort(row, kind="stable")
        made.append((-1, -1, order))
        values = [int(row[k]) for k in order]
        heap.append((values[0] - values[-1], i, values))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, left = heapq.heappop(heap)
        _, j, right = heapq.heappop(heap)
        joined = [x + y for x, y in zip(left, reversed(right), strict=True)]
        order = sorted(range(shards), key=joined.__getitem__)
        values = [joined[k] for k in order]
        made.append((i, j, np.array(order)))
        heapq.heappush(heap, (values[0] - values[-1], len(made) - 1, values))
    # From the last combination down: where each sorted place of a part ends.
    where: list[np.ndarray | None] = [None] * len(made)
    where[-1] = np.arange(shards)
    ends = np.empty((rows, shards), dtype=np.int32)
    for k in range(len(made) - 1, -1, -1):
        i, j, order = made[k]
        unsorted = np.empty(shards, dtype=np.int64)
        unsorted[order] = where[k]  # place before sorting -> shard
        where[k] = None
        if i < 0:
            ends[k] = unsorted
        else:
            where[i], where[j] = unsorted, unsorted[::-1]
    final = np.zeros(shards, dtype=np.int64)
    for row, end in zip(loads, ends, strict=True):
        final[end] += row.astype(np.int64)
    return ends, final


def shard_groups(
    groups: DataFrame, shards: int, staging: Staging, groups_each: int = 50_000, fan_in: int = 512
) -> DataFrame:
    """Shards for ``groups`` (group, bytes; one row per group): (group, shard).

    Differencing keeps a heap, so it runs in levels that all have a bounded size.
    Groups are hashed into parts of about ``groups_each``, and every part is
    differenced into a partial partition of its own. Those partitions are in turn
    the items of the next level, ``fan_in`` at a time, until one is left. What level n
    says about a part turns the shards that level n-1 gave to the part's groups.
    """
    parts = parts_for(groups.count(), groups_each)
    part = F.pmod(F.xxhash64("group"), F.lit(parts)).cast("long")

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("group", ignore_index=True)
        loads = np.zeros((len(rows), shards), dtype=np.int64)
        loads[:, 0] = rows["bytes"]
        ends, final = difference(loads)
        out = rows[["part", "group"]].assign(shard=ends[:, 0], loads=None)
        total = pd.DataFrame({"part": rows["part"][:1], "group": None, "shard": None})
        total["loads"] = [final.tolist()]
        return pd.concat([out, total], ignore_index=True)

    schema = f"part long, group {groups.schema['group'].dataType.simpleString()}, shard int, loads array<long>"
    leaves = staging.table(
        groups.select(part.alias("part"), "group", "bytes")
        .groupBy("part")
        .applyInPandas(first, schema),
        "shard-leaves",
    )
    placed = leaves.filter("loads IS NULL").select("part", "group", "shard")
    items = leaves.filter("loads IS NOT NULL").select("part", "loads")
    while parts > 1:

        def combine(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("part", ignore_index=True)
            ends, final = difference(np.array(rows["loads"].tolist(), dtype=np.int64))
            out = rows[["upper", "part"]].assign(turn=ends.tolist(), loads=None)
            total = pd.DataFrame({"upper": rows["upper"][:1], "part": None, "turn": None})
            total["loads"] = [final.tolist()]
            return pd.concat([out, total], ignore_index=True)

        level = staging.table(
            items.withColumn("upper", F.floor(F.col("part") / fan_in))
            .groupBy("upper")
            .applyInPandas(combine, "upper long, part long, turn array<int>, loads array<long>"),
            "shard-level",
        )
        turns = level.filter("loads IS NULL").select("upper", "part", "turn")
        placed = placed.join(turns, "part").select(
            F.col("upper").alias("part"), "group", F.expr("turn[shard]").alias("shard")
        )
        items = level.filter("loads IS NOT NULL").select(F.col("upper").alias("part"), "loads")
        parts = parts_for(parts, fan_in)
    return placed.select("group", "shard")


def shard_documents(
    docs: DataFrame,
    shards: int,
    staging: Staging,
    text: str = "text",
    key: str = "doc_id",
    slots_each: int = 50_000,
) -> DataFrame:
    """Rows of ``docs`` as (key, size, text_crc32, shard, slot).

    A row's size is its text's UTF-8 bytes plus one; rows with equal texts are one
    group and share a shard. A NULL text is a group of its own, apart from the empty
    text, with size 1 and the checksum of no bytes. Repeated rows each get a slot.
    Other columns are ignored, and an empty table gives no rows. Slots count from 0 in
    each shard: rows are hashed into chunks, numbered there, and moved on by the
    number of rows in the chunks before. Rows alike in key and text are counted, numbered
    as one, and told apart at the end.
    """
    slim = staging.table(
        docs.select(
            F.col(key).alias("_key"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("group"),
        ),
        "shard-rows",
    )
    groups = staging.table(slim.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = shard_groups(groups, shards, staging)
    # Rows alike in key and text are one row with a count until they have their slots.
    folded = slim.groupBy("_key", "size", "text_crc32", "group").agg(F.count(F.lit(1)).alias("_copies"))
    folded = staging.table(folded, "shard-folded")
    chunks = parts_for(folded.count(), slots_each)
    rows = staging.table(
        folded.join(placed, "group").withColumn(
            "_chunk", F.pmod(F.xxhash64("_key", "group"), F.lit(chunks))
        ),
        "shard-placed",
    )
    counts = rows.groupBy("shard", "_chunk").agg(F.sum("_copies").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("shard", "_chunk").orderBy("_key", "group")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("_copies").over(earlier), F.lit(0))
    slotted = rows.join(starts, ["shard", "_chunk"]).withColumn("_first", first)
    # Copies are told apart in runs, so that no task makes all copies of a row.
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / slots_each)))
    runs = slotted.withColumn("_run", run)
    many = runs.filter(F.col("_copies") > slots_each).repartition("_first", "_run")
    begin = F.col("_run") * slots_each
    last = F.least(begin + slots_each, F.col("_copies")) - 1
    return (
        runs.filter(F.col("_copies") <= slots_each)
        .union(many)
        .withColumn("_n", F.explode(F.sequence(begin, last)))
        .select(
            F.col("_key").alias(key), "size", "text_crc32", "shard", (F.col("_first") + F.col("_n")).alias("slot")
        )
    )
