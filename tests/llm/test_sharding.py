from __future__ import annotations

import zlib
from collections import defaultdict

import cases
import numpy as np

from siltgate.llm import sharding

SF = "/root/testdata/sf0.01"


def test_differencing_by_hand():
    loads = np.zeros((5, 2), dtype=np.int64)
    loads[:, 0] = [8, 7, 6, 5, 4]
    ends, final = sharding.difference(loads)
    # 8-7, 6-5, then 4-1, then 3-1: the classic run ends in a difference of 2.
    assert abs(int(final[0] - final[1])) == 2
    sums = np.zeros(2, dtype=np.int64)
    for load, end in zip(loads[:, 0], ends[:, 0], strict=True):
        sums[end] += load
    assert sums.tolist() == final.tolist()


def check(rows, docs, shards):
    """Placement laws that hold for any table."""
    assert sorted(map(cases.key, [(r.doc_id, r.size, r.text_crc32) for r in rows])) == sorted(
        cases.key((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode()))) for d in docs
    )
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_awkward_rows(spark, staging):
    rows = sharding.shard_documents(cases.awkward(spark, True), 4, staging, slots_each=3).collect()
    check(rows, cases.AWKWARD, 4)
    by_text = {(r.doc_id, r.size): r.shard for r in rows}
    assert by_text[(1, 66)] == by_text[(2, 66)]
    assert sharding.shard_documents(cases.empty(spark), 4, staging).count() == 0


def test_levels_balance(spark, staging):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard_documents(docs, 8, staging).collect()
    check(rows, [(d.doc_id, d.text) for d in docs.collect()], 8)
    text_of = {d.doc_id: d.text for d in docs.collect()}
    homes = defaultdict(set)
    loads = defaultdict(int)
    for r in rows:
        homes[text_of[r.doc_id]].add(r.shard)
        loads[r.shard] += r.size
    assert all(len(h) == 1 for h in homes.values())
    assert max(loads.values()) - min(loads.values()) < 20
    # The same law through several levels of small parts.
    groups = docs.selectExpr("text AS `group`", "octet_length(text) AS bytes").dropDuplicates(["group"])
    placed = sharding.shard_groups(groups, 8, staging, groups_each=40, fan_in=3)
    totals = [r.t for r in placed.join(groups, "group").groupBy("shard").agg({"bytes": "sum"}).toDF("s", "t").collect()]
    largest = max(len(t.encode()) for t in text_of.values())
    assert placed.count() == groups.count() and max(totals) - min(totals) < largest


def test_a_third_of_the_rows_alike(spark, staging):
    rows = [(7, "copy")] * 500 + [(n, f"text {n % 90}") for n in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    placed = sharding.shard_documents(df, 4, staging, slots_each=60).collect()
    assert sorted(r.doc_id for r in placed) == sorted(i for i, _ in rows)
    for shard in range(4):
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in placed if r.text_crc32 == zlib.crc32(b"copy")}) == 1
