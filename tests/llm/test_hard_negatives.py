from __future__ import annotations

import math
import random

import cases
import numpy as np
import pytest

from siltgate.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """The same choice, anchor by anchor, in Python integers. Rows are told apart by value."""
    sound = []
    for i, v, label in dict.fromkeys((i, None if v is None else tuple(v), label) for i, v, label in rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        sound.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for anchor in sound:
        if anchor[0] % 100:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), r) for r in sound if r is not anchor]
        scored.sort(key=lambda x: (-x[0], x[1][0]))
        for p, positive in [x for x in scored if x[1][1] == anchor[1]][:5]:
            fit = [x for x in scored if x[1][1] != anchor[1] and 80 * p <= 100 * x[0] <= 100 * p]
            for rank, (s, negative) in enumerate(fit[:5], 1):
                out.append((anchor[0], positive[0], rank, negative[0], p, s))
    return out


def mined(df, staging, **settings):
    return [tuple(r) for r in hard_negatives.mine_hard_negatives(df, staging, **settings).collect()]


@pytest.mark.parametrize("block", [10_000, 37])
def test_given_table(spark, staging, block):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = plain([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    got = mined(df, staging, candidate_block=max(block, 200), anchor_block=min(block, 9))
    assert sorted(got) == sorted(want) and len(want) > 100


def test_ties_and_hot_labels(spark, staging):
    draw = random.Random(4)
    rows = [(i, [draw.choice([0.0, 0.25, 0.5]) for _ in range(3)], draw.choice([1, 1, 1, 2, 3])) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = plain(rows)
    assert sorted(mined(df, staging, candidate_block=100)) == sorted(want) and len(want) > 100


def test_awkward_rows(spark, staging):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [], 1), (200, [0.5], 3), (300, None, 1), (None, [1.0], 1),
        (400, [1.0, None], 1), (500, [nan, 1.0], 1), (600, [inf, 1.0], 1), (700, [1.0, 1.0], None),
        (1, [1.0, 0.4], 1), (2, [1.0, 0.4], 2), (2, [1.0, 0.4], 2), (3, [0.9, 0.5], 2), (4, [-3.0, -1.0], 2),
        (5, [1e30, 0.0], 5), (-100, [0.7, 0.7], 2), (-7, [0.7, 0.6], 1), (6, [1.0, 0.4, 9.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    usual = [r for r in rows if r[0] != 5]
    clashing = df.selectExpr("*", *[f"'x' AS `{c}`" for c in [*cases.CLASHES, "id", "number", "parts"] if c != "label"])
    got = mined(clashing.filter("vec_id IS NULL OR vec_id <> 5"), staging)
    want = plain(usual)
    assert sorted(got) == sorted(want) and want
    assert all(a != 5 for a, *_ in mined(df, staging))
    assert mined(df.limit(0), staging) == [] and mined(df.filter("vec_id = 1"), staging) == []


@pytest.mark.parametrize("top", [100, 10**6, 2**30, 2**40])
def test_packed_products_are_exact(top):
    draw = np.random.default_rng(top)
    anchors, candidates = draw.integers(-top, top, (7, 33)), draw.integers(-top, top // 2 + 1, (50, 33))
    want = anchors.astype(object) @ candidates.astype(object).T
    got = hard_negatives.packed_products(anchors, candidates)
    assert got.tolist() == np.clip(want, -hard_negatives.LONGEST, hard_negatives.LONGEST).tolist()


def test_query(spark):
    assert queries.op12_packed_hard_negatives(spark, "/root/testdata/sf0.01").count() > 0


def test_twin(spark):
    import compare

    sf = "/root/testdata/sf0.01"
    for name in ("op12_packed_hard_negatives", "op8_url_verdicts"):
        rows = compare.spark_rows(queries.QUERIES[name](spark, sf))
        assert rows == compare.sql_rows(compare.connect(sf), queries.ORACLE[name]) and rows[1]
