from __future__ import annotations

import cases
import numpy as np

from siltgate.llm import embedding_dedup

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    good = [
        (i, np.array(v, dtype=float))
        for i, v in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links = []
    for n, (i, v) in enumerate(good):
        for j, w in good[:n]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9:
                links.append((i, j))
    root = cases.closure([i for i, _ in rows], links)
    count = {i: 0 for i, _ in rows}
    for i, j in links:
        count[i] += 1
        count[j] += 1
    return [(i, count[i], root[i], i == root[i]) for i, _ in rows]


def test_traversal_is_nearest_first():
    draw = np.random.default_rng(1)
    left, right = draw.random(9), draw.random(7)
    cells = embedding_dedup.nearest_cells(left, right, 63)
    sums = [left[i] + right[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == 63


def planted(n, width=16, seed=2):
    """Groups of vectors about each other, chains that only links join, and lone ones."""
    draw = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base = draw.normal(size=width)
        for _ in range(draw.integers(1, 5)):
            base = base + draw.normal(size=width) * 0.25 * draw.random()
            rows.append((len(rows), [float(x) for x in base.astype(np.float32)], 0))
    return rows


def test_recall_against_brute_force(spark, staging):
    rows = planted(1500)
    df = spark.createDataFrame(rows, VECTORS)
    found = embedding_dedup.near_duplicates(df, staging).collect()
    want = brute([r[:2] for r in rows])
    true, got = sum(r[1] for r in want), sum(r.n_links for r in found)
    assert got <= true and got >= 0.97 * true and true > 500
    links = {r[0]: r[1] for r in want}
    assert all(r.n_links <= links[r.vec_id] for r in found)


def test_given_table(spark, staging):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = embedding_dedup.near_duplicates(df, staging).collect()
    assert cases.same_rows(found, brute([(r.vec_id, r.embedding) for r in df.collect()]))


def test_awkward_vectors(spark, staging):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, None, 0), (5, [], 0),
        (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [1.0, 0.0, 0.0], 0),
        (10, [-1.0, 0.0], 0), (11, [1.0, -0.0], 0), (12, [None, 1.0], 0), (13, [1e-30, 1e-31], 0),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS node", "'y' AS root", "1 AS a")
    found = embedding_dedup.near_duplicates(df, staging).collect()
    assert cases.same_rows(found, brute([r[:2] for r in rows]))
    assert embedding_dedup.near_duplicates(df.limit(0), staging).count() == 0
    unnamed = spark.createDataFrame([(None, [1.0, 0.0], 0), (3, [1.0, 0.0], 0)], VECTORS)
    rows = embedding_dedup.near_duplicates(unnamed, staging).collect()
    assert cases.same_rows(rows, [(None, 1, 3, False), (3, 1, 3, True)])


def test_split_cells_find_the_same(spark, staging):
    rows = planted(300, seed=3)
    classes = spark.createDataFrame([(r[0], r[1]) for r in rows], "node long, vector array<double>")
    whole = embedding_dedup.link_vectors(classes, staging).collect()
    split = embedding_dedup.link_vectors(classes, staging, block_rows=3).collect()
    assert whole and cases.same_rows(whole, split)
