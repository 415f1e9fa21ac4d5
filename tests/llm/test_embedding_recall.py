from __future__ import annotations

import numpy as np

from siltgate.llm import embedding_dedup


def test_recall_where_pairs_are_thin(spark, staging):
    """More rows than are fitted; the probes meet next to no pairs."""
    draw = np.random.default_rng(9)
    units = draw.normal(size=(20_000, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    cosine = draw.uniform(0.901, 0.95, size=(300, 1))
    away = draw.normal(size=(300, 64))
    away -= (away * units[:300]).sum(axis=1, keepdims=True) * units[:300]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    rows = np.concatenate([units, cosine * units[:300] + np.sqrt(1 - cosine**2) * away])
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    classes = spark.createDataFrame(data, "node long, vector array<double>")
    found = {(r.a, r.b) for r in embedding_dedup.link_vectors(classes, staging).collect()}
    true = {(i, 20_000 + i) for i in range(300)}
    assert len(found & true) >= 0.9 * len(true)
