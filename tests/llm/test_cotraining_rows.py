from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from siltgate.llm import cotraining

SF = "/root/testdata/sf0.01"


def sampled(monkeypatch, docs, labels, **limits):
    """The rows that the views are fitted on."""
    seen = []
    trainer = cotraining.CoTrainer

    def made(sample):
        seen.append(sample)
        return trainer(sample.iloc[:0])  # not ready: nothing more is learned

    monkeypatch.setattr(cotraining, "CoTrainer", made)
    cotraining.train(docs, labels, **limits)
    monkeypatch.setattr(cotraining, "CoTrainer", trainer)
    return seen[0]


def test_copies_of_an_id_are_one_row(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    order = F.xxhash64("doc_id")
    first = [
        docs.join(labels, "doc_id", how).orderBy(order).first().doc_id for how in ("left_semi", "left_anti")
    ]
    hot = docs.filter(F.col("doc_id").isin(first)).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(400))))
    more = docs.union(hot.drop("k")).union(hot.filter("k < 9").withColumn("text", F.concat("text", "k")).drop("k"))
    limits = {"labelled_rows": 120}
    rows = sampled(monkeypatch, more.repartition(5), labels, **limits)
    assert len(rows) == 120 and rows["label"].notna().sum() == 120
    plain = sampled(monkeypatch, docs, labels, **limits)
    assert len(plain) == 120 and np.isclose(plain["label"].sum(), rows["label"].sum())


def test_all_of_six_thousand_labelled_rows_are_learned_from(spark, monkeypatch):
    docs = spark.range(11_000).selectExpr(
        "id AS doc_id", "concat('word ', id) AS text", "'en' AS lang", "'a' AS source", "6L AS n_chars"
    )
    labels = spark.range(6_500).selectExpr("id AS doc_id", "int(id % 2) AS quality", "0 AS toxic")
    rows = sampled(monkeypatch, docs, labels)
    assert rows["label"].notna().sum() == 6_000 and len(rows) == 6_000
    assert all(len(w) == 2 and w.dtype == np.int32 for w in rows["words"])


def test_unlabelled_rows_are_all_rows_without_a_label(spark, staging):
    docs = spark.range(40_000).selectExpr("if(id % 9 = 0, NULL, id % 30000) AS doc_id", "'t' AS text")
    known = spark.range(0, 30_000, 2).selectExpr("id AS _labelled", "1D AS label")
    found = cotraining._unlabelled(docs, known, staging)
    want = docs.filter("doc_id IS NULL OR doc_id % 2 = 1")
    assert found.groupBy("doc_id").count().exceptAll(want.groupBy("doc_id").count()).isEmpty()
    assert found.count() == want.count()
