from __future__ import annotations

import cases
import pytest

from siltgate.llm import cotraining

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(tables):
    docs, labels = tables
    seen = labels.filter("doc_id % 3 != 0")
    model = cotraining.train(docs, seen)
    scored = cotraining.score_documents(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id")
    rows = scored.collect()
    good = [r.keep for r in rows if r.quality == 1 and not r.toxic]
    print("kept of good, bad, good but toxic:", *[
        f"{sum(x)}/{len(x)}" for x in (
            good, [r.keep for r in rows if r.quality == 0], [r.keep for r in rows if r.quality == 1 and r.toxic]
        )
    ])
    bad = [r.keep for r in rows if r.quality == 0 or r.toxic]
    toxic = [r.keep for r in rows if r.toxic]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.08 * len(bad)
    assert sum(toxic) <= 0.2 * len(toxic)  # words of three foreign languages, few labels
    # Each view alone knows something, and both together no less than the better one.
    right = {v: sum((r[v] >= 0.5) == (r.quality == 1 and not r.toxic) for r in rows) for v in ("p_text", "p_meta", "score")}
    assert right["p_meta"] > 0.85 * len(rows) and right["score"] >= max(right.values()) - 0.01 * len(rows)


def test_same_model_whatever_the_partitions(tables):
    docs, labels = tables
    clashing = labels.union(labels.selectExpr("doc_id", "1 - quality", "toxic").filter("doc_id % 3 = 0"))
    tables = [(docs, clashing), (docs.repartition(7), clashing.repartition(5))]
    few = [cotraining.train(d, known, labelled_rows=300, taught_rows=50) for d, known in tables]
    assert (few[0].text == few[1].text).all() and few[0].joint == few[1].joint


def test_lessons_come_from_all_unlabelled_rows(spark, monkeypatch):
    """The surest rows are found wherever they are, and copies of one teach once."""
    words = {1: "good fine nice", 0: "bad poor sad"}
    rows = [(n, f"{words[n % 2]} filler{n % 50}", "en", "a", 20) for n in range(400)]
    more = [(1_000 + n, f"{words[n % 2]} rest{n % 97}", "en", "a", 20) for n in range(3_000)]
    docs = spark.createDataFrame(rows + more, cases.DOCS).repartition(6)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, *_ in rows], "doc_id long, quality int, toxic int")
    taught = []
    teach = cotraining.CoTrainer.teach

    def seen(self, table, lessons):
        taught.append((table.num_rows, lessons))
        teach(self, table, lessons)

    monkeypatch.setattr(cotraining.CoTrainer, "teach", seen)
    model = cotraining.train(docs, labels, taught_rows=60, confident=0.6)
    assert len(taught) == 2
    for n, lessons in taught:
        assert n == len({k for lesson in lessons for k in lesson}) and n >= 60
        assert set(lessons[0].values()) == {0.0, 1.0}
    kept = cotraining.keep_good(docs.drop("lang", "n_chars"), model)
    assert kept.columns == ["doc_id", "text", "source"]
    assert all(r.text.startswith("good") for r in kept.collect())


def test_awkward_rows(spark, tables):
    docs, labels = tables
    model = cotraining.train(docs.limit(500), labels)
    rows = cotraining.score_documents(cases.awkward(spark, True), model).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(d[0]) for d in cases.AWKWARD)
    kept = cotraining.keep_good(cases.awkward(spark), model)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in rows)
    assert cotraining.score_documents(cases.empty(spark), model).count() == 0
    assert cotraining.keep_good(cases.empty(spark), model).count() == 0


def test_without_labels_all_stay(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    for known in (labels.limit(0), odd):
        model = cotraining.train(docs.limit(50), known)
        assert cotraining.score_documents(docs.limit(50), model).filter("NOT keep").count() == 0
