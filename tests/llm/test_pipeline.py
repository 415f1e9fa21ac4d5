from __future__ import annotations

from collections import Counter, defaultdict

import cases
import corpus_pipeline as pipeline
from test_line_dedup import brute as plain_lines
from test_simhash_dedup import plain_likeness

from siltgate.llm import cotraining

SF = "/root/testdata/sf0.01"


def near_copy_roots(texts):
    """The least doc_id that links of a five-word likeness of 0.8 reach, by brute force over
    texts that share a shingle."""
    holders = defaultdict(set)
    for i, t in texts.items():
        words = t.encode().lower().split()
        for k in range(max(1, len(words) - 4)):
            holders[tuple(words[k : k + 5])].add(i)
    pairs = {(a, b) for group in holders.values() if len(group) < 200 for a in group for b in group if a < b}
    return cases.closure(list(texts), [(a, b) for a, b in pairs if plain_likeness(texts[a], texts[b]) >= 0.8])


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    (_, quality), (_, lines), (_, copies), (_, pack) = pipeline.STAGES
    model = cotraining.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = quality(spark, docs, SF).collect()
    want = {r.doc_id for r in cotraining.score_documents(docs, model).filter("keep").collect()}
    assert {r.doc_id for r in kept} == want and len(kept) == len(want)

    before = spark.createDataFrame(kept, docs.schema)
    edited = lines(spark, before, SF).collect()
    texts = {i: t for i, t, _ in plain_lines(spark, [(r.doc_id, r.text) for r in kept], leave_copies=0.8)}
    assert {r.doc_id: r.text for r in edited} == texts
    own = {r.doc_id: r.text for r in kept}
    assert all(r.n_chars == len(r.text) for r in edited if r.text != own[r.doc_id])

    after = spark.createDataFrame(edited, docs.schema)
    single = {r.doc_id for r in copies(spark, after, SF).collect()}
    root = near_copy_roots(texts)
    gone = {i for i in texts if root[i] != i}
    assert gone and set(texts) - single <= gone
    assert len(gone & single) <= 0.1 * len(gone)

    pieces = pack(spark, after.filter(after.doc_id.isin(list(single))), SF).collect()
    lengths = Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert {r.doc_id: r.doc_tokens for r in pieces} == dict(lengths) and set(lengths) == single
    whole = pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in whole} == single


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    for _, stage in pipeline.STAGES[1:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == [c.split()[0] for c in cases.DOCS.split(", ")]
    rows = docs.collect()
    # 2 is a copy of 1; 4 and 5 have no words, as 3; rows of one id and text count as one.
    ids = Counter(r.doc_id for r in rows)
    assert ids[1] == ids[3] == ids[None] == ids[9] == 1 and not ids[2] + ids[4] + ids[5]
    for _, stage in pipeline.STAGES:
        assert stage(spark, cases.empty(spark), SF).count() == 0


def test_clashing_columns_survive_and_choices_repeat(spark):
    docs = cases.awkward(spark, True).selectExpr("*", "'y' AS lines_removed", "'z' AS chars_removed")
    lines, copies = pipeline.STAGES[1][1], pipeline.STAGES[2][1]
    found = []
    for parts in (1, 4):
        out = copies(spark, lines(spark, docs.repartition(parts), SF), SF)
        assert out.columns == docs.columns
        found.append(sorted((tuple(r) for r in out.collect()), key=cases.key))
    assert found[0] == found[1]
