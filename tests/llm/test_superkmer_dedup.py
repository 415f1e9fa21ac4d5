from __future__ import annotations

import random
import re

import cases
import numpy as np
import pytest

from siltgate.llm import queries, superkmer_dedup

SF = "/root/testdata/sf0.01"


def plain(docs, window):
    """(doc_id, kept text, words, removed) by looking up every window."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first = {}
    for (i, _), words in zip(docs, split, strict=True):
        for at in range(len(words) - window + 1):
            w = tuple(words[at : at + window])
            first[w] = min(first.get(w, np.inf), -np.inf if i is None else i)
    out = []
    for (i, t), words in zip(docs, split, strict=True):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < (-np.inf if i is None else i):
                gone.update(range(at, at + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out.append((i, None if t is None else kept, len(words), len(gone)))
    return out


def found(docs, staging, **settings):
    rows = superkmer_dedup.remove_repeated_windows(docs, staging, **settings).collect()
    return [(r.doc_id, r.text, r.n_words, r.n_removed) for r in rows]


@pytest.mark.parametrize("split_above", [superkmer_dedup.SPLIT_ABOVE, 1])
def test_given_table(spark, staging, split_above):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert cases.same_rows(found(docs, staging, split_above=split_above), want)
    assert sum(n > 0 for *_, n in want) > 20


@pytest.mark.parametrize("split_above", [10_000, 1])
def test_shared_passages_and_self_repeats(spark, staging, split_above, monkeypatch):
    """Passages in a third of all documents, few different words, and many repeats."""
    monkeypatch.setattr(superkmer_dedup, "CHUNK_BYTES", 3_000)
    draw = random.Random(1)
    hot = [f"h{draw.randrange(9)}" for _ in range(31)]
    docs = []
    for n in range(300):
        words = [f"w{draw.randrange(4)}" for _ in range(draw.randrange(40))]
        if n % 3 == 0:
            at = draw.randrange(len(words) + 1)
            words[at:at] = hot[draw.randrange(8) :]
        if n % 5 == 0:
            words += ["again"] * draw.randrange(30)
        docs.append((n // 2, draw.choice(" \t\n").join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = found(df, staging, window=12, gram=3, split_above=split_above)
    want = plain(docs, 12)
    assert cases.same_rows(got, want) and sum(n for *_, n in want) > 1_000


def test_awkward_rows(spark, staging):
    text = " ".join(f"v{i}" for i in range(60))
    more = [(None, text, None, None, None), (20, text, "en", "a", 1), (20, text, "en", "a", 1), (21, text + " end", "en", "a", 1)]
    docs = cases.awkward(spark, True)
    extra = spark.createDataFrame(more, cases.DOCS).selectExpr("*", *[f"'x' AS `{c}`" for c in cases.CLASHES])
    rows = superkmer_dedup.remove_repeated_windows(docs.union(extra), staging)
    assert rows.columns == [*docs.columns, "n_words", "n_removed"]
    want = plain([(i, t) for i, t, *_ in [*cases.AWKWARD, *more]], 50)
    got = [(r.doc_id, r.text, r.n_words, r.n_removed) for r in rows.collect()]
    assert cases.same_rows(got, want)
    assert [n for i, _, _, n in sorted(got, key=cases.key) if i in (20, 21)] == [60, 60, 60]
    assert superkmer_dedup.remove_repeated_windows(cases.empty(spark), staging).count() == 0


def test_minimisers_and_classes():
    draw = np.random.default_rng(3)
    hashes = draw.integers(0, 2**63, 200).astype(np.uint64)
    whole = superkmer_dedup.window_minimisers(hashes, 20, 6)
    apart = [superkmer_dedup.window_minimisers(hashes[i : i + 20], 20, 6)[0] for i in range(181)]
    assert whole.tolist() == apart
    coded = draw.integers(0, 3, 4_000)
    classes = superkmer_dedup.window_classes(coded, 7)
    seen = {}
    for at, c in enumerate(classes.tolist()):
        assert seen.setdefault(c, coded[at : at + 7].tolist()) == coded[at : at + 7].tolist()
    assert len(seen) == len({tuple(coded[i : i + 7]) for i in range(3_994)})


def test_query(spark):
    rows = queries.op13_superkmer_windows(spark, "/root/testdata/sf0.001").collect()
    assert len(rows[0].kept_sha256) == 64 and any(r.n_removed for r in rows)


def test_twin(spark):
    import compare

    sf, name = "/root/testdata/sf0.001", "op13_superkmer_windows"
    rows = compare.spark_rows(queries.QUERIES[name](spark, sf))
    assert rows == compare.sql_rows(compare.connect(sf), queries.ORACLE[name])
