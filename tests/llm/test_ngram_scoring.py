from __future__ import annotations

import math
import zlib
from collections import Counter

import cases
import numpy as np
import pandas as pd
import pytest

from siltgate.llm import ngram_scoring as lm


def brute(docs):
    """The same model with plain dictionaries: (doc_id, held_out, n_tokens, ...)."""

    def counts(chosen):
        words, pairs = Counter(), Counter()
        for _, tokens in chosen:
            words.update(tokens)
            pairs.update(zip(["<start>", *tokens], tokens, strict=False))
        words["<start>"] = len(chosen)
        return words, pairs

    def probability(words, pairs, n, v, h, w):
        c = words[h]
        bucket = min(int(math.log2(c)) + 1, lm.BUCKETS - 1) if c else 0
        return bucket, pairs[h, w] / max(c, 1), words[w] / max(n, 1), 1 / (v + 1)

    def size(words):
        own = {w: c for w, c in words.items() if w != "<start>" and c}
        return sum(own.values()), len(own)

    coded = [(i, [*(x.decode() for x in (t or "").encode().lower().split()), "<end>"]) for i, t in docs]
    fold = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i, _ in coded]
    learnt = [d for d, f in zip(coded, fold, strict=True) if f != 2]
    words, pairs = counts(learnt)
    n, v = size(words)
    rest = [d for d, f in zip(coded, fold, strict=True) if f not in (2, 3)]
    left_words, left_pairs = counts(rest)
    left = size(left_words)
    cells = Counter()
    for (_, tokens), f in zip(coded, fold, strict=True):
        for h, w in zip(["<start>", *tokens], tokens, strict=False) if f == 3 else ():
            b, p2, p1, p0 = probability(left_words, left_pairs, *left, h, w)
            cells[(b, *(int(x) for x in lm._bins(np.array([p2 / p0, p1 / p0]))))] += 1
    table = pd.DataFrame([(*k, c) for k, c in sorted(cells.items())], columns=["bucket", "pair", "word", "n"])
    weights = lm.learn_weights(table)
    out = []
    for (i, tokens), f in zip(coded, fold, strict=True):
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        score = 0.0
        for h, w in zip(["<start>", *tokens], tokens, strict=False):
            b, p2, p1, p0 = probability(words, pairs, n, v, h, w)
            score += math.log10(weights[b] @ [p2, p1, p0])
        out.append((i, f == 2, len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return out


def close(rows, want):
    rows, want = (sorted(map(tuple, x), key=cases.key) for x in (rows, want))
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    for r, q in zip(rows, want, strict=True):
        assert r[5:] == pytest.approx(q[5:], rel=1e-9)


def test_given_table(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(d.doc_id, d.text) for d in docs.collect()])
    rows = lm.score_documents(docs, staging).collect()
    close(rows, want)
    close(lm.score_documents(docs, staging, piece_mb=0.1, bucket_mb=1).collect(), want)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_awkward_rows(spark, staging):
    want = brute([(i, t) for i, t, *_ in cases.AWKWARD])
    close(lm.score_documents(cases.awkward(spark, True), staging).collect(), want)
    assert lm.score_documents(cases.empty(spark), staging).count() == 0


def test_weights_follow_what_predicts():
    at = lambda x: int(lm._bins(np.array([x]))[0])
    cells = pd.DataFrame(
        [(1, -1, at(2.0), 90), (1, at(900.0), at(2.0), 10), (8, at(900.0), at(2.0), 95), (8, -1, at(2.0), 5)],
        columns=["bucket", "pair", "word", "n"],
    )
    weights = lm.learn_weights(cells)
    assert weights[8][0] > 0.9 > 0.2 > weights[1][0]
    assert np.allclose(weights.sum(axis=1), 1) and weights[0][0] == 0


def test_long_ids_beside_null(spark, staging):
    """Ids that doubles can't tell apart, in one piece with a row that has none."""
    big = (1 << 53) + 1
    rows = [(i, f"one two {(i or 0) % 3} three") for i in (None, big, big + 1, big + 2, big + 3, -big, 0, 7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = lm.score_documents(docs, staging).collect()
    close(found, brute(rows))
    assert {r.doc_id for r in found} == {i for i, _ in rows}
