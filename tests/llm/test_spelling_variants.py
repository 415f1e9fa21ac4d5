from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import cases
import pytest

from siltgate.llm import queries, spelling_variants

UPPER = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)


def near(a, b):
    """One edit apart, told by cutting off what both begin and end with."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return max(len(a), len(b)) == 1


def plain(docs, delete=31, least=7):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % delete == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= 2}
    # Words one edit apart share the word less one letter, or are it.
    shared = defaultdict(set)
    for w in n:
        for part in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            shared[part].add(w)
    links = defaultdict(set)
    for group in shared.values():
        for a in group:
            links[a].update(b for b in group if b not in links[a] and near(a, b))
    form = {}
    for w in n:
        best = min(links[w], key=lambda b: (-n[b], b), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return [(w, form[w], root(w), n[w], len(links[w]), n.get(form[w])) for w in n]


def grouped(df, staging, **settings):
    return [tuple(r) for r in spelling_variants.group_variants(df, staging, **settings).collect()]


def test_given_table(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = grouped(docs, staging)
    assert cases.same_rows(got, want) and len(want) > 3_000 and sum(w[1] is not None for w in want) > 50


@pytest.mark.parametrize("seed", range(3))
def test_dense_words(spark, staging, seed):
    """Words of few letters with repeated grams, so that ranks tie and edits pile up."""
    draw = random.Random(seed)
    base = ["".join(draw.choice("abÀ") for _ in range(draw.randrange(7, 11))) for _ in range(60)]
    docs = []
    for i in range(400):
        words = [draw.choice(base) for _ in range(8)]
        words += ["".join(draw.choice("aab") for _ in range(7)), "Aaaaaaaa", "aaaaaaa", "bananana"]
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = plain(docs, delete=3)
    got = grouped(df, staging, delete=3)
    assert cases.same_rows(got, want) and sum(w[4] for w in want) > 500


def test_forms_are_followed(spark, staging):
    words = {"colorful": 1200, "colourful": 100, "colourfull": 9, "colourfulll": 2, "another": 2}
    docs = [(0, " ".join(w for w, n in words.items() for _ in range(n)))]
    rows = {r[0]: r for r in grouped(spark.createDataFrame(docs, "doc_id long, text string"), staging, delete=10**9)}
    assert [rows[w][2] for w in words] == ["colorful", "colorful", "colorful", "colourfulll", "another"]
    assert rows["another"] == ("another", None, "another", 2, 0, None)


def test_awkward_rows(spark, staging):
    docs = cases.awkward(spark, True)
    want = plain([(i, t) for i, t, *_ in cases.AWKWARD], delete=2, least=4)
    assert cases.same_rows(grouped(docs, staging, delete=2, least_letters=4), want) and want
    assert grouped(cases.empty(spark), staging) == []


def test_query(spark):
    rows = queries.op11_pivotal_spelling_variants(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"] and rows.count() > 100
