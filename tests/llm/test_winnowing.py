from __future__ import annotations

import random

import cases
import xxhash
from pyspark.sql import functions as F

from siltgate.llm import winnowing as w

SF = "/root/testdata/sf0.001"


def grams(text, k):
    """Karp-Rabin hashes as a plain loop rolls them."""
    words = [x for x in _split(text.lower()) if x]
    hashed = [xxhash.xxh64_intdigest(x.encode(), 42) for x in words]
    hashed = [(h - (1 << 64) if h >> 63 else h) % w.PRIME for h in hashed]
    if not hashed:
        return []
    k = min(k, len(hashed))
    top = pow(w.BASE, k - 1, w.PRIME)
    h = 0
    for x in hashed[:k]:
        h = (h * w.BASE + x) % w.PRIME
    out = [h]
    for old, new in zip(hashed, hashed[k:], strict=False):
        h = ((h - old * top) * w.BASE + new) % w.PRIME
        out.append(h)
    return out


def _split(text):
    import re

    return re.split(r"[ \t-\r]+", text)


def select(hashes, window):
    """(hash, position) of the rightmost least of each window, each once."""
    if not hashes:
        return []
    out = []
    for at in range(max(1, len(hashes) - window + 1)):
        part = list(enumerate(hashes[at : at + window], at))
        least = min(part, key=lambda p: (p[1], -p[0]))
        if not out or out[-1] != least[::-1]:
            out.append(least[::-1])
    return out


def test_selection_equals_a_plain_loop(spark):
    texts = [t or "" for _, t, *_ in cases.AWKWARD] + ["a a a a a a a a a a a a a a a b a a a a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for k, window in ((5, 8), (1, 3), (3, 1), (4, 5), (7, 6)):
        made = df.select(
            "i",
            w.gram_hashes(F.col("text"), k).alias("g"),
            w.winnow(F.col("text"), k, window).alias("s"),
        ).select("i", "g", w.hashes(F.col("s")).alias("h"), w.positions(F.col("s")).alias("p"))
        for r in made.collect():
            assert r.g == grams(texts[r.i], k), (r.i, k)
            assert list(zip(r.h, r.p, strict=True)) == select(r.g, window), (r.i, k, window)


def test_shared_runs_are_found(spark):
    draw = random.Random(3)
    run = " ".join(f"run{i}" for i in range(12))  # window + k - 1 words
    pairs = []
    for n in range(60):
        ends = [" ".join(f"x{draw.random()}" for _ in range(draw.randrange(30))) for _ in range(4)]
        pairs.append((n, f"{ends[0]} {run} {ends[1]}", f"{ends[2]} {run} {ends[3]}"))
    df = spark.createDataFrame(pairs, "n int, a string, b string")
    a, b = (w.hashes(w.winnow(F.col(c), 5, 8)) for c in "ab")
    assert df.filter(F.arrays_overlap(a, b)).count() == 60


def likeness(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if set(a) | set(b) else 1.0


def brute(docs):
    order = sorted({(d[0], d[1] or "") for d in docs}, key=lambda d: d[0])
    follower = {d: order[(i + 1) % len(order)][1] for i, d in enumerate(order)}
    out = []
    for doc_id, text, *_ in docs:
        text = text or ""
        after = follower[(doc_id, text)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, other, follow = ([h for h, _ in select(grams(t, 5), 8)] for t in (text, edited, after))
        out.append((doc_id, len(text), edited, likeness(own, other), likeness(own, follow)))
    return out


def test_given_table(spark, staging):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = w.fingerprint_documents(docs, staging).drop("selected", "edited_selected").collect()
    assert cases.same_rows(rows, brute([(d.doc_id, d.text) for d in docs.collect()]))


def test_awkward_rows(spark, staging):
    named = [d for d in cases.AWKWARD if d[0] not in (9, None)]
    docs = spark.createDataFrame(named, cases.DOCS).repartition(3)
    rows = w.fingerprint_documents(docs.withColumn("_row", F.lit(1)), staging)
    assert cases.same_rows(rows.drop("selected", "edited_selected").collect(), brute(named))
    everything = w.fingerprint_documents(cases.awkward(spark, True), staging).collect()
    assert len(everything) == len(cases.AWKWARD)
    repeated = [r for r in everything if r.n_chars == len(cases.AWKWARD[8][1])]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert w.fingerprint_documents(cases.empty(spark), staging).count() == 0
    one = w.fingerprint_documents(spark.createDataFrame([named[0]], cases.DOCS), staging).first()
    assert one.near_next == 1.0
