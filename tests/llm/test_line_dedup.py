from __future__ import annotations

import random
import re

import cases
import xxhash
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from siltgate.llm import line_dedup


def hash64(data):
    h = xxhash.xxh64_intdigest(data.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def units(text):
    return [u for u in re.split(r"(?<=[.!?\n])(?![.!?\n])", text) if u]


BLANKS = " \t\r\n"


def marked_hash(line):
    return hash64(line) & ~127 | min(len(line), 127)


def rolled_marks(spark, hashed):
    """Pairs of neighbouring hashes that make a boundary, from Spark's hash of two longs."""
    pairs = sorted({pair for h in hashed for pair in zip(h, h[1:], strict=False)})
    frame = spark.createDataFrame(pairs, "p long, x long")
    return {(r.p, r.x) for r in frame.filter(F.pmod(F.xxhash64("p", "x"), F.lit(3)) > 0).collect()}


def count(text):
    return len(re.findall(r"[^ \t\n\x0b\f\r]+", text))


def alike(mine, theirs):
    n = 0
    while n < min(len(mine), len(theirs)) and mine[n] == theirs[n]:
        n += 1
    return n


def brute(spark, docs, least_words=8, leave_copies=None):
    """The same law in plain loops over (doc_id, text); rows of both equal are one document."""
    known = {}
    for i, t in docs:
        if t:
            known[(-(1 << 63) if i is None else i, hash64(t))] = (t, [u.strip(BLANKS) for u in units(t)])
    marks = rolled_marks(spark, [[marked_hash(x) for x in t] for _, t in known.values()])
    places, first = [], {}
    for doc in sorted(known):
        text, t = known[doc]
        h, last = [marked_hash(x) for x in t], len(t) - 1
        edges = [i for i in range(last + 1) if i in (0, last) or len(t[i]) >= 60 or (h[i], h[i + 1]) in marks]
        size = [min(len(x), 127) for x in t]
        spans = [
            (s, e) for s, e in zip(edges, edges[1:], strict=False)
            if size[s] + size[e] + (size[s + 1] if e > s + 1 else 0) >= 32
        ]
        spans += [(i, i) for i in range(last + 1) if size[i] >= 100]
        for s, e in sorted(spans):
            own = "\n".join(t[s : e + 1] if s == e or s == 0 else t[s + 1 : e + 1])
            head = 0 if s == e or s == 0 else count(t[s])
            weight = s, e, head, count(own), 0 if s == e else len(own)
            places.append((doc, s, e, tuple(t[s : e + 1]), weight))
            first.setdefault(places[-1][3], (doc, s, e))
    stretches = {}
    for doc, s, e, lines_, weight in places:
        doc0, s0, e0 = first[lines_]
        if (doc, s) == (doc0, s0):
            continue
        t, t0 = known[doc][1], known[doc0][1]
        begin = s - alike(t[max(s - 4, 0) : s][::-1], t0[max(s0 - 4, 0) : s0][::-1])
        while begin < s and t[begin] == "":
            begin += 1
        if begin == s and 0 < s < e and count(t[s]) == 0:
            begin = s + 1
        end = e + alike(t[e + 1 : e + 5], t0[e0 + 1 : e0 + 5])
        if doc == doc0:
            begin = max(begin, e0 + 1)
        if begin <= end:
            stretches.setdefault((doc, doc0, s - s0), []).append((begin, end, weight))
    gone, copies = {doc: set() for doc in known}, set()
    for (doc, doc0, _), parts in stretches.items():
        if sum(w[3] for *_, w in parts) + min(w for *_, w in parts)[2] >= least_words:
            for begin, end, _ in parts:
                gone[doc].update(range(begin, end + 1))
            size = max(len(known[doc][0]), len(known[doc0][0]))
            if leave_copies is not None and doc != doc0 and sum(w[4] for *_, w in parts) >= leave_copies * size:
                copies.add(doc)
    out = []
    for i, t in docs:
        doc = (-(1 << 63) if i is None else i, hash64(t)) if t else None
        lost = gone[doc] if t and doc not in copies else set()
        out.append((i, t and "".join(u for n, u in enumerate(units(t)) if n not in lost), len(lost)))
    return out


def test_given_table(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = line_dedup.remove_repeated_chunks(docs, staging).collect()
    want = brute(spark, [(d.doc_id, d.text) for d in docs.collect()])
    assert cases.same_rows([(r.doc_id, r.text, r.lines_removed) for r in rows], want)
    assert sum(r.lines_removed > 0 for r in rows) > 50
    size = {d.doc_id: len(d.text) for d in docs.collect()}
    assert all(size[r.doc_id] - len(r.text) == r.chars_removed for r in rows)


def test_few_different_lines(spark, staging):
    """Texts of few lines that repeat within and between texts, some in a third of all."""
    draw = random.Random(2)
    pool = [sentence(draw, draw.randrange(1, 20)) for _ in range(25)]
    docs = []
    for n in range(200):
        own = [draw.choice(pool) for _ in range(draw.randrange(12))]
        if n % 3 == 0:
            own[draw.randrange(len(own) + 1) : 0] = pool[:6]
        docs.append((n // 2 or None, draw.choice([" ", "\n", "  \n"]).join(own)))
    docs += docs[:30]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for settings in ({}, {"least_words": 20}, {"leave_copies": 0.6}):
        rows = line_dedup.remove_repeated_chunks(df, staging, **settings).collect()
        want = brute(spark, docs, **settings)
        assert cases.same_rows([(r.doc_id, r.text, r.lines_removed) for r in rows], want)
        assert sum(n for *_, n in want) > 300


def test_first_occurrence_stays_in_a_text_that_repeats_itself(spark, staging):
    for line in ("One two three four five. ", " ".join(["word"] * 30) + ". "):
        text = line * 40
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        row = line_dedup.remove_repeated_chunks(df, staging).first()
        assert text.startswith(row.text) and 1 <= len(row.text) // len(line) <= 3


def sentence(draw, words):
    return " ".join(f"w{draw.randrange(10**6)}" for _ in range(words)).capitalize() + "."


def test_passages_go_and_clean_documents_stay(spark, staging):
    draw = random.Random(8)
    passages = [" ".join(sentence(draw, draw.randrange(5, 12)) for _ in range(9)) for _ in range(40)]
    docs, hosts = [], []
    for n in range(400):
        own = [" ".join(sentence(draw, draw.randrange(4, 15)) for _ in range(4)) for _ in range(6)]
        if n % 2:
            own.insert(draw.randrange(7), passages[n % 40])
            hosts.append((n, passages[n % 40]))
        docs.append((n, "\n".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r for r in line_dedup.remove_repeated_chunks(df, staging).collect()}
    assert all(out[n].text == t for n, t in docs if n % 2 == 0)
    left = [n for n, p in hosts if p in out[n].text]
    first = {p: min(n for n, q in hosts if q == p) for _, p in hosts}
    assert set(first.values()) <= set(left)
    assert len(left) == len(first)
    own = {n: t for n, t in docs}
    whole = [out[n].text.split() == own[n].replace(p, " ").split() for n, p in hosts if n not in left]
    assert sum(whole) >= 0.97 * len(whole)


def test_near_copies_can_stay(spark, staging):
    draw = random.Random(6)
    own = [sentence(draw, 9) for _ in range(20)]
    near = [*own[:9], sentence(draw, 9), *own[10:]]
    host = [sentence(draw, 9) for _ in range(20)] + own[:8]
    docs = [(1, own), (2, own), (3, near), (4, host)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    stay = line_dedup.remove_repeated_chunks(df, staging, leave_copies=0.8).orderBy("doc_id").collect()
    assert [r.text for r in stay[:3]] == [" ".join(t) for _, t in docs[:3]]
    assert stay[3].text.split() == " ".join(host[:20]).split()
    gone = line_dedup.remove_repeated_chunks(df, staging).orderBy("doc_id").collect()
    assert [r.text.split() for r in gone[1:3]] == [[], near[9].split()]


def test_hash_clashes_are_told_apart(spark, staging, monkeypatch):
    """With a hash that tells nothing, bytes alone decide."""
    monkeypatch.setattr(line_dedup, "line_hashes", lambda u: F.transform(u, lambda x: F.length(x).cast("long") * 0 + 7 * 128 + 50))
    texts = ["A b c d e f g h. I j k l m n.", "Q r s t u v w x. Y z a b c d.", "A b c d e f g h. I j k l m n."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in line_dedup.remove_repeated_chunks(df, staging).orderBy("doc_id").collect()]
    assert out == [texts[0], texts[1], ""]


def test_awkward_rows(spark, staging):
    docs = cases.awkward(spark, True)
    rows = line_dedup.remove_repeated_chunks(docs, staging)
    assert rows.columns == [*docs.columns, "lines_removed", "chars_removed"]
    want = [(i, t) for i, t, *_ in cases.AWKWARD]
    want[1] = (2, "")
    assert cases.same_rows([(r.doc_id, r.text) for r in rows.collect()], want)
    assert line_dedup.remove_repeated_chunks(cases.empty(spark), staging).count() == 0


def generators(plan):
    children = plan.children()
    below = [g for i in range(children.size()) for g in generators(children.apply(i))]
    return [plan] * (plan.nodeName() == "Generate") + below


def test_chunks_carry_no_text(spark, staging, monkeypatch):
    """A text with n chunks must not be copied n times to tell its size."""
    carried, write = [], DataFrameWriter.parquet

    def seen(writer, path, *args, **kwargs):
        if "chunk-places" in path:
            plan = writer._df._jdf.queryExecution().sparkPlan()
            carried.extend(g.requiredChildOutput().mkString(" ") for g in generators(plan))
        write(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    line_dedup.remove_repeated_chunks(cases.awkward(spark), staging)
    assert len(carried) == 1 and "_doc#" in carried[0] and "_body#" not in carried[0]
