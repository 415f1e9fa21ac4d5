from __future__ import annotations

import random
import re

import cases
import xxhash

from siltgate.llm import simhash_dedup
from siltgate.llm.common import components


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    bits = [sum(h >> b & 1 for h in hashes) * 2 > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on)


def test_fingerprint():
    for _, text, *_ in cases.AWKWARD:
        assert simhash_dedup.fingerprint(text or "") % (1 << 64) == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_join_what_all_pairs_join(spark, staging):
    draw = random.Random(11)
    fps = {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    while len(fps) < 600:
        x = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 6)):  # chains at 1 to 4 bits
            fps.add(x)
            for b in draw.sample(range(64), draw.randrange(1, 5)):
                x ^= 1 << b
    fps = sorted(fps)
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    found = simhash_dedup.links(df, staging).collect()
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 3 for r in found)
    own = cases.closure([signed(x) for x in fps], [(r.a, r.b) for r in found])
    want = cases.closure([signed(x) for x in fps], [(signed(a), signed(b)) for a, b in near])
    assert own == want and len(near) > 200


def test_components_of_a_path_and_a_star(spark, staging):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    rows = {r.node: r.root for r in components(df, staging).collect()}
    assert rows == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_documents(spark, staging):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    links = [
        (i, j) for n, (i, x) in enumerate(fps) for j, y in fps[:n] if (x ^ y).bit_count() <= 3
    ]
    root = cases.closure([i for i, _ in fps], links)
    found = simhash_dedup.near_duplicates(docs, staging).collect()
    assert cases.same_rows(found, [(i, signed(x), root[i]) for i, x in fps])
    assert any(i != r for i, r in root.items())


def test_awkward_rows(spark, staging):
    rows = simhash_dedup.near_duplicates(cases.awkward(spark, True), staging).collect()
    assert len(rows) == len(cases.AWKWARD)
    of = {(r.doc_id, r.fp): r.component_id for r in rows}
    assert {of[(i, 0)] for i in (3, 4, 5)} == {3}
    assert of[(2, signed(plain_fingerprint(cases.AWKWARD[0][1])))] == 1
    assert of[(None, signed(plain_fingerprint("no id here at all")))] is None
    assert simhash_dedup.near_duplicates(cases.empty(spark), staging).count() == 0


def plain_likeness(a, b, words=5):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else {()}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_near_copies_are_found_and_no_others(spark, staging):
    """Copies of 0 to 12 changed words among 200, and texts that share half."""
    draw = random.Random(3)
    docs = []
    for g in range(120):
        base = [f"w{draw.randrange(500)}" for _ in range(200)]
        for c in range(4):
            words = list(base) if c < 3 else base[:100] + [f"w{draw.randrange(500)}" for _ in range(100)]
            for _ in range(0 if c in (0, 3) else draw.randrange(7)):
                words[draw.randrange(200)] = f"x{draw.randrange(10**6)}"
            docs.append((g * 4 + c, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_copies(df, staging).collect()}
    text = dict(docs)
    alike = [
        (a, b) for g in range(120) for a in range(4 * g, 4 * g + 4) for b in range(4 * g, a)
        if plain_likeness(text[a], text[b]) >= 0.8
    ]
    root = cases.closure(list(text), alike)
    assert len(alike) > 150
    found = sum(got[a] == got[b] for a, b in alike)
    assert found >= 0.93 * len(alike)
    assert all(root[i] == root[c] for i, c in got.items())


def test_near_copies_of_awkward_rows(spark, staging):
    rows = simhash_dedup.near_copies(cases.awkward(spark, True), staging).collect()
    ids = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(cases.AWKWARD) and ids[2] == ids[1] == 1 and ids[3] == ids[4] == ids[5] == 3
    assert ids[None] is None and ids[6] == 6 and ids[-5] == -5
    assert simhash_dedup.near_copies(cases.empty(spark), staging).count() == 0


def test_copies_between_the_ends_of_crowded_keys_are_found(spark, staging, monkeypatch):
    """Two copies whose only fingerprint part is that of other texts too, of which none is
    alike: the others hold the least and the greatest node of every key."""
    draw = random.Random(4)
    base = [f"w{k}" for k in range(60)]

    def part(words):
        return simhash_dedup.wide_fingerprint(simhash_dedup.shingle_hashes(" ".join(words), 5), 1)[0]

    def made(change):
        while True:
            words = change([f"x{draw.randrange(10**9)}" for _ in range(8)])
            if part(words) == part(base):
                return " ".join(words)

    def node(text):
        return signed(xxhash.xxh64_intdigest(text.encode(), 7))

    others = [made(lambda new: base[:52] + new) for _ in range(14)]
    ends = min(map(node, others)), max(map(node, others))
    copies = []
    while len(copies) < 6:
        text = made(lambda new: new[:2] + base[2:])
        if ends[0] < node(text) < ends[1]:
            copies.append(text)
    docs = list(enumerate(others + copies))
    alike = [(i, j) for i, x in docs for j, y in docs if i < j and plain_likeness(x, y) >= 0.8]
    root = cases.closure(range(20), alike)
    assert len(alike) == 15 and set(root.values()) == set(range(15))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for block in (256, 2):
        monkeypatch.setattr(simhash_dedup, "BLOCK", block)
        rows = simhash_dedup.near_copies(df, staging, parts=1).collect()
        assert {r.doc_id: r.component_id for r in rows} == root
