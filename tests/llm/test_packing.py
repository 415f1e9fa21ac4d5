from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltgate.llm import packing
from siltgate.llm.queries import packed

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(
        VOCABULARY, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def test_every_token_encodes_to_itself(library, encoder):
    """What makes the two libraries agree: see ``Encoder``."""
    texts = {i: library.decode([i]) for i in range(50_256)}
    whole = {i: t for i, t in texts.items() if "�" not in t}
    got = library.encode_batch(list(whole.values()), add_special_tokens=False)
    odd = [i for i, e in zip(whole, got, strict=True) if e.ids != [i]]
    assert len(odd) < 20
    for i in odd:  # tokens that no text gives: the libraries agree on their text
        assert encoder._fast.encode_ordinary(whole[i]) == library.encode(whole[i], add_special_tokens=False).ids


def test_ids_equal_the_library(spark, library, encoder):
    draw = random.Random(9)
    latin = [chr(c) for c in range(256)]
    texts = ["".join(draw.choices(latin, k=80)) for _ in range(400)]
    texts += ["".join(draw.choices("aeinrst ABC.'\n  ", k=120)) for _ in range(400)]
    texts += [t or "" for _, t, *_ in cases.AWKWARD] + ["<|endoftext|> x"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    texts += [r.text for r in docs.collect()]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def cost(places, penalties, window, free, cuts):
    total = 0.0
    for i, j in zip(cuts, cuts[1:], strict=False):
        length = places[j] - places[i]
        if length > window:
            return float("inf")
        total += (0 if length in free else window - length) + penalties[j]
    return total


def test_cuts_are_the_best():
    draw = random.Random(2)
    for _ in range(300):
        window = draw.choice([8, 10, 16])
        gaps = [draw.randrange(1, window + 1) for _ in range(draw.randrange(1, 10))]
        places = np.array([0, *itertools.accumulate(gaps)])
        penalties = np.array([0, *[draw.choice([0.0, 0.5, 3.0]) for _ in gaps]])
        free = tuple(1 << k for k in range(5) if 1 << k < window)
        cuts = packing.choose_cuts(places, penalties, window, free)
        inner = range(1, len(places) - 1)
        best = min(
            cost(places, penalties, window, free, [0, *middle, len(places) - 1])
            for n in range(len(places) - 1)
            for middle in itertools.combinations(inner, n)
        )
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1
        assert cost(places, penalties, window, free, cuts) == best


def check(rows, docs, library):
    """Each id of each document in one piece, at its place; windows whole and gapless."""
    ids_of = defaultdict(list)
    for doc_id, text, *_ in docs:
        ids_of[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    pieces = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids_of)
    for doc_id, texts in ids_of.items():
        assert sum(r.length for r in pieces[doc_id]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces[doc_id], key=lambda r: r.start):
                piece = np.array(texts[0][r.start : r.start + r.length], dtype="<u4")
                assert r.start == at and r.ids_crc32 == zlib.crc32(piece.tobytes())
                assert r.doc_tokens == len(texts[0])
                at += r.length
    tokens = padding = 0
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= 2048
        tokens += end
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    return padding / (tokens + padding)


def test_given_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    share = check(packed(docs).collect(), [(d.doc_id, d.text) for d in docs.collect()], library)
    assert share < 0.02


def test_blocks_carry_over(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    rows = packing.pack_documents(docs, VOCABULARY, block=9_000).collect()
    check(rows, [(d.doc_id, d.text) for d in docs.collect()], library)


def test_awkward_rows(spark, library):
    check(packed(cases.awkward(spark, True)).collect(), cases.AWKWARD, library)
    assert packed(cases.empty(spark)).count() == 0
    no_cut = [(1, "x1y2" * 4_000, None, None, None)]
    check(packed(spark.createDataFrame(no_cut, cases.DOCS)).collect(), no_cut, library)


def test_a_third_of_the_rows_alike_are_dealt_out(spark):
    rows = [(7, "copy of one document.")] * 600 + [(n, f"text {n} of its own.") for n in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    coalesced = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesced, "false")
    try:
        pieces = packed(df).collect()
    finally:
        spark.conf.unset(coalesced)
    begins = [r for r in pieces if r.start == 0]
    assert len(begins) == len(rows)
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in begins)
    copies = Counter(r.sequence_id >> 40 for r in begins if r.doc_id == 7)
    assert len(copies) > 1 and max(copies.values()) < 400
