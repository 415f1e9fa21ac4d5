from __future__ import annotations

import hashlib
import random

import cases
import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from siltgate.llm import piece_codec

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "a  b ", " a", "\n", "a\n\n b", "日本語 x", "▁a", "a▁▁b", "\x00a",
    "<s> </s>", "<0x0A>", "😀😀 a", "\t\ta", " ", "�", "a\r\nb", "　", "ﬁ", "x" * 500,
]


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec(MODEL)


def test_same_as_the_library(codec):
    lib = SentencePieceProcessor(model_file=MODEL)
    draw = random.Random(4)
    random_texts = ["".join(draw.choices(" \n.aeorstné日😀▁", k=60)) for _ in range(300)]
    for text in [*ODD, *random_texts, cases.LONG[:5000]]:
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text).tolist() == ids, text
        assert codec.decode(np.array(ids, dtype=np.uint32)) == lib.decode(ids), text
    for _ in range(300):
        ids = [draw.randrange(32000) if draw.random() < 0.5 else draw.randrange(300) for _ in range(8)]
        assert codec.decode(np.array(ids, dtype=np.uint32)) == lib.decode(ids)


def test_short_and_long_agendas_agree(codec):
    draw = random.Random(5)
    for _ in range(200):
        text = "".join(draw.choices("abcdehinorst▁", k=draw.randrange(1, 40)))
        assert list(codec._merge_long(text)) == codec._merge_short(text)


def test_a_difference_fails(codec):
    with pytest.raises(piece_codec.MismatchError):
        codec._same(["some text"], [b"\x01\x00\x00\x00"])


def test_awkward_rows(spark):
    lib = SentencePieceProcessor(model_file=MODEL)
    rows = piece_codec.digest_documents(cases.awkward(spark, True), MODEL).collect()
    want = []
    for doc_id, text, *_ in cases.AWKWARD:
        ids = lib.encode(text or "", add_bos=True, add_eos=True)
        packed = np.array(ids, dtype="<u4").tobytes()
        digests = [hashlib.sha256(x).hexdigest() for x in (packed, lib.decode(ids).encode())]
        want.append((doc_id, len(ids), *digests))
    assert cases.same_rows(rows, want)
    assert piece_codec.digest_documents(cases.empty(spark), MODEL).count() == 0
