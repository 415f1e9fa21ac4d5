"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
BREAK = "\n"
SHORT = 48
NEVER = float("inf")


class MismatchError(RuntimeError):
    """The agenda and the sentencepiece library disagree."""


class Codec:
    """One vocabulary. ``encode`` merges adjacent symbols by a score-ordered agenda.

    Merges can't cross a place that no piece spans. Where the vocabulary has no piece
    with a space mark after another character, and none that joins a line break to
    another character, a text is cut at those places, and the ids of a segment (a word)
    are kept for its next use; a vocabulary that has such pieces is applied to whole
    texts. At most twice ``keep`` segments are kept.
    """

    def __init__(self, model: str, keep: int = 400_000) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_file=model)
        size = lib.get_piece_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) for i in range(size)]
        plain = [i for i in range(size) if not special[i] and not lib.is_byte(i)]
        self._id = {lib.id_to_piece(i): i for i in plain}
        self._rank = {p: -lib.get_score(i) for p, i in self._id.items()}
        self._byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(size) if lib.is_byte(i)}
        self._byte_of = {i: b for b, i in self._byte.items()}
        self._packed = {p: i.to_bytes(4, "little") for p, i in self._id.items()}
        self._ends = lib.bos_id(), lib.eos_id()
        self._unknown = lib.unk_id()
        self._shown = [" " + chr(0x2047) + " " if i == self._unknown else "" for i in range(size)]
        for piece, i in self._id.items():
            self._shown[i] = piece.replace(SPACE, " ")
        # What the library makes of plain characters before it merges.
        probe = " a  b\tc\nd "
        want = SPACE + probe.replace(" ", SPACE)
        self._plain_rules = "".join(lib.encode_as_pieces("a  b ")).startswith(SPACE) and (
            lib.normalize(probe) == want if hasattr(lib, "normalize") else True
        )
        self.cuts = not any(
            re.search(f"[^{SPACE}]{SPACE}", p) or (BREAK in p and len(p) > 1) for p in self._id
        )
        self._kept = _Kept(self._segment, keep)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text with begin and end ids, as unsigned 32-bit integers."""
        return np.frombuffer(self.encode_bytes(text), dtype="<u4")

    def encode_bytes(self, text: str) -> bytes:
        body = b""
        if text:
            marked = SPACE + text.replace(" ", SPACE)
            get = self._kept.__getitem__
            if not self.cuts:
                body = self._segment(marked)
            elif SPACE + SPACE in marked or BREAK in marked:
                body = b"".join(map(get, re.findall(f"{BREAK}|{SPACE}+[^{SPACE}{BREAK}]*|[^{SPACE}{BREAK}]+", marked)))
            else:
                body = b"".join([get(SPACE + w) for w in marked[1:].split(SPACE)])
        begin, end = (i.to_bytes(4, "little") for i in self._ends)
        return begin + body + end

    def _segment(self, segment: str) -> bytes:
        """The agenda: the best-scored pair of neighbours is merged, the leftmost of
        equals first, and the merged symbol's two new pairs join the agenda. Up to
        ``SHORT`` symbols it is a list that is searched, beyond that a heap."""
        merge = self._merge_short if len(segment) <= SHORT else self._merge_long
        try:
            return b"".join([self._packed[s] for s in merge(segment)])
        except KeyError:
            return b"".join([self._packed.get(s) or self._spelled(s) for s in merge(segment)])

    def _spelled(self, symbol: str) -> bytes:
        ids = [self._byte[b] for b in symbol.encode()] if self._byte else [self._unknown]
        return np.array(ids, dtype="<u4").tobytes()

    def _merge_short(self, segment: str) -> list[str]:
        rank = self._rank.get
        symbols = list(segment)
        agenda = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], NEVER)
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def _merge_long(self, segment: str) -> Iterator[str]:
        rank = self._rank
        symbols = list(segment)
        n = len(symbols)
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                agenda.append((rank[pair], i, i + 1, pair))
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            _, i, j, pair = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or after[i] != j or symbols[i] + symbols[j] != pair:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = pair, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                new = pair + symbols[k]
                if new in rank:
                    heapq.heappush(agenda, (rank[new], i, k, new))
            h = before[i]
            if h >= 0:
                new = symbols[h] + pair
                if new in rank:
                    heapq.heappush(agenda, (rank[new], h, i, new))
        return filter(None, symbols)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, space marks shown as spaces, the mark put
        before the text taken away, runs of byte pieces read as UTF-8."""
        out, run = [], bytearray()
        byte_of, shown = self._byte_of, self._shown
        for i in ids.tolist():
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                out.append(_utf8(run))
                run.clear()
            out.append(shown[i])
        out.append(_utf8(run))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text

    def check(self, texts: list[str], coded: list[bytes]) -> None:
        """Compare with the library: whole texts that hold anything rare, and every
        segment that a batch met for the first time."""
        rare = [i for i, t in enumerate(texts) if not self.cuts or not self._plain_rules or _RARE.search(t)]
        self._same([texts[i] for i in rare], [coded[i] for i in rare])
        # A segment without its own space mark is encoded behind a line break.
        fresh = self._kept.take_fresh()
        shown = [(s[1:] if s[0] == SPACE else BREAK + s, v) for s, v in fresh if s != BREAK]
        head = self._segment(SPACE) + self._segment(BREAK)
        begin, end = (i.to_bytes(4, "little") for i in self._ends)
        self._same(
            [t.replace(SPACE, " ") for t, _ in shown],
            [begin + (head if t[:1] == BREAK else b"") + v + end for t, v in shown],
        )

    def _same(self, texts: list[str], coded: list[bytes]) -> None:
        wanted = self.library.encode(texts, add_bos=True, add_eos=True, num_threads=1) if texts else []
        for text, ids, own in zip(texts, wanted, coded, strict=True):
            if text and np.array(ids, dtype="<u4").tobytes() != own:
                raise MismatchError(f"the library encodes {text[:80]!r} otherwise")


# Anything but Latin-1 letters, single spaces and line breaks.
_RARE = re.compile("[^\n\x20-\x7e\xa1-\xff]|  |^ | $")


def _utf8(run: bytearray) -> str:
    """UTF-8, each byte that is no part of a character shown as U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for width in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[at : at + width]).decode())
                    at += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


class _Kept(dict):
    """Segments with their ids, in two generations: when the younger is full, it becomes
    the older, and what is used again moves back. Remembers the fresh segments."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self._make, self._most, self._fresh, self._older = make, most, [], {}

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        made = self._older.get(segment)
        if made is None:
            made = self._make(segment)
            self._fresh.append((segment, made))
        self[segment] = made
        return made

    def take_fresh(self) -> list[tuple[str, bytes]]:
        fresh, self._fresh = self._fresh, []
        return fresh


@lru_cache(maxsize=1)
def _codec(model: str) -> Codec:
    return Codec(model)


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids of every whole text, little-endian
    unsigned 32-bit, with begin and end ids, and the text that they decode to.

    Every Arrow batch is checked against the sentencepiece library and the job fails on
    any difference. A NULL text is empty and has just the two end ids. NULL doc_ids
    and repeated rows are kept; an empty table gives no rows; other columns are ignored.
    """
    schema = "doc_id long, n_tokens long, ids binary, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part["text"].to_pylist()
                coded = [codec.encode_bytes(t) for t in texts]
                codec.check(texts, coded)
                decoded = [codec.decode(np.frombuffer(c, dtype="<u4")) for c in coded]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array([len(c) // 4 for c in coded], type=pa.int64()),
                        pa.array(coded, type=pa.binary()),
                        pa.array(decoded, type=pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return slim.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, model: str) -> DataFrame:
    """``encode_documents`` with SHA-256 digests in place of ids and texts."""
    coded = encode_documents(docs, model)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
