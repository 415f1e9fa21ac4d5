"""Order-preserving packing of documents into sequences by dynamic programming."""

from __future__ import annotations

import base64
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Latin-1 letters are the same in every Unicode version, so that both tokenizer
# libraries split such texts alike; see tests/llm/test_packing.py for the ids.
FAST_ENCODING = "latin-1"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Encoder:
    """Ids of a byte-level BPE vocabulary, as the tokenizers library gives them.

    Texts within Latin-1 go through tiktoken with the same vocabulary, three times as
    fast. It merges any two neighbours that form a known token, the library only
    listed pairs; the ids are the same where every token of the vocabulary encodes to
    itself, because then a token's last two parts are always its listed pair.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(vocabulary)
        self._exact.encode_special_tokens = True
        self._fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self._fast = tiktoken.Encoding(
                "packing", pat_str=pattern, mergeable_ranks=table, special_tokens={}
            )
        size = self._exact.get_vocab_size()
        ends = (self._exact.decode([i]).rstrip(" \"')]") for i in range(size))
        self.sentence_end = np.array([t.endswith((".", "!", "?", "\n")) for t in ends])

    def ids(self, text: str) -> np.ndarray:
        if self._fast is not None:
            try:
                text.encode(FAST_ENCODING)
                return self._fast.encode_to_numpy(text, disallowed_special=())
            except UnicodeEncodeError:
                pass
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@lru_cache(maxsize=1)
def _encoder(vocabulary: str, ranks: str | None, pattern: str | None) -> Encoder:
    return Encoder(vocabulary, ranks, pattern)


def choose_cuts(
    places: np.ndarray, penalties: np.ndarray, window: int, free_lengths: tuple[int, ...]
) -> list[int]:
    """The cuts of least cost, as indexes into ``places``; the first and last are cut.

    ``places`` rise from 0 and lie at most ``window`` apart. A window between two cuts
    costs the tokens it lacks, none at a ``free_lengths`` length, plus the penalty of
    the cut that ends it. With best[j] the least cost up to place j, a padded window
    costs best[i] - places[j] + (places[i] + window), so the best start is the least
    best[i] + places[i] of the last ``window`` tokens: a queue that holds its
    candidates in rising order gives it in constant time. Ties take the longer window.
    """
    at = places.tolist()
    cost = penalties.tolist()
    n = len(at)
    index = {p: i for i, p in enumerate(at)}
    best, source, keys = [0.0] * n, [0] * n, [0.0] * n
    queue: deque[int] = deque([0])
    for j in range(1, n):
        here = at[j]
        while here - at[queue[0]] > window:
            queue.popleft()
        i = queue[0]
        least, start = keys[i] + window - here, i
        for length in free_lengths:
            k = index.get(here - length)
            if k is not None and best[k] < least:
                least, start = best[k], k
        best[j] = least + cost[j]
        source[j] = start
        keys[j] = key = best[j] + here
        while queue and keys[queue[-1]] > key:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(source[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Packs a stream of documents block by block; ``flush`` gives the pieces' columns."""

    def __init__(
        self, encoder: Encoder, window: int, end_id: int, block: int, first: int, penalties: tuple[float, float]
    ) -> None:
        self._encoder, self._window, self._end, self._block = encoder, window, end_id, block
        self._sentence_cost, self._hard_cost = penalties
        self._next = first
        self._held: list[tuple[object, int, np.ndarray, int]] = []  # doc, start, ids, all ids
        self._tokens = 0
        powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
        self._free = tuple(reversed(powers))

    def add(self, doc: object, text: str) -> Iterator[dict[str, list]]:
        ids = np.append(self._encoder.ids(text).astype(np.uint32), np.uint32(self._end))
        self._held.append((doc, 0, ids, len(ids)))
        self._tokens += len(ids)
        while self._tokens >= self._block:
            yield self._pack(last=False)

    def flush(self) -> Iterator[dict[str, list]]:
        if self._tokens:
            yield self._pack(last=True)

    def _pack(self, last: bool) -> dict[str, list]:
        """Cuts of what is held. Unless it is the last block, the final two windows are
        held back, so that no block ends in padding."""
        stream = np.concatenate([h[2] for h in self._held])
        ends = np.cumsum([len(h[2]) for h in self._held])
        total = len(stream)
        penalty = np.full(total + 1, np.inf)
        penalty[1:][self._encoder.sentence_end[stream]] = self._sentence_cost
        penalty[ends[:-1]] = 0.0
        penalty[0] = penalty[total] = 0.0
        allowed = np.flatnonzero(penalty < np.inf)
        gaps = np.flatnonzero(np.diff(allowed) > self._window)
        if len(gaps):  # a sentence longer than a window is cut anywhere
            hard = np.concatenate([np.arange(allowed[g] + 1, allowed[g + 1]) for g in gaps])
            penalty[hard] = self._hard_cost
            allowed = np.flatnonzero(penalty < np.inf)
        chosen = choose_cuts(allowed, penalty[allowed], self._window, self._free)
        cuts = allowed[chosen]
        if not last and len(cuts) > 4:
            cuts = cuts[:-2]
        out: dict[str, list] = {c: [] for c in PIECES.replace(" long", "").split(", ")}
        doc, at = 0, 0  # the held document, and the place in the stream where it begins
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            place = low
            while place < high:
                key, start, ids, all_ids = self._held[doc]
                length = min(high, at + len(ids)) - place
                piece = ids[place - at : place - at + length]
                values = (
                    key, start + place - at, length, zlib.crc32(piece.astype("<u4").tobytes()),
                    all_ids, self._next, place - low,
                )
                for column, value in zip(out.values(), values, strict=True):
                    column.append(value)
                place += length
                if place == at + len(ids):
                    at, doc = place, doc + 1
            self._next += 1
        done = int(cuts[-1])
        rest = self._held[doc:]
        if rest and done > at:
            key, start, ids, all_ids = rest[0]
            rest[0] = (key, start + done - at, ids[done - at :], all_ids)
        self._held, self._tokens = rest, total - done
        return out


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    pattern: str | None = None,
    window: int = 2048,
    end_id: int = 1,
    block: int = 1 << 18,
    sentence_cost: float = 0.5,
    hard_cost: float = 16.0,
) -> DataFrame:
    """Pieces of documents in windows of at most ``window`` tokens; see ``PIECES``.

    Documents keep their order by doc_id, then a hash of their text, then their place in
    ``docs``. They are dealt out by ranges of the three, so that rows of one doc_id, or
    copies of one row, may be any number; each partition is one stream that is packed in
    blocks of ``block`` tokens, so memory is bounded whatever a document's length. A cut costs nothing at a
    document's end, ``sentence_cost`` at a sentence's end, and ``hard_cost`` elsewhere;
    the last is allowed only within a sentence longer than a window. A NULL text is
    empty and packs as its end id alone; a NULL doc_id stays NULL; repeated rows are
    packed one by one; an empty table gives no pieces; other columns are ignored.
    Sequence ids are unique: the partition's number times 2**40, then counted from 0.
    """
    ordered = (
        docs.select(
            "doc_id",
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
            F.xxhash64("text").alias("_hash"),
            F.monotonically_increasing_id().alias("_place"),
        )
        .repartitionByRange("doc_id", "_hash", "_place")
        .sortWithinPartitions("doc_id", "_hash", "_place")
        .select("doc_id", "text")
    )
    names = PIECES.replace(" long", "").split(", ")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, ranks, pattern)
        first = TaskContext.get().partitionId() << 40
        packer = Packer(encoder, window, end_id, block, first, (sentence_cost, hard_cost))

        def rows(columns: dict[str, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[n], type=pa.int64()) for n in names], names=names
            )

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                for columns in packer.add(doc.as_py(), text.as_py()):
                    yield rows(columns)
        for columns in packer.flush():
            yield rows(columns)

    return ordered.mapInArrow(pack, PIECES)
