"""Removal of repeated word windows by super-k-mer partitioning."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import maybe_in
from siltgate.sources.staging import Staging

WINDOW = 50  # words of a window
GRAM = 8  # words of the grams of which a window's least hash is its minimiser
CHUNK_BYTES = 2_000_000  # of text that is cut, or ranked, at a time
FILTER_BITS = 1 << 25  # most bits of the filter of repeated minimisers: 4 MB
SPLIT_ABOVE = 1_000  # different strings of a minimiser from which its windows go singly

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

# What cut() makes of a super-k-mer, its key and owner aside.
SUPERS = "mini long, sid binary, packed binary, doc long, text long, start int"
RUNS = "sid binary, s int, e int, least long"


def _chunks(batches: Iterator[pa.RecordBatch], size: str) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose values of ``size`` come to about CHUNK_BYTES of bytes."""
    for batch in batches:
        ends = np.cumsum(pa.compute.binary_length(batch.column(size)).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _coded(lists: list[list[bytes]]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all lists as numbers, and the words by number."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    total = sum(map(len, lists))
    get = number.__getitem__
    return np.fromiter((get(w) for words in lists for w in words), dtype=np.int64, count=total), list(number)


def window_minimisers(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The least gram hash of each window of consecutive word hashes; windows that reach
    over the end of the array are left out."""
    n = len(hashes)
    if n < window:
        return np.empty(0, dtype=np.uint64)
    grams = np.zeros(n - gram + 1, dtype=np.uint64)
    for j in range(gram):
        grams = (grams + hashes[j : n - gram + 1 + j]) * _ODD
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX
    grams ^= grams >> np.uint64(32)
    wide, size = grams, 1
    many = window - gram + 1
    while size * 2 <= many:
        wide, size = np.minimum(wide[:-size], wide[size:]), size * 2
    rest = many - size
    return np.minimum(wide[: len(wide) - rest], wide[rest:]) if rest else wide


def super_kmers(lists: list[list[bytes]], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(list, start, windows, minimiser) of each longest run of a list's consecutive
    windows whose minimisers are equal."""
    coded, distinct = _coded(lists)
    table = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(distinct))
    minis = window_minimisers(table[coded], window, gram)
    sizes = np.array([len(words) for words in lists], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - (window - 1), 0)
    owner = np.repeat(np.arange(len(lists)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    minis = minis[begins[owner] + inside]
    if not len(minis):
        return owner, inside, owner, minis.view(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (minis[1:] != minis[:-1]) | (owner[1:] != owner[:-1])]))
    counts = np.diff(np.append(new, len(minis)))
    return owner[new], inside[new], counts, minis[new].view(np.int64)


def _split(texts: pa.Array) -> list[list[bytes]]:
    return [text.split() for text in texts.to_pylist()]  # bytes: at spaces and \t to \r only


def _minimisers(window: int, gram: int) -> Callable:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, "body"):
            owner, _, _, minis = super_kmers(_split(chunk.column("body")), window, gram)
            docs = chunk.column("doc").to_numpy()[owner]
            rows = pd.DataFrame({"mini": minis, "low": docs, "high": docs})
            folded = rows.groupby("mini", as_index=False).agg({"low": "min", "high": "max"})
            yield pa.RecordBatch.from_pandas(folded, preserve_index=False)

    return found


def _cut(window: int, gram: int, bits: np.ndarray) -> Callable:
    """Super-k-mers whose minimiser may be repeated, each as one packed string."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, "body"):
            lists = _split(chunk.column("body"))
            owner, start, windows, minis = super_kmers(lists, window, gram)
            slot = minis & (len(bits) * 64 - 1)
            maybe = np.flatnonzero((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))
            packed = [
                b" ".join(lists[o][s : s + n])
                for o, s, n in zip(
                    owner[maybe].tolist(),
                    start[maybe].tolist(),
                    (windows[maybe] + (window - 1)).tolist(),
                    strict=True,
                )
            ]
            columns = {
                "mini": minis[maybe],
                "sid": [hashlib.blake2b(p, digest_size=16).digest() for p in packed],
                "packed": pa.array(packed, pa.binary()),
                "doc": chunk.column("doc").to_numpy()[owner[maybe]],
                "text": chunk.column("text").to_numpy()[owner[maybe]],
                "start": pa.array(start[maybe], pa.int32()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return found


def window_classes(coded: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the windows of consecutive words, equal where all their words are. Ranks
    of runs of 1, 2, 4, ... words come from sorting pairs of ranks, so nothing is hashed."""
    rank, size = coded, 1
    while size < window:
        step = min(size, window - size)
        pairs = rank[: len(rank) - step] * (int(rank.max(initial=0)) + 1) + rank[step:]
        rank, size = np.unique(pairs, return_inverse=True)[1], size + step
    return rank


def _rank(rows: list[tuple[bytes, bytes, int, int]], window: int) -> pa.RecordBatch:
    """Runs of windows of strings (sid, packed, least and greatest doc_id) that a smaller
    doc_id than the greatest also has."""
    lists = [packed.split(b" ") for _, packed, _, _ in rows]
    classes = window_classes(_coded(lists)[0], window)
    sizes = np.array([len(words) for words in lists])
    windows = sizes - (window - 1)
    string = np.repeat(np.arange(len(lists)), windows)
    inside = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    classes = classes[(np.cumsum(sizes) - sizes)[string] + inside]
    low, high = (np.array([row[i] for row in rows], dtype=np.int64) for i in (2, 3))
    order = np.argsort(classes, kind="stable")
    new = np.flatnonzero(np.diff(classes[order], prepend=-1))
    least = np.empty(len(classes), dtype=np.int64)
    groups = np.diff(np.append(new, len(order)))
    least[order] = np.repeat(np.minimum.reduceat(low[string[order]], new), groups)
    seen = np.flatnonzero(least < high[string])
    string, inside, least = string[seen], inside[seen], least[seen]
    breaks = (np.diff(seen) != 1) | (np.diff(string) != 0) | (np.diff(least) != 0)
    first = np.flatnonzero(np.concatenate([[True], breaks])) if len(seen) else seen
    last = np.append(first[1:], len(seen)) - 1 if len(seen) else seen
    columns = {
        "sid": pa.array([rows[i][0] for i in string[first].tolist()], pa.binary()),
        "s": pa.array(inside[first], pa.int32()),
        "e": pa.array(inside[last] + window, pa.int32()),
        "least": pa.array(least[first], pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _rank_buckets(window: int) -> Callable:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their minimiser; whole minimisers are ranked together."""
        held: list[tuple] = []
        size, before = 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("mini", "sid", "packed", "low", "high"))
            for mini, *row in zip(*columns, strict=True):
                if mini != before and size > CHUNK_BYTES:
                    yield _rank(held, window)
                    held, size = [], 0
                before = mini
                held.append(tuple(row))
                size += len(row[1])
        if held:
            yield _rank(held, window)

    return found


def _single_windows(window: int) -> Callable:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, "packed"):
            for sid, packed, low, high in zip(
                *(chunk.column(c).to_pylist() for c in ("sid", "packed", "low", "high")), strict=True
            ):
                words = packed.split(b" ")
                n = len(words) - window + 1
                columns = {
                    "sid": [sid] * n,
                    "s": pa.array(range(n), pa.int32()),
                    "low": [low] * n,
                    "high": [high] * n,
                    "words": [b" ".join(words[i : i + window]) for i in range(n)],
                }
                yield pa.RecordBatch.from_pydict(columns)

    return found


def _runs_of_hot(strings: DataFrame, window: int, staging: Staging) -> DataFrame:
    """The runs of minimisers with many different strings, window by window: the windows
    that they share fold on the map side, all others differ and spread."""
    made = strings.mapInArrow(_single_windows(window), "sid binary, s int, low long, high long, words binary")
    singles = staging.table(made.withColumn("window", F.unhex(F.sha2("words", 256))).drop("words"), "windows")
    least = singles.groupBy("window").agg(F.min("low").alias("least"), F.max("high").alias("most"))
    least = least.filter("least < most").select(F.col("window").alias("_window"), "least")
    found = singles.join(least, F.col("window").eqNullSafe(F.col("_window"))).filter("least < high")
    return found.select("sid", "s", (F.col("s") + window).alias("e"), "least")


def _filter_bits(keys: DataFrame, count: int) -> np.ndarray:
    """A bit for each key's low bits, 16 bits a key up to FILTER_BITS, which bounds what is
    collected; beyond that more super-k-mers travel, and nothing else changes."""
    size = min(FILTER_BITS, 1 << max(10, (16 * count - 1).bit_length()))
    slot = F.col("mini").bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(F.shiftright(slot, 6).alias("at"), bit.alias("bit")).groupBy("at")
    found = words.agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[found["at"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits


def repeated_spans(
    bodies: DataFrame,
    staging: Staging,
    window: int = WINDOW,
    gram: int = GRAM,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """(doc, text, s, e): stretches of words, numbered from 0, of which every window also
    occurs under a smaller doc. ``bodies`` has (doc long, text long, body binary).

    1. Every text is cut into super-k-mers, runs of consecutive windows with one
       minimiser, the least hash of the window's grams. Minimisers fold to their least
       and greatest doc on the map side; one that occurs under one doc only has no
       repeated window. The others make a bit filter of bounded size.
    2. Super-k-mers that pass it are stored, each as one packed string, and equal
       strings fold on the map side. Different ones meet in the bucket of their
       minimiser, where sorting ranks the windows and tells the least doc of each.
    3. A minimiser with more than ``split_above`` different strings, as a passage in a
       third of all documents has at either end, is taken window by window: what the
       strings share folds before it moves.
    4. Runs go back to the places of their strings by the string's 128-bit digest. A
       frequent string's places are the large side of a join that adaptive execution
       can split, as its other side is stored.
    """
    minis = bodies.mapInArrow(_minimisers(window, gram), "mini long, low long, high long")
    shared = minis.groupBy("mini").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    repeated = staging.table(shared.filter("low < high").select("mini"), "minimisers")
    bits = _filter_bits(repeated, repeated.count())
    cut = bodies.mapInArrow(_cut(window, gram, bits), SUPERS)
    folder = staging.folder("super-k-mers")
    cut.write.option("compression", "zstd").parquet(folder)
    supers = bodies.sparkSession.read.parquet(folder)
    folded = supers.groupBy("mini", "sid", "packed").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    folder = staging.folder("strings")
    folded.write.option("compression", "zstd").parquet(folder)
    strings = bodies.sparkSession.read.parquet(folder)
    hot = strings.groupBy("mini").count().filter(F.col("count") > split_above)
    hot = staging.table(hot.select(F.col("mini").alias("_hot")), "hot-minimisers")
    few = strings
    if many := not hot.isEmpty():
        few = strings.join(hot, F.col("mini").eqNullSafe(F.col("_hot")), "left_anti")
    bucketed = few.repartition("mini").sortWithinPartitions("mini")
    runs = bucketed.mapInArrow(_rank_buckets(window), RUNS)
    if many:
        split = strings.join(hot, F.col("mini").eqNullSafe(F.col("_hot")), "left_semi")
        runs = runs.union(_runs_of_hot(split, window, staging))
    runs = staging.table(runs.withColumnRenamed("sid", "_sid"), "window-runs")
    places = supers.select("sid", "doc", "text", "start").distinct()
    found = places.join(runs, F.col("sid").eqNullSafe(F.col("_sid"))).filter("least < doc")
    return found.select("doc", "text", (F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"))


def _edited(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """Texts without the words of their spans, the rest joined by one space each."""
    kept, many, gone = [], [], []
    for text, of_text in zip(texts, spans, strict=True):
        words = [] if text is None else text.encode().split()
        stay = np.ones(len(words), dtype=bool)
        for span in of_text if of_text is not None else ():
            stay[span["s"] : span["e"]] = False
        left = words if stay.all() else [words[i] for i in np.flatnonzero(stay)]
        kept.append(None if text is None else b" ".join(left).decode())
        many.append(len(words))
        gone.append(len(words) - len(left))
    return pd.DataFrame({"text": kept, "n_words": many, "n_removed": gone})


def remove_repeated_windows(
    docs: DataFrame,
    staging: Staging,
    window: int = WINDOW,
    gram: int = GRAM,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """``docs`` with ``text`` less every word of a window of ``window`` words that also
    starts in a document of smaller doc_id, and with two columns more: ``n_words`` of the
    text as it was, and ``n_removed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; those that stay are joined by one space.
    Windows are judged on the texts as they come. A NULL text has no words and stays
    NULL; a text of fewer words than a window loses none. A NULL doc_id is smaller than
    all others. Documents of one doc_id never take from each other, and rows equal in
    doc_id and text get the same text. Extra columns pass through, whatever their names,
    but for columns called as the two new ones, which these replace; an empty table
    stays empty.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    named = docs.select(
        F.struct(*columns).alias("_in"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"),
        F.xxhash64("text").alias("_text"),
    )
    bodies = named.select(
        F.col("_doc").alias("doc"),
        F.col("_text").alias("text"),
        F.coalesce(F.col("_in")["text"], F.lit("")).cast("binary").alias("body"),
    )
    spans = repeated_spans(bodies, staging, window, gram, split_above)
    spans = staging.table(
        spans.groupBy(F.col("doc").alias("_d"), F.col("text").alias("_t")).agg(
            F.collect_list(F.struct("s", "e")).alias("_spans")
        ),
        "window-spans",
    )
    owners = spans.select(F.xxhash64("_d", "_t").alias("_owner"))
    marked = named.withColumn("_key", F.xxhash64("_doc", "_text"))
    marked = maybe_in(marked, "_key", owners, "_owner", owners.count())
    same = F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_text").eqNullSafe(F.col("_t"))
    met = marked.filter("_possible").join(spans, same, "left").select("_in", "_spans")
    kind = spans.schema["_spans"].dataType
    rest = marked.filter("NOT _possible").select("_in", F.lit(None).cast(kind).alias("_spans"))
    edited = F.pandas_udf(_edited, "text string, n_words long, n_removed long")
    made = met.union(rest).withColumn("_new", edited(F.col("_in")["text"], F.col("_spans")))
    return made.select(
        *[(F.col("_new")["text"] if c == "text" else F.col("_in")[c]).alias(c) for c in columns],
        F.col("_new")["n_words"].alias("n_words"),
        F.col("_new")["n_removed"].alias("n_removed"),
    )
