"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import components, maybe_in
from siltgate.sources.staging import Staging

SEED = 42
BITS, HALF = 64, 32
RADIUS = 3


def fingerprint(text: str, words_each: int = 3) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 for no words.

    Words are separated by the six ASCII spaces, A-Z is lower-cased. A text of fewer
    words is one shingle. A bit is set if it is set in over half of the hashes.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(words_each)), strict=False)))
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 16):
        part = [digest(s, SEED) for s in shingles[at : at + (1 << 16)]]
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    chosen = np.packbits(votes * 2 > len(shingles))
    return int(chosen.view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; a NULL text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py() or "") for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(made, type=pa.int64())], names=["doc_id", "fp"]
            )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, fp long")


def _flip(bit: int) -> int:
    return -(1 << 63) if bit == 63 else 1 << bit


def _xor_all(fp: Column, masks: list[int]) -> Column:
    """The variants of a fingerprint, the fingerprint itself included."""
    table = F.array(*[F.lit(m).cast("long") for m in masks])
    return F.transform(table, lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, staging: Staging) -> DataFrame:
    """Edges (a, b) that join the same fingerprints as all pairs at ``RADIUS`` or fewer
    differing bits do. Every edge is such a pair; a pair whose ends are joined
    otherwise may be left out. ``fps`` has one column of distinct longs.

    Two fingerprints at 3 or fewer bits have a variant in the middle, at most 1 bit
    from the one and 2 bits from the other. Parity says which: flipping one bit
    changes the parity, so a pair at exactly 3 bits has one even and one odd end. All
    fingerprints emit their ball of radius 1, and odd ones also their sphere of radius
    2. Of three differing bits two are in the same half, so the sphere needs only
    flips of two bits in one half. On a variant where someone is near (at most 1 bit),
    near ones are within 2 bits of each other and far ones within 3 of any near one:
    linking everyone to the least near one is exact, and no pairs are formed.

    Most fingerprints have no neighbour at all. A first pass keeps those that may have
    one: if two agree to 3 bits, one of their halves agrees to half the radius, 1 bit.
    Every fingerprint emits the 33 variants of either half; those that meet another's
    bare half go on. Both passes fold on the map side before they shuffle.
    """
    fp = F.col("fp")
    left = F.shiftrightunsigned(fp, HALF)
    right = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    balls = F.array(F.lit(0), *[F.lit(1 << k) for k in range(HALF)])
    ball = fps.select(
        "fp",
        F.explode(
            F.flatten(
                F.array(
                    F.transform(balls, lambda m: left.bitwiseXOR(m.cast("long")) * 2),
                    F.transform(balls, lambda m: right.bitwiseXOR(m.cast("long")) * 2 + 1),
                )
            )
        ).alias("key"),
    )
    bare = ((F.col("key") == left * 2) | (F.col("key") == right * 2 + 1)).alias("bare")
    met = (
        ball.select("fp", "key", bare)
        .groupBy("key")
        .agg(F.min("fp").alias("least"), F.max("fp").alias("most"), F.max("bare").alias("bare"))
        .filter("bare AND least < most")
        .select("key")
    )
    met = staging.table(met, "simhash-keys")
    # Spark takes exploded rows to be as few as their fingerprints, so joins are told.
    near_by = staging.table(ball.join(met.hint("merge"), "key").select("fp").distinct(), "simhash-candidates")

    ones = [0, *[_flip(k) for k in range(BITS)]]
    pairs = [
        _flip(h + j) ^ _flip(h + k) for h in (0, HALF) for j in range(HALF) for k in range(j)
    ]
    odd = F.bit_count("fp") % 2 == 1
    near = near_by.select("fp", F.explode(_xor_all(fp, ones)).alias("variant"), F.lit(True).alias("near"))
    far = near_by.filter(odd).select(
        "fp", F.explode(_xor_all(fp, pairs)).alias("variant"), F.lit(False).alias("near")
    )
    variants = near.union(far)
    # The least near one of each variant that others reach as well. Its own rows fold
    # on the map side, and a variant that only one fingerprint reaches ends here.
    middle = staging.table(
        variants.groupBy("variant")
        .agg(
            F.min(F.when(F.col("near"), F.col("fp"))).alias("centre"),
            F.min("fp").alias("least"),
            F.max("fp").alias("most"),
        )
        .filter("centre IS NOT NULL AND least < most")
        .select("variant", "centre"),
        "simhash-variants",
    )
    return (
        variants.join(middle.hint("merge"), "variant")
        .filter("fp != centre")
        .select(F.col("centre").alias("a"), F.col("fp").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, staging: Staging) -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints link at 3 bits or fewer,
    by the least doc_id that links reach.

    Links are found between distinct fingerprints, so copies cost one row each. A NULL
    or empty text has fingerprint 0, which links like any other. Rows with a NULL
    doc_id take part and never give a component its id, which is NULL if no row of it
    has one. Repeated rows are kept; an empty table gives no rows.
    """
    rows = staging.table(fingerprints(docs), "simhash-rows")
    fps = staging.table(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(fps.select("fp"), staging), staging)
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(staging.table(by_fp, "simhash-components"), "fp").select(
        "doc_id", "fp", "component_id"
    )


PARTS, PART_BITS = 16, 32
SKETCH = 8
LIKENESS, LIKENESS_WORDS = 0.8, 5
BLOCK = 256  # nodes of a key that one task compares with all others of the key


def shingle_hashes(text: str, words_each: int) -> np.ndarray:
    """XXH64 of a text's different word shingles, in order; as ``fingerprint`` has them."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < words_each:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    shingles = set(map(b" ".join, zip(*(words[k:] for k in range(words_each)), strict=False)))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64, count=len(shingles)))


def _remixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Another 64 bits of each hash."""
    mixed = hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(turn + 1)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def wide_fingerprint(hashes: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """A SimHash of ``parts`` times 32 bits."""
    out = []
    with np.errstate(over="ignore"):
        for turn in range(-(-parts * PART_BITS // BITS)):
            votes = np.zeros(BITS, dtype=np.int64)
            for at in range(0, len(hashes), 1 << 14):
                mixed = _remixed(hashes[at : at + (1 << 14)], turn).astype(">u8").view(np.uint8)
                votes += np.unpackbits(mixed.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            out.append(np.packbits(votes * 2 > len(hashes)).view(">u4"))
    return np.concatenate(out)[:parts].astype(np.int64)


def _classed(docs: DataFrame, words_each: int, parts: int) -> DataFrame:
    """(doc_id, body, node, size, parts, sketch) of every row: hashes of the text and of its
    words, the number of different shingles, the wide fingerprint's parts and the least
    shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, wide, sketches = [], [], [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                words = text.encode("utf-8", "surrogatepass").lower().split()
                nodes.append(xxhash.xxh64_intdigest(b" ".join(words), 7))
                hashes = shingle_hashes(text, words_each)
                sizes.append(len(hashes))
                wide.append(wide_fingerprint(hashes, parts).tolist() if len(hashes) else [])
                sketches.append(np.sort(_remixed(hashes, PARTS))[:SKETCH].view(np.int64).tolist())
            columns = [
                batch["doc_id"],
                batch["body"],
                pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
                pa.array(sizes, type=pa.int64()),
                pa.array(wide, type=pa.list_(pa.int64())),
                pa.array(sketches, type=pa.list_(pa.int64())),
            ]
            names = ["doc_id", "body", "node", "size", "parts", "sketch"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(
        run, "doc_id long, body long, node long, size long, parts array<long>, sketch array<long>"
    )


def _meetings(classes: DataFrame, staging: Staging) -> DataFrame:
    """(node, size, key, least, most): which nodes meet on a key, and the ends of each key.

    Nodes that may be alike share one of their least shingle hashes with another, and some
    part of their fingerprints differs in two bits at most. Then a part has a variant one
    bit from either, and both emit that."""
    shared = (
        classes.select("node", F.explode("sketch").alias("key"))
        .groupBy("key")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .filter("least < most")
        .select(F.col("key").alias("_key"))
    )
    shared = staging.table(shared, "sketch-keys")
    met = classes.select("node", F.explode("sketch").alias("key")).join(
        shared, F.col("key").eqNullSafe(F.col("_key")), "left_semi"
    )
    near_by = staging.table(
        classes.join(met.select(F.col("node").alias("_node")).distinct(), F.col("node") == F.col("_node"), "left_semi")
        .select("node", "size", "parts"),
        "likely-nodes",
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << k).cast("long") for k in range(PART_BITS)])
    variants = F.flatten(
        F.transform(
            "parts", lambda p, i: F.transform(flips, lambda m: p.bitwiseXOR(m) + i.cast("long") * (1 << PART_BITS))
        )
    )
    ball = near_by.select("node", "size", F.explode(variants).alias("key"))
    ends = ball.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    ends = staging.table(ends.filter("least < most").withColumnRenamed("key", "_key"), "part-keys")
    found = ball.join(ends.hint("merge"), F.col("key").eqNullSafe(F.col("_key"))).drop("_key")
    return staging.table(found, "wide-meetings")


def _end_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of the nodes of a key with its least and its greatest node."""
    found = met.select("node", F.explode(F.array("least", "most")).alias("other")).filter("node <> other")
    return found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _other_pairs(met: DataFrame, roots: DataFrame, likeness: float, staging: Staging) -> DataFrame:
    """All other pairs (a, b) that meet on a key, but those that ``roots`` join already and
    those whose sizes alone rule likeness out. A key's nodes are dealt to blocks, each of
    which meets all of the key, so no task has all pairs of a large key."""
    inner = met.filter("least < node AND node < most").select("node", "size", "key")
    roots = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    inner = inner.join(roots, F.col("node") == F.col("_node"), "left").select(
        "node", "size", "key", F.coalesce("_root", "node").alias("root")
    )
    inner = staging.table(inner, "inner-meetings")
    apart = inner.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    apart = apart.filter("least < most").select(F.col("key").alias("_key"), blocks.alias("blocks"))
    inner = inner.join(apart, F.col("key").eqNullSafe(F.col("_key"))).drop("_key")
    inner = staging.table(inner, "open-meetings")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    x = inner.select("key", own.alias("block"), *[F.col(c).alias(f"{c}_x") for c in ("node", "size", "root")])
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    y = inner.select("key", every.alias("block"), *[F.col(c).alias(f"{c}_y") for c in ("node", "size", "root")])
    sizes = F.least("size_x", "size_y") >= F.lit(likeness) * F.greatest("size_x", "size_y")
    # Spark takes exploded rows to be few, so the join is told.
    pairs = x.join(y.hint("merge"), ["key", "block"]).filter("node_x < node_y AND root_x <> root_y").filter(sizes)
    return pairs.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct()


def _hashed(texts: DataFrame, words_each: int) -> DataFrame:
    """(node, hashes) of (node, text): the bytes of each text's ``shingle_hashes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_hashes(t.as_py() or "", words_each).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array(made, type=pa.binary())], names=["node", "hashes"]
            )

    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary")


def _alike_pairs(pairs: DataFrame, hashed: DataFrame, likeness: float) -> DataFrame:
    """The pairs (a, b) whose texts, by (node, hashes), share ``likeness`` of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                kept.append(both >= likeness * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, type=pa.bool_()))

    x = hashed.select(F.col("node").alias("a_"), F.col("hashes").alias("x"))
    y = hashed.select(F.col("node").alias("b_"), F.col("hashes").alias("y"))
    met = pairs.join(x, F.col("a").eqNullSafe(F.col("a_"))).join(y, F.col("b").eqNullSafe(F.col("b_")))
    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_copies(
    docs: DataFrame,
    staging: Staging,
    words_each: int = LIKENESS_WORDS,
    likeness: float = LIKENESS,
    parts: int = PARTS,
) -> DataFrame:
    """(doc_id, body, component_id) of each row: documents linked by texts that share
    ``likeness`` of their different shingles of ``words_each`` words, by the least doc_id
    that links reach. ``body`` is the xxhash64 of the row's text.

    One 64-bit fingerprint can't tell a likeness of 0.8, at which 13 of its bits may
    differ. So this takes ``parts`` times 32 bits: texts that are alike have a part that
    differs in two bits at most, and both emit all its variants within one bit (ball
    hashing by parts). Only texts that share one of their eight least shingle hashes with
    another emit them. All that meet on a variant are compared by their exact shingles:
    first each with the least and the greatest, which joins most groups of copies, then all
    pairs that are not joined yet. Texts of the same words are one node. No link is
    wrong; recall is measured in the README.

    A NULL text is empty; texts without words are copies of each other. Rows without a
    doc_id take part and never give a component its id, which is NULL if no row of it has
    one. Repeated rows are kept; an empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("body"))
    rows = staging.table(_classed(slim, words_each, parts), "wide-rows")
    classes = rows.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("body").alias("body"), F.min("size").alias("size"),
        F.min("parts").alias("parts"), F.min("sketch").alias("sketch"),
    )
    classes = staging.table(classes, "wide-classes")
    met = _meetings(classes.select("node", "size", "parts", "sketch"), staging)
    asked = met.select("node").distinct()
    asked = staging.table(asked.join(classes.select("node", "body"), "node"), "asked-texts")
    maybe = maybe_in(slim, "body", asked, "body", asked.count()).filter("_possible").select("text", F.col("body").alias("_body"))
    texts = maybe.join(asked, F.col("_body").eqNullSafe(F.col("body"))).select("node", "text")
    texts = texts.groupBy("node").agg(F.min("text").alias("text"))
    hashed = staging.table(_hashed(texts, words_each), "wide-hashes")
    links = staging.table(_alike_pairs(_end_pairs(met), hashed, likeness), "wide-links")
    roots = components(links, staging)
    rest = staging.table(_other_pairs(met, roots, likeness, staging), "wide-pairs")
    more = staging.table(_alike_pairs(rest, hashed, likeness), "more-links")
    if not more.isEmpty():
        roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more), staging)
    rooted = classes.select("node", "first").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    rooted = rooted.select("node", "first", F.coalesce("root", "node").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select(F.col("node").alias("_node"), "root").join(ids, "root").select("_node", "component_id")
    named = staging.table(named, "wide-components")
    return rows.join(named, F.col("node").eqNullSafe(F.col("_node"))).select("doc_id", "body", "component_id")
