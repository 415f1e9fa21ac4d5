"""Hard negatives of anchor vectors, by exact integer products of packed candidates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltgate.llm.common import parts_for
from siltgate.sources.staging import Staging

ANCHOR_BLOCK, CANDIDATE_BLOCK = 8_192, 8_192
STRIPE = 512  # anchors multiplied at a time
DOUBLE_BITS, WORD_BITS = 53, 64  # widths up to which doubles and unsigned words are exact
LONGEST = (1 << 63) - 1

POSITIVES = "anchor long, positive_id long, positive long, score long"
NEGATIVES = (
    "anchor long, anchor_id long, positive_rank int, positive_id long, positive_score long, "
    "negative long, negative_id long, negative_score long"
)


def packed_products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all candidates, rows of integers, exactly.

    Components are biased so that none is negative. Several candidates' components
    then stand side by side in the fields of one wide integer, each field as wide as the
    greatest sum it may reach, so that one multiplication by an anchor's component
    serves all of them and no field spills into the next. The sums are unpacked and the
    bias is taken off again. Wide integers are whole numbers in doubles while they have
    at most 53 bits, unsigned words up to 64, and Python's integers beyond.
    """
    many, size = candidates.shape
    if not (len(anchors) and many and size):
        return np.zeros((len(anchors), many), dtype=np.int64)
    bias_a, bias_c = -int(anchors.min()), -int(candidates.min())
    top_a, top_c = int(anchors.max()) + bias_a, int(candidates.max()) + bias_c
    width = max(1, (size * top_a * top_c).bit_length())
    if 2 * width <= DOUBLE_BITS:
        kind, fields = np.float64, DOUBLE_BITS // width
    elif width <= WORD_BITS:
        kind, fields = np.uint64, max(1, WORD_BITS // width)
    else:
        kind, fields = object, 4
    exact = object if kind is object else np.int64
    biased_a, biased_c = anchors.astype(exact) + bias_a, candidates.astype(exact) + bias_c
    groups = -(-many // fields)
    wide = np.zeros((groups, size), dtype=object if kind is object else np.uint64)
    for f in range(fields):
        part = biased_c[f * groups : (f + 1) * groups]
        wide[: len(part)] += (part << (f * width)).astype(wide.dtype)
    sums = biased_a.astype(kind) @ wide.astype(kind).T
    if kind is not object:
        sums = sums.astype(np.uint64)
    mask = (1 << width) - 1
    if kind is object:
        unpacked = [(sums >> (f * width)) & mask for f in range(fields)]
    else:
        unpacked = [(sums >> np.uint64(f * width)) & np.uint64(mask) for f in range(fields)]
    products = np.concatenate(unpacked, axis=1)[:, :many].astype(exact)
    off = bias_c * biased_a.sum(axis=1)[:, None] + bias_a * biased_c.sum(axis=1)[None, :]
    products = products - off + size * bias_a * bias_c
    return np.clip(products, -LONGEST, LONGEST).astype(np.int64) if kind is object else products


def _best(scores: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` greatest allowed scores; of equal ones the first places."""
    places = np.flatnonzero(allowed)
    if len(places) > most:
        of_those = scores[places]
        least = np.partition(of_those, len(places) - most)[len(places) - most]
        above, equal = places[of_those > least], places[of_those == least]
        places = np.concatenate([above, equal[: most - len(above)]])
    return places


def _blocks(anchors: pd.DataFrame, candidates: pd.DataFrame):
    """Stripes of a block of anchors with their products with a block of candidates,
    candidates in order of id and number."""
    candidates = candidates.sort_values(["id", "number"], ignore_index=True)
    size = max(anchors["parts"].map(len).max(), candidates["parts"].map(len).max())

    def rows(parts: pd.Series) -> np.ndarray:
        return np.stack([np.pad(p, (0, size - len(p))) for p in parts])

    wide = rows(candidates["parts"])
    for at in range(0, len(anchors), STRIPE):
        stripe = anchors.iloc[at : at + STRIPE]
        yield stripe, candidates, packed_products(rows(stripe["parts"]), wide)


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _positives(most: int) -> Callable:
    def found(anchors: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(candidates):
            for stripe, others, scores in _blocks(anchors, candidates):
                label, number = others["label"].to_numpy(), others["number"].to_numpy()
                ids = others["id"].to_numpy()
                for row, anchor in enumerate(stripe.itertuples()):
                    mine = (label == anchor.label) & (number != anchor.number)
                    for c in _best(scores[row], mine, most):
                        out.append((anchor.number, ids[c], number[c], scores[row, c]))
        return pd.DataFrame(out, columns=_columns(POSITIVES))

    return found


def _negatives(most: int, low_percent: int) -> Callable:
    def found(anchors: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(candidates):
            for stripe, others, scores in _blocks(anchors, candidates):
                label, number = others["label"].to_numpy(), others["number"].to_numpy()
                ids = others["id"].to_numpy()
                for row, anchor in enumerate(stripe.itertuples()):
                    mine, other = scores[row], label != anchor.label
                    for rank, positive in enumerate(anchor.positives, 1):
                        top = int(positive["score"])
                        # Python integers: a bound of 80 % of a long may exceed a long.
                        bottom = -(-low_percent * top // 100)
                        for c in _best(mine, other & (mine <= top) & (mine >= bottom), most):
                            out.append(
                                (anchor.number, anchor.id, rank, positive["positive_id"], top,
                                 number[c], ids[c], mine[c])
                            )
        return pd.DataFrame(out, columns=_columns(NEGATIVES))

    return found


def _top(rows: DataFrame, group: list[str], score: str, ids: list[str], most: int, rank: str) -> DataFrame:
    """The first ``most`` rows of each group. The limit on the rank lets each task keep no
    more of a group before anything is shuffled."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), *ids)
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= most)


def prepared(vectors: DataFrame, scale: int, flip: int, labels: int) -> DataFrame:
    """(id, label, parts, number): the different rows that take part, their label as it is
    compared and their components as integers. ``number`` tells rows of one id apart."""
    parts = F.transform("embedding", lambda x: x.cast("double") * scale)
    whole = F.transform(parts, lambda x: F.floor(x).cast("long"))
    sound = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    label, i = F.col("label").cast("long"), F.col("vec_id").cast("long")
    flipped = F.when(F.pmod(i, F.lit(flip)) == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label)
    rows = vectors.filter(i.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & sound)
    rows = rows.select(i.alias("id"), flipped.alias("label"), whole.alias("parts")).distinct()
    return rows.withColumn("number", F.xxhash64("id", "label", "parts"))


def mine_hard_negatives(
    vectors: DataFrame,
    staging: Staging,
    positives: int = 5,
    negatives: int = 5,
    every: int = 100,
    low_percent: int = 80,
    scale: int = 256,
    flip: int = 7,
    labels: int = 10,
    candidate_block: int = CANDIDATE_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    anchor and each of its first ``positives`` other rows of the same label the first
    ``negatives`` rows of another label that score from ``low_percent`` to 100 percent of
    the positive.

    ``vectors`` has (vec_id, embedding, label). Components become
    ``floor(scale * component)``, scores are inner products of those, greater ones come
    first, then the smaller vec_id. Anchors are the rows whose vec_id is divisible by
    ``every``; the label of a row whose vec_id is divisible by ``flip`` is the next one of
    ``labels`` first. Rows with a NULL id, label or vector or with a NULL or
    non-finite component take no part. Rows alike in id, label and vector are one row;
    other rows of one id are rows of their own, told apart by a hash. A shorter vector
    ends in zeros. A score beyond a long is the greatest or least long. Other columns are
    ignored, and a table without anchors or positives gives no rows.

    Anchors and candidates are dealt to blocks of bounded size by hash, so that no label
    or id makes a block larger, and each pair of blocks is one group: anchors travel once
    for each block of candidates and the other way round. A group multiplies packed
    candidates (``packed_products``) and returns its first few rows of each anchor;
    these meet in a ranking whose limit applies before the shuffle. Positives are
    settled first, as the negatives' bounds depend on them.
    """
    rows = staging.table(prepared(vectors, scale, flip, labels), "vectors")
    anchor_rows = rows.filter(F.pmod("id", F.lit(every)) == 0)
    blocks = parts_for(rows.count(), candidate_block)
    anchor_blocks = parts_for(anchor_rows.count(), anchor_block)

    def dealt(df: DataFrame, own: str, count: int, other: str, times: int) -> DataFrame:
        block = F.pmod(F.xxhash64("number", F.lit(own)), F.lit(count)).cast("int").alias(own)
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other))

    candidates = dealt(rows, "_c", blocks, "_a", anchor_blocks).groupBy("_a", "_c")
    found = (
        dealt(anchor_rows, "_a", anchor_blocks, "_c", blocks)
        .groupBy("_a", "_c")
        .cogroup(candidates)
        .applyInPandas(_positives(positives), POSITIVES)
    )
    best = _top(found, ["anchor"], "score", ["positive_id", "positive"], positives, "rank")
    listed = best.groupBy("anchor").agg(
        F.array_sort(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("positives")
    )
    asked = staging.table(
        anchor_rows.join(listed, F.col("number") == F.col("anchor")).drop("anchor"), "anchors"
    )
    candidates = dealt(rows, "_c", blocks, "_a", anchor_blocks).groupBy("_a", "_c")
    found = (
        dealt(asked, "_a", anchor_blocks, "_c", blocks)
        .groupBy("_a", "_c")
        .cogroup(candidates)
        .applyInPandas(_negatives(negatives, low_percent), NEGATIVES)
    )
    best = _top(found, ["anchor", "positive_rank"], "negative_score", ["negative_id", "negative"], negatives, "rank")
    return best.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
        "positive_score", "negative_score",
    )
