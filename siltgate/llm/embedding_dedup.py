"""Near-duplicate vectors by an inverted multi-index over product cells."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import components, parts_for
from siltgate.sources.staging import Staging


def unit_rows(vectors: list, width: int) -> np.ndarray:
    """Vectors at length 1 in double precision, zeros behind shorter ones."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)  # neither squares overflow nor vanish
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means centres of ``points``; at most ``size`` of them."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= size:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), size, replace=False)]
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every centre."""
    square = (points * points).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :]
    return np.maximum(square - 2 * points @ centres.T, 0)


def nearest_cells(left: np.ndarray, right: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Multi-sequence traversal: the ``most`` cells of least distance sum, nearest first.

    ``left`` and ``right`` are a vector's distances to the two codebooks. A cell joins
    the agenda when the cells before it in its row and in its column have been visited.
    """
    rows, columns = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[rows].tolist(), right[columns].tolist()
    agenda = [(a[0] + b[0], 0, 0)]
    reached = [0] * (len(a) + 1)  # visited cells of each row
    cells = []
    while agenda and len(cells) < most:
        _, i, j = heapq.heappop(agenda)
        cells.append((int(rows[i]), int(columns[j])))
        reached[i] = j + 1
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(agenda, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(agenda, (a[i] + b[j + 1], i, j + 1))
    return cells


class MultiIndex:
    """Two codebooks over vector halves, and how many cells a search visits."""

    def __init__(self, sample: np.ndarray, size: int) -> None:
        self.width = sample.shape[1]
        self.middle = (self.width + 1) // 2
        self.books = [codebook(sample[:, : self.middle], size), codebook(sample[:, self.middle :], size)]
        self.visits = 1

    def sides(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            distances(units[:, : self.middle], self.books[0]),
            distances(units[:, self.middle :], self.books[1]),
        )

    def cells(self, units: np.ndarray) -> np.ndarray:
        left, right = self.sides(units)
        return left.argmin(axis=1) * len(self.books[1]) + right.argmin(axis=1)

    def searched(self, units: np.ndarray) -> list[list[int]]:
        columns = len(self.books[1])
        left, right = self.sides(units)
        return [
            [i * columns + j for i, j in nearest_cells(a, b, self.visits)]
            for a, b in zip(left, right, strict=True)
        ]

    def rank(self, unit: np.ndarray, cell: int) -> int:
        """How many cells a search from ``unit`` visits until it comes to ``cell``."""
        left, right = self.sides(unit[None])
        sums = (left[0][:, None] + right[0][None, :]).ravel()
        return int((sums <= sums[cell]).sum())

    def calibrate(
        self,
        found: list[tuple[np.ndarray, np.ndarray]],
        recall: float,
        least: int,
        planted: tuple[np.ndarray, np.ndarray] | None = None,
        floor: float = 0.95,
    ) -> None:
        """Visit as many cells as reach ``recall`` of the given true pairs, and ``floor`` of
        the ``planted`` ones, which a search from either end finds."""
        ranks = [self.rank(a, int(self.cells(b[None])[0])) for a, b in found]
        least = max(least, upper_quantile(ranks, recall))
        if planted is not None:
            ends = zip(*planted, self.cells(planted[0]), self.cells(planted[1]), strict=True)
            ranks = [min(self.rank(a, int(y)), self.rank(b, int(x))) for a, b, x, y in ends]
            least = max(least, upper_quantile(ranks, floor))
        self.visits = min(least, len(self.books[0]) * len(self.books[1]))


def upper_quantile(ranks: list[int], share: float) -> int:
    """The quantile with two standard errors on top; 0 for no ranks."""
    if not ranks:
        return 0
    n = len(ranks)
    return sorted(ranks)[min(n - 1, int(share * n + 2 * np.sqrt(n * share * (1 - share))))]


def planted_pairs(
    units: np.ndarray, lengths: np.ndarray, cosine: float, seed: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """Vectors, and for each one at ``cosine`` from it in a random direction: the pairs that
    are hardest to find. Vectors of one component have no such direction."""
    units, lengths = units[lengths > 1], lengths[lengths > 1]
    away = np.random.default_rng(seed).normal(size=units.shape)
    away[np.arange(units.shape[1])[None, :] >= lengths[:, None]] = 0
    away -= (away * units).sum(axis=1, keepdims=True) * units
    away /= np.sqrt((away * away).sum(axis=1, keepdims=True))
    return units, cosine * units + np.sqrt(1 - cosine * cosine) * away


def usable(column: str) -> F.Column:
    """Whether a vector can link: not NULL, empty or zero, all components finite."""
    return F.coalesce(
        F.expr(
            f"size({column}) > 0 AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x)"
            f" AND abs(x) < double('Infinity')) AND exists({column}, x -> x != 0)"
        ),
        F.lit(False),
    )


def link_vectors(
    classes: DataFrame,
    staging: Staging,
    cosine: float = 0.9,
    recall: float = 0.99,
    sample_rows: int = 8_000,
    probe_rows: int = 400,
    more_probes: int = 4_000,
    enough_pairs: int = 200,
    planted_rows: int = 1_000,
    cell_rows: int = 8,
    block_rows: int = 2_000,
    book_most: int = 512,
) -> DataFrame:
    """Links (a, b), a < b, between vectors of cosine ``cosine`` or more.

    ``classes`` has (node, vector) with distinct, usable vectors. The codebooks are
    fitted on at most ``sample_rows`` vectors, those of least hash; at most
    ``probe_rows`` of them are compared with all vectors by brute force, which sets how
    many cells a search must visit to find ``recall`` of the pairs; where fewer than
    ``enough_pairs`` pairs are met, ``more_probes`` are compared. Whatever is met, as
    many cells are visited as find 0.95 of pairs planted at ``cosine`` about
    ``planted_rows`` vectors that are not fitted, if there are others. Every vector is
    indexed in its cell and searches from its own. Cells hold about ``cell_rows``
    vectors: the books grow with the square root of the table, up to ``book_most``
    centres. A cell with more than ``block_rows`` vectors or searches is split into
    blocks, each pair of blocks being one group. Only vectors of one length compare.
    """
    spark = classes.sparkSession
    total, width = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    empty = spark.createDataFrame([], f"a {_kind(classes)}, b {_kind(classes)}")
    if total < 2:
        return empty
    sample = classes.orderBy(F.xxhash64("node")).limit(sample_rows + planted_rows).toPandas()
    units = unit_rows(sample["vector"].tolist(), width)
    size = int(min(book_most, max(2, np.sqrt(total / cell_rows))))
    index = MultiIndex(units[:sample_rows], size)
    lengths = sample["vector"].map(len).to_numpy()[-planted_rows:]
    planted = planted_pairs(units[-planted_rows:], lengths, cosine)
    for probes in (probe_rows, more_probes):
        pairs = _true_pairs(classes, sample[:probes], units[:probes], cosine)
        if len(pairs) >= enough_pairs or len(sample) <= probes:
            break
    index.calibrate(pairs, recall, 4, planted)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for the vector in its cell and one for every cell that it searches."""
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch[at : at + 1000]
                own = unit_rows(part["vector"].tolist(), width)
                length = part["vector"].map(len).to_numpy()
                keys = [[h, *s] for h, s in zip(index.cells(own), index.searched(own), strict=True)]
                yield pd.DataFrame(
                    {
                        "node": part["node"],
                        "vector": part["vector"],
                        "length": length,
                        "cells": keys,
                    }
                )

    placed = staging.table(
        classes.select("node", "vector").mapInPandas(
            place, f"node {_kind(classes)}, vector array<double>, length int, cells array<long>"
        ),
        "cells",
    )
    homes = placed.select("node", "vector", F.struct("length", F.col("cells")[0].alias("at")).alias("cell"))
    seeks = placed.select(
        "node", "vector", "length", F.explode(F.expr("slice(cells, 2, size(cells) - 1)")).alias("at")
    ).select("node", "vector", F.struct("length", "at").alias("cell"))
    held = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("held"))
    sought = placed.select("length", F.explode(F.expr("slice(cells, 2, size(cells) - 1)")).alias("at"))
    sought = sought.groupBy(F.struct("length", "at").alias("cell")).agg(F.count(F.lit(1)).alias("sought"))
    blocks = staging.table(
        held.join(sought, "cell").select(
            "cell",
            F.ceil(F.col("held") / block_rows).cast("int").alias("home_blocks"),
            F.ceil(F.col("sought") / block_rows).cast("int").alias("seek_blocks"),
        ),
        "cell-blocks",
    )

    def dealt(rows: DataFrame, mine: str, other: str, home: bool) -> DataFrame:
        own = F.pmod(F.xxhash64("node"), F.col(mine).cast("long")).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        pair = ("own", "others") if home else ("others", "own")
        return (
            rows.join(blocks, "cell")
            .select("cell", "node", "vector", own.alias("own"), others.alias("others"))
            .select("cell", *pair, "node", "vector", F.lit(home).alias("home"))
            .toDF("cell", "home_block", "seek_block", "node", "vector", "home")
        )

    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        home, seek = rows[rows["home"]], rows[~rows["home"]]
        if home.empty or seek.empty:
            return pd.DataFrame({"a": [], "b": []}).astype(rows["node"].dtype)
        likeness = unit_rows(home["vector"].tolist(), width) @ unit_rows(seek["vector"].tolist(), width).T
        i, j = np.nonzero(likeness >= cosine)
        x, y = home["node"].to_numpy()[i], seek["node"].to_numpy()[j]
        other = x != y
        return pd.DataFrame({"a": np.minimum(x, y)[other], "b": np.maximum(x, y)[other]})

    both = dealt(homes, "home_blocks", "seek_blocks", True).union(
        dealt(seeks, "seek_blocks", "home_blocks", False)
    )
    return (
        both.groupBy("cell", "home_block", "seek_block")
        .applyInPandas(verify, f"a {_kind(classes)}, b {_kind(classes)}")
        .distinct()
    )


def _kind(classes: DataFrame) -> str:
    return classes.schema["node"].dataType.simpleString()


def _true_pairs(
    classes: DataFrame, probes: pd.DataFrame, units: np.ndarray, cosine: float
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a probe and any vector within ``cosine``, by comparing all: at most 200
    of each 1,000 vectors and probe set come back, enough to see where they lie."""
    names, width = probes["node"].to_numpy(), units.shape[1]
    lengths = probes["vector"].map(len).to_numpy()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b[at : at + 1000] for b in batches for at in range(0, len(b), 1000)):
            own = unit_rows(batch["vector"].tolist(), width)
            alike = (own @ units.T >= cosine) & (batch["node"].to_numpy()[:, None] != names[None, :])
            alike &= batch["vector"].map(len).to_numpy()[:, None] == lengths[None, :]
            i, j = (x[:200] for x in np.nonzero(alike))
            yield pd.DataFrame({"probe": j, "vector": pd.Series([own[k] for k in i], dtype=object)})

    found = classes.select("node", "vector").mapInPandas(compare, "probe int, vector array<double>")
    return [(units[r["probe"]], np.array(r["vector"])) for r in found.limit(4_000).collect()]


def near_duplicates(vectors: DataFrame, staging: Staging, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Equal vectors form a class that is compared once; its rows link with each other and
    with all rows of the classes it links to. Vectors that are NULL, empty, zero or hold
    NULL, NaN or infinite components link with nothing: no links, their own component,
    kept. A row with a NULL vec_id counts as a link of others; its component_id is the
    least known vec_id there, NULL if none, and it is never kept. Repeated rows stay.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    good = rows.filter(usable("vector"))
    bits = F.transform("vector", lambda x: x + F.lit(0.0))  # -0.0 as 0.0
    node = F.sha2(F.to_json(F.struct(bits.alias("v"))), 256)
    keyed = staging.table(
        good.select("vec_id", node.alias("node"), bits.alias("vector")), "vectors"
    )
    classes = staging.table(
        keyed.groupBy("node").agg(
            F.any_value("vector").alias("vector"),
            F.count(F.lit(1)).alias("rows"),
            F.min("vec_id").alias("first"),
        ),
        "vector-classes",
    )
    found = staging.table(link_vectors(classes, staging, cosine), "vector-links")
    roots = components(found, staging)
    both = found.union(found.select("b", "a"))
    sizes = classes.select(F.col("node").alias("b"), "rows")
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("rows").alias("linked"))
    rooted = (
        classes.join(roots, "node", "left")
        .join(linked, classes["node"] == linked["a"], "left")
        .select(
            "node",
            "first",
            F.coalesce("root", "node").alias("root"),
            (F.coalesce("linked", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        )
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = staging.table(
        rooted.join(ids, "root").select("node", "n_links", "component_id"), "vector-labels"
    )
    alone = rows.filter(~usable("vector")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linking = keyed.select("vec_id", "node").join(labels, "node")
    return (
        linking.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
