"""Grouping of spelling variants: words one edit apart, found by pivotal grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import parts_for
from siltgate.sources.staging import Staging

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 3  # rarest grams of a word: one edit meets at most two of them
OUTER = 3  # most letters on the far side of the edit that a key holds
SPREAD = 6.0  # words that one letter more in a key tells apart, as the costs assume

PART_WORDS = 20_000  # words whose keys one task makes

KEYS = "key long, word string, n long, last int"


def vocabulary(docs: DataFrame, least_letters: int = 7, least_count: int = 2, delete: int = 31) -> DataFrame:
    """(word, n) of the runs of letters, A-Z in lower case, that have ``least_letters`` and
    occur ``least_count`` times. A run whose crc32 with its doc_id is divisible by
    ``delete`` lacks one letter. Occurrences fold on the map side."""
    run = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc.alias("doc"), F.explode(run).alias("run"))
    runs = runs.select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    runs = runs.select("run", F.char_length("run").alias("size"), h.alias("h"))
    at = F.pmod("h", "size").cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.col("size")))
    lacks = F.pmod("h", F.lit(delete)) == 0
    words = runs.select(F.when(lacks, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= least_letters).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


@dataclass(frozen=True)
class GramOrder:
    """Bigrams from rare to frequent, and the share of each."""

    rank: dict[str, int]
    share: dict[str, float]

    @classmethod
    def of(cls, words: DataFrame) -> GramOrder:
        """Over all words. There are at most as many bigrams as pairs of letters, 8,100 of
        the 90, which bounds what the driver gets."""
        place = F.sequence(F.lit(1), F.char_length("word") - 1)
        gram = F.explode(F.transform(place, lambda i: F.substr("word", i, F.lit(2))))
        counted = words.filter(F.char_length("word") > 1).select(gram.alias("gram")).groupBy("gram").count()
        counts = sorted((r["count"], r["gram"]) for r in counted.collect())
        total = sum(n for n, _ in counts)
        return cls({g: i for i, (_, g) in enumerate(counts)}, {g: n / total for n, g in counts})

    def prefix(self, word: str) -> tuple[list[int], int]:
        """Places of the word's rarest grams, and the rank of the last of them. All places
        of that gram belong to the prefix."""
        ranked = [self.rank[word[i : i + 2]] for i in range(len(word) - 1)]
        last = sorted(ranked)[PREFIX - 1]
        return [i for i, r in enumerate(ranked) if r <= last], last

    def pivots(self, word: str, places: list[int]) -> tuple[int, int]:
        """Two disjoint grams of the prefix with the shortest lists to be expected.

        The cheapest chain of two grams, left to right: a chain that ends in a gram takes the cheapest
        way to it from a gram at least two places before.
        """
        n = len(word)
        cost = {i: self.share[word[i : i + 2]] for i in places}

        def lists(p: int, q: int) -> float:
            far_right, far_left = min(OUTER, n - q - 2), min(OUTER, p)
            return (
                cost[q] * (SPREAD**-q + SPREAD ** -(n - q - 2 + far_left))
                + cost[p] * (SPREAD ** -(n - p - 2) + SPREAD ** -(p + far_right))
            )

        ends = {q: min((lists(p, q), p) for p in places if p <= q - 2) for q in places if q - places[0] >= 2}
        q = min(ends, key=lambda end: (ends[end], end))
        return ends[q][1], q


def _key(kind: str, inner: str, outer: str, length: int) -> int:
    h = xxhash.xxh64_intdigest(f"{kind} {inner} {outer} {length}".encode())
    return h - (1 << 64) if h >> 63 else h


def listed_keys(word: str, places: list[int]) -> Iterator[int]:
    """Keys under which a word is listed: from each gram of its prefix the part up to the
    gram's end and the part from its start, whole or with some letters of the other end."""
    n = len(word)
    for i in places:
        head, tail = word[: i + 2], word[i:]
        yield _key("head", head, "", n)
        yield _key("tail", tail, "", n)
        for k in range(min(OUTER, n - i - 2) + 1):
            yield _key("head+", head, word[n - k :], n)
        for k in range(min(OUTER, i) + 1):
            yield _key("tail+", tail, word[:k], n)


def asked_keys(word: str, p: int, q: int) -> Iterator[int]:
    """Keys under which every word one edit away is listed, pivots being at p and q.

    The edit is behind the second pivot, or before the first, or in between or in one of
    them. Then the part up to the second's end is shared, or that from the first's
    start, or that up to the first's end or from the second's start together with the
    letters beyond the other pivot. Lengths differ by one at most.
    """
    n = len(word)
    beyond, before = min(OUTER, n - q - 2), min(OUTER, p)
    for length in (n - 1, n, n + 1):
        yield _key("head", word[: q + 2], "", length)
        yield _key("tail", word[p:], "", length)
        yield _key("head+", word[: p + 2], word[n - beyond :], length)
        yield _key("tail+", word[q:], word[:before], length)


def _rows_of_keys(order: GramOrder, asking: bool) -> Callable:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                keys, words, counts, lasts = [], [], [], []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist(), strict=True):
                    places, last = order.prefix(word)
                    found = asked_keys(word, *order.pivots(word, places)) if asking else listed_keys(word, places)
                    found = list(found)
                    keys += found
                    words += [word] * len(found)
                    counts += [n] * len(found)
                    lasts += [last] * len(found)
                columns = [keys, words, counts, pa.array(lasts, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if isinstance(c, list) else c for c in columns],
                    names=["key", "word", "n", "last"],
                ) if keys else _no_rows()

    return made


def _no_rows() -> pa.RecordBatch:
    kinds = [("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32())]
    return pa.RecordBatch.from_pylist([], schema=pa.schema(kinds))


def near_words(words: DataFrame, staging: Staging) -> DataFrame:
    """(a, b): structs (word, n) of all words that differ by one inserted, deleted or
    replaced letter, each pair once. ``words`` has (word, n), words of at least four
    letters, each once.

    The grams of all words are ordered from rare to frequent. A word's prefix is its three
    rarest grams, its pivots are two disjoint ones of these. One edit leaves one of
    two disjoint grams as it is; of two words one edit apart, the one whose prefix ends
    earlier in the order so has a pivot in the other's prefix. Keys hold the letters that
    must then be shared on one side of the pivot, which limits positions to those the edit
    allows. Candidates are verified by their edit distance. A key that many words share
    is split by adaptive execution, both sides having an exchange of their own.
    """
    order = GramOrder.of(words)
    # A word makes some forty rows of keys, so parts are set by words and not by bytes.
    words = words.repartition(parts_for(words.count(), PART_WORDS), "word")
    listed = words.mapInArrow(_rows_of_keys(order, False), KEYS)
    asked = words.mapInArrow(_rows_of_keys(order, True), KEYS)
    mine, other = F.struct("l.word", "l.n"), F.struct("r.word", "r.n")
    met = asked.alias("l").join(listed.alias("r"), F.col("l.key") == F.col("r.key"))
    met = met.filter("l.last <= r.last AND l.word <> r.word AND levenshtein(l.word, r.word, 1) = 1")
    pairs = met.select(F.least(mine, other).alias("a"), F.greatest(mine, other).alias("b"))
    return staging.table(pairs.distinct(), "near-words")


def _roots(forms: DataFrame, staging: Staging) -> DataFrame:
    """(word, root) of the words that have a form. Every round doubles the steps taken; as
    a form is ``factor`` times as frequent, rounds are few whatever the table."""
    now = staging.table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        met = now.join(further, F.col("root") == F.col("_at"), "left")
        moved = met.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved"))
        moved = staging.table(moved, "roots")
        if moved.filter("moved").isEmpty():
            return now
        now = moved.drop("moved")


def group_variants(
    docs: DataFrame,
    staging: Staging,
    least_letters: int = 7,
    least_count: int = 2,
    factor: int = 10,
    delete: int = 31,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the texts (see ``vocabulary``).

    Words are near if one inserted, deleted or replaced letter makes one the other.
    ``n_near`` counts a word's near words. Its ``form`` is the most frequent of them, of
    equally frequent ones the first in code-point order, if that occurs ``factor`` times
    as often as the word; else NULL, as is ``form_n``, the form's count. ``root`` follows
    forms to the last, and is the word itself where there is none.

    NULL and empty texts have no words. A NULL doc_id counts as no text in the crc32;
    repeated rows each count. Other columns are ignored; an empty table gives no rows.
    """
    words = staging.table(vocabulary(docs, least_letters, least_count, delete), "words")
    pairs = near_words(words, staging)
    both = pairs.select("a.word", F.col("b").alias("near")).union(
        pairs.select("b.word", F.col("a").alias("near"))
    )
    first = F.min(F.struct((-F.col("near.n")).alias("n"), F.col("near.word").alias("word")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first.alias("_first"))
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        (-F.col("_first.n")).alias("_n"), F.col("_first.word").alias("_word"),
    )
    is_form = F.col("_n") >= F.lit(factor) * F.col("n")
    found = found.select(
        "word", F.when(is_form, F.col("_word")).alias("form"), "n", "n_near",
        F.when(is_form, F.col("_n")).alias("form_n"),
    )
    found = staging.table(found, "forms")
    roots = _roots(found.filter("form IS NOT NULL"), staging)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
