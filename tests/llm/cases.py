"""Awkward documents for the operator tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} and, so on {i}." for i in range(6_000))

AWKWARD = [
    (1, "One two three. Four five six.\nSeven eight nine ten eleven twelve.", "en", "a", 10),
    (2, "One two three. Four five six.\nSeven eight nine ten eleven twelve.", "en", "b", 10),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (5, "   \t\n ", "en", "a", 6),
    (6, "single", "de", "a", 6),
    (7, LONG, "en", "a", len(LONG)),
    (8, "ÀÉÎ õü ß 日本語 😀 café naïve ÀÉÎ", "fr", "a", None),
    (9, "a  b   c\x00d▁e <s> </s> <0x0A>", "en", "a", 5),
    (9, "a  b   c\x00d▁e <s> </s> <0x0A>", "en", "a", 5),
    (9, "another text of the same id", "en", "a", 5),
    (None, "no id here at all", "en", None, 3),
    (None, "no id here at all", "en", None, 3),
    (-5, "negative id", "es", "c", 11),
]


# Names that the operators use themselves.
CLASHES = (
    "group shard slot bytes part fp node root key variant near centre block listed_url piece row "
    "bucket chunk s e _doc _text _body _row _next _later _key size text_crc32 score keep label spans size_ words named "
).split()


def awkward(spark: SparkSession, clashing: bool = False) -> DataFrame:
    docs = spark.createDataFrame(AWKWARD, DOCS).repartition(3)
    if clashing:
        docs = docs.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])
    return docs


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def key(row: tuple) -> tuple:
    return tuple((x is None, str(x)) for x in row)


def same_rows(a: list, b: list) -> bool:
    return sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def closure(nodes: list, links: list[tuple]) -> dict:
    """Least node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}
