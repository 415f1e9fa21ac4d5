"""Documents to training sequences: quality, repeated passages, near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import cotraining, line_dedup, simhash_dedup
from siltgate.llm.common import read
from siltgate.llm.queries import packed
from siltgate.sources.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEAR_COPY = 0.8  # share of a text, and likeness of two, from which one is the other's copy


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps. An empty table stays empty."""
    model = cotraining.train(docs, read(spark, sf_dir, "labels"))
    return cotraining.keep_good(docs, model)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur earlier; ``n_chars`` follows. Near copies of
    whole documents, told by their lines, are left to the next stage: shreds of them could
    not be recognised there."""
    # Columns of the input may be called as the operator's own, so they travel in one.
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    slim = docs.select("doc_id", "text", rest.alias("_row"))
    edited = line_dedup.remove_repeated_chunks(slim, Staging.until_exit(spark), leave_copies=NEAR_COPY)
    size = F.when(F.col("lines_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("_row.n_chars"))
    new = {"text": F.col("text"), "n_chars": size}
    return edited.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, likeness 0.8): the one of the
    least doc_id. Rows of one doc_id count as one document, the row of the least hash of its
    text and columns; rows without a doc_id, which no group can name, stay once for each
    text."""
    linked = simhash_dedup.near_copies(docs, Staging.until_exit(spark), likeness=NEAR_COPY)
    stay = linked.filter("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    in_full = F.xxhash64(*[F.col(c) for c in docs.columns])
    rows = docs.select(F.struct(*docs.columns).alias("_in"), F.xxhash64("text").alias("_body"), in_full.alias("_full"))
    named = rows.join(stay, F.col("_in.doc_id").eqNullSafe(F.col("_stays")), "left_semi")
    least = F.min(F.struct("_body", "_full", "_in"))["_in"].alias("_in")
    nameless = rows.filter("_in.doc_id IS NULL").groupBy("_body").agg(least).select("_in")
    return named.groupBy("_in.doc_id").agg(least).select("_in").union(nameless).select("_in.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences of at most 2048 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("line dedup", repeated_passages),
    ("SimHash near-dedup", near_copies),
    ("packing", sequences),
]

# Hashed features, chunk hashes and token ids are beyond SQL; tests/llm holds the stages
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each written and read again."""
    staging = Staging.until_exit(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
