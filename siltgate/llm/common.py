"""What the operators of this subpackage share: tables, staging, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.sources.staging import Staging


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def unsigned_words(column: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case; no word for no text."""
    lower = F.translate(
        text_or_empty(column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return F.filter(F.split(lower, "[ \\t-\\r]+"), lambda w: w != "")


def parts_for(rows: int, rows_each: int) -> int:
    """How many parts of about ``rows_each`` rows there are; one at least."""
    return max(1, -(-rows // rows_each))


WORDS = 4  # 64-bit words of a Bloom filter's block; a key sets one bit in each
BITS_EACH = 16
MOST_BLOCKS = 1 << 17  # at 32 bytes: a filter never exceeds 4 MB of bits


def _bits(key: Column) -> list[Column]:
    """One bit of each word, chosen by a second hash of the key."""
    h = F.xxhash64(key, F.lit("bits"))
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"),
        )
        for i in range(WORDS)
    ]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """A blocked Bloom filter of ``keys``: (_block, _w0 to _w3), the bits folded by OR."""
    words = [b.alias(f"_w{i}") for i, b in enumerate(_bits(F.col(key)))]
    return (
        keys.select(_block(F.col(key), blocks).alias("_block"), *words)
        .groupBy("_block")
        .agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])
    )


def blocks_for(keys: int, most: int = MOST_BLOCKS) -> int:
    wanted = -(-max(1, keys) * BITS_EACH // (64 * WORDS))
    return min(most, 1 << (wanted - 1).bit_length())


def maybe_in(
    df: DataFrame, column: str, keys: DataFrame, key: str, count: int, most: int = MOST_BLOCKS
) -> DataFrame:
    """``df`` with ``_possible``: false where ``column`` is surely none of ``keys``, and
    where it is NULL. A block is one row and there are at most ``most``, so the filter is
    broadcast however many keys there are; with more of them it lets more pass."""
    blocks = blocks_for(count, most)
    bits = F.broadcast(bloom_blocks(keys, key, blocks))
    probed = df.withColumn("_at", _block(F.col(column), blocks)).join(
        bits, F.col("_at") == bits["_block"], "left"
    )
    possible = F.col(column).isNotNull()
    for i, bit in enumerate(_bits(F.col(column))):
        possible = possible & (F.col(f"_w{i}").bitwiseAND(bit) != 0)
    return probed.select(*df.columns, F.coalesce(possible, F.lit(False)).alias("_possible"))


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """Connected components of an undirected graph: (node, root), the root being the
    component's least node; nodes without an edge don't appear.

    ``edges`` has two columns of one orderable type. Large-star and small-star steps
    alternate until nothing changes: each node hands its larger neighbours, then its
    smaller ones, over to the least node it knows. Minima fold on the map side and
    the joins bring one row per node to its edges, so that adaptive execution may
    split the partition of a hub. Every round's edges are written to the shared folder.
    """
    a, b = edges.columns
    now = staging.table(
        edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
        .filter("low < high")
        .distinct(),
        "edges",
    )
    before = None
    while (seen := _digest(now)) != before:
        before = seen
        now = staging.table(_small_star(_large_star(now)), "edges")
    return now.select(F.col("high").alias("node"), F.col("low").alias("root"))


def _digest(edges: DataFrame) -> tuple[int, int]:
    mixed = F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
    row = edges.agg(F.count(F.lit(1)), F.coalesce(mixed, F.lit(0))).first()
    return int(row[0]), int(row[1])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(
        edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.col("n")).alias("m"))
    return (
        both.filter("v > u")
        .join(least, F.col("u").eqNullSafe(F.col("n")))
        .select(F.col("m").alias("low"), F.col("v").alias("high"))
        .filter("low < high")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("high").alias("n")).agg(F.min("low").alias("m"))
    joined = edges.join(least, F.col("high").eqNullSafe(F.col("n")))
    kept = least.select(F.col("m").alias("low"), F.col("n").alias("high"))
    moved = joined.select(F.col("m").alias("low"), F.col("low").alias("high"))
    return kept.union(moved.filter("low < high")).distinct()
