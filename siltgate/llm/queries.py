"""Queries of this subpackage over the given tables, and SQL twins where SQL can tell."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import (
    cotraining,
    embedding_dedup,
    hard_negatives,
    line_dedup,
    ngram_scoring,
    packing,
    piece_codec,
    sharding,
    simhash_dedup,
    spelling_variants,
    superkmer_dedup,
    url_filter,
    winnowing,
)
from siltgate.llm.common import read
from siltgate.sources.staging import Staging

SHARDS = 8
WINDOW, END_ID = 2048, 1
# The rules of the query: fixed values.
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# A page whose title lists as many keywords, divided so, puts its URL on the list.
TITLE, DIVIDER, LEAST_KEYWORDS = "<title>([^<]*)</title>", " [|] ", 5


def op1_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    placed = sharding.shard_documents(docs, SHARDS, Staging.until_exit(spark))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return piece_codec.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op3_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return embedding_dedup.near_duplicates(vectors, Staging.until_exit(spark))


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    linked = simhash_dedup.near_duplicates(docs, Staging.until_exit(spark))
    return linked.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op5_winnowed_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    made = winnowing.fingerprint_documents(docs, Staging.until_exit(spark))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.as_string(F.col("selected")).alias("fingerprint"),
        winnowing.as_string(F.col("edited_selected")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        WINDOW,
        END_ID,
    )


def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def op7_repeated_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_chunks(docs, Staging.until_exit(spark))


def op8_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs are judged by themselves; the list comes from what pages hold."""
    pages = read(spark, sf_dir, "pages")
    host, path = url_filter.split_url(F.col("url"))
    title = F.regexp_extract("html", TITLE, 1)
    flagged = pages.filter(F.size(F.split(title, DIVIDER)) >= LEAST_KEYWORDS)
    listed = flagged.select(url_filter.canonical(host, path).alias("listed_url"))
    judged = pages.select("page_id", "url")
    return url_filter.judge_urls(judged, listed, URL_RULES, Staging.until_exit(spark))


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return ngram_scoring.score_documents(docs, Staging.until_exit(spark))


def op10_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = cotraining.train(docs, read(spark, sf_dir, "labels"))
    return cotraining.score_documents(docs, model)


def op11_pivotal_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants.group_variants(docs, Staging.until_exit(spark))


def op12_packed_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hard_negatives.mine_hard_negatives(vectors, Staging.until_exit(spark))


def op13_superkmer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    edited = superkmer_dedup.remove_repeated_windows(docs, Staging.until_exit(spark))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return edited.select("doc_id", "n_words", "n_removed", kept)


QUERIES = {
    f.__name__: f
    for f in (
        op1_karmarkar_karp_shards,
        op2_piece_codec,
        op3_embedding_near_duplicates,
        op4_simhash_near_duplicates,
        op5_winnowed_fingerprints,
        op6_packed_sequences,
        op7_repeated_line_chunks,
        op8_url_verdicts,
        op9_deleted_interpolation,
        op10_cotrained_quality,
        op11_pivotal_spelling_variants,
        op12_packed_hard_negatives,
        op13_superkmer_windows,
    )
}

ORACLE = {
    "op8_url_verdicts": """
WITH parts AS (
  SELECT page_id, substr(url, instr(url, '://') + 3) AS rest, instr(url, '://') > 0 AS marked,
    len(string_split(regexp_extract(html, '<title>([^<]*)</title>', 1), ' | ')) >= 5 AS flagged
  FROM pages
), split AS (
  SELECT page_id, flagged,
    CASE WHEN marked THEN translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN marked THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM parts
), named AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE
    (CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END)
    || rtrim(path, '/') END AS canonical
  FROM split
), rules(rule, verdict, rule_host, rule_path) AS (VALUES
  ('net/', 'block', 'net', '/'),
  ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'),
  ('org/fr/', 'allow', 'org', '/fr/')
), fitting AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM split JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
), listed AS (
  SELECT DISTINCT canonical FROM named WHERE flagged
)
SELECT n.page_id, n.host, n.path, f.rule,
  coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN fitting f USING (page_id) LEFT JOIN listed l ON n.canonical = l.canonical
""",
    "op12_packed_hard_negatives": """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor, r.id, r.label = a.label AS same,
    CAST(list_dot_product(a.parts, r.parts) AS BIGINT) AS score
  FROM whole a JOIN whole r ON r.id <> a.id WHERE a.id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, n.id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
""",
    "op13_superkmer_windows": """
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS s FROM split WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 49], ' ') AS text FROM starts
), firsts AS (
  SELECT text, min(doc_id) AS first FROM windows GROUP BY text
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS place
  FROM windows JOIN firsts USING (text) WHERE first < doc_id
), each_word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM each_word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
""",
}
