"""URL filters: host and path rules, then a list of URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import MOST_BLOCKS, maybe_in
from siltgate.sources.staging import Staging

ALLOW, BLOCK = "allow", "block"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.char_length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` and path without trailing slashes; empty without
    a host. Scheme, query and fragment don't count."""
    bare = F.when(host.startswith("www."), F.substring(host, F.lit(5), F.char_length(host)))
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.coalesce(bare, host), F.rtrim(path, F.lit("/")))
    )


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of (verdict, ``host/path/``) rules that fits, as (size, rule, verdict)."""
    table = F.array(
        *[
            F.struct(
                F.lit(len(rule)).alias("size"),
                F.lit(rule).alias("rule"),
                F.lit(verdict).alias("verdict"),
                F.lit(rule[: rule.index("/")]).alias("host"),
                F.lit(rule[rule.index("/") :]).alias("path"),
            )
            for verdict, rule in rules
        ]
    )
    fits = F.filter(
        table,
        lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"])))
        & path.startswith(r["path"]),
    )
    return F.array_max(fits)


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]],
    staging: Staging,
    most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url).

    The longest fitting rule decides; it fits its host and all subdomains where the
    path begins with the rule's. Where none fits, a URL whose canonical form is in
    ``listed`` (listed_url, canonical forms) is blocked and any other allowed. A block of
    the Bloom filter is one row of at most ``most_blocks``, so the filter is broadcast
    whatever the list's length; only URLs that it passes are shuffled to the exact join
    with the list. With a longer list more URLs pass; none is judged wrongly.

    A NULL url, or one without ``://``, has an empty host and path, no rule, and is
    allowed. Repeated rows and NULL page_ids are kept. Empty tables are fine; other
    columns are ignored.
    """
    known = staging.table(
        listed.select("listed_url").filter("listed_url != ''").distinct(), "listed-urls"
    )
    host, path = split_url(F.col("url"))
    judged = (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("_fit", longest_rule(F.col("host"), F.col("path"), rules))
        .withColumn("_url", F.when(F.col("_fit").isNull(), canonical(F.col("host"), F.col("path"))))
    )
    probed = maybe_in(judged, "_url", known, "listed_url", known.count(), most_blocks)
    # Two branches, so that what the filter holds back is not shuffled.
    passed = probed.filter("_possible").join(known, F.col("_url") == known["listed_url"], "left")
    held = probed.filter("NOT _possible").withColumn("listed_url", F.lit(None).cast("string"))
    hit = passed.unionByName(held)
    method = F.when(F.col("listed_url").isNotNull(), BLOCK).otherwise(ALLOW)
    return hit.select(
        "page_id",
        "host",
        "path",
        F.col("_fit")["rule"].alias("rule"),
        F.coalesce(F.col("_fit")["verdict"], method).alias("verdict"),
    )
