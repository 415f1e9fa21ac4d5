from __future__ import annotations

import random

import compare
from pyspark.sql import functions as F

from siltgate.llm import url_filter
from siltgate.llm.common import maybe_in
from siltgate.llm.queries import ORACLE, QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def test_query_has_its_twin(spark):
    df = QUERIES["op8_url_verdicts"](spark, SF)
    names, rows = compare.spark_rows(df)
    assert (names, rows) == compare.sql_rows(compare.connect(SF), ORACLE["op8_url_verdicts"])
    assert {r[names.index("verdict")] for r in rows} == {"allow", "block"}


def judged(spark, staging, urls, listed=(), **limits):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.selectExpr("*", "1 AS block", "2 AS listed_url")
    known = spark.createDataFrame([(u,) for u in listed], "listed_url string")
    rows = url_filter.judge_urls(pages, known, URL_RULES, staging, **limits).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_awkward_urls(spark, staging):
    urls = [
        None, "", "no mark/here", "http://", "http://A.Net", "http://A.NET/", "http://net/x",
        "http://xnet/x", "http://www.example.net/en/", "http://example.net/en", "http://example.NET/EN/",
        "x://example.com/de/1?q#f", "http://a.org?x=/fr/", "http://é.org/fr/ü", "a://b://c/d",
        "http://h.com#f/de/", "http://u@h.com:80/p\nq?",
    ]
    rows = judged(spark, staging, urls, ["b:", "h.com"])
    assert [r[:2] for r in rows] == [
        ("", ""), ("", ""), ("", ""), ("", ""), ("a.net", ""), ("a.net", "/"), ("net", "/x"),
        ("xnet", "/x"), ("www.example.net", "/en/"), ("example.net", "/en"), ("example.net", "/EN/"),
        ("example.com", "/de/1"), ("a.org", ""), ("é.org", "/fr/ü"), ("b:", "//c/d"),
        ("h.com", ""), ("u@h.com:80", "/p\nq"),
    ]
    assert [r[2] for r in rows] == [
        None, None, None, None, None, "net/", "net/", None, "example.net/en/", "net/", "net/",
        "example.com/de/", None, "org/fr/", None, None, None,
    ]
    assert rows[15][3] == "block" and rows[14][3] == "allow" and rows[12][3] == "allow"
    assert judged(spark, staging, []) == [] and judged(spark, staging, urls)[15][3] == "allow"


def test_a_full_filter_lets_none_through_wrongly(spark, staging):
    draw = random.Random(1)
    urls = [f"http://h{draw.randrange(300)}.com/{draw.randrange(20)}" for _ in range(2_000)]
    listed = sorted({u[7:] for u in urls[:700]})
    rows = judged(spark, staging, urls, listed, most_blocks=2)
    for url, row in zip(urls, rows, strict=True):
        assert (row[3] == "block") == (url[7:] in set(listed))


def test_the_filter_holds_back_most(spark):
    urls = spark.range(20_000).select(F.concat(F.lit("h.com/"), "id").alias("url"))
    listed = urls.filter("url < 'h.com/2'").withColumnRenamed("url", "key")
    rows = maybe_in(urls, "url", listed, "key", listed.count()).collect()
    passed = {r.url for r in rows if r._possible}
    known = {r.url for r in rows if r.url < "h.com/2"}
    assert known <= passed and len(passed - known) < 0.05 * len(rows)
