import re

import pytest
from pyspark.sql import functions as F

from candlewick.llm import queries, urls
from tests.llm.helpers import SF001

URLS = [(1, "HTTPS://WWW.Example.NET/en/1?x=1#y"), (2, "http://net/"), (3, "http://a.net"), (4, "http://org/fr/x"), (5, None), (6, ""), (7, "no scheme.net/"), (8, "ftp://x.org/FR/"),
        (9, "http://badexample.net/en/1"), (10, "http://é.ORG/fr/?q=://net/"), (11, "://net/a://b"), (2, "http://net/"), (None, "http://sub.example.com/de/\n1"), (12, "http://a.net/" + "p/" * 5000)]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def check(rows, out):
    want = sorted(((i, *brute(u)[:2], r.text if (r := brute(u)[2]) else None, r.verdict if r else None) for i, u in rows), key=repr)
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in out), key=repr)
    assert got == want and all(r.verdict in ("allow", "block") and 0 <= r.p_block <= 1 for r in out)


def test_query_follows_the_rules(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    out = queries.op4_urls(spark, SF001).collect()
    check(rows, out)
    assert len({r.verdict for r in out if r.rule is None}) >= 1


def test_odd_urls_and_empty_table(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("features", F.lit(1)).withColumn("label", F.lit(2))
    check(URLS, urls.judge(pages, queries.RULES, trees=2).collect())
    assert urls.judge(pages.limit(0), queries.RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}


def test_trees_learn_lexical_signs(spark):
    """Held-out URLs: spam has long digit-laden paths; labels come from rules on two of four hosts."""
    rows = [(i, f"http://good{i % 50}.example.org/news/{i % 7}") for i in range(300)] + [(1000 + i, f"http://x{i % 50}.example.org/win/{i * 7919:012d}?a={i}&b=1&c=2") for i in range(300)]
    rules = [urls.Rule(f"good{k}.example.org", "/", "allow") for k in range(25)] + [urls.Rule(f"x{k}.example.org", "/", "block") for k in range(25)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, trees=5).where("rule is null").collect()
    assert sum((r.page_id >= 1000) == (r.verdict == "block") for r in out) / len(out) > 0.95


def test_a_rare_verdict_stays_in_the_sample(spark):
    """Three blocked URLs among 6,000 labelled ones, of which 40 are sampled."""
    rows = [(i, f"http://good.example.org/news/{i}") for i in range(6000)] + [(9000 + i, f"http://bad.example.org/win/{i:030d}?a=1&b=2&c=3") for i in range(3)]
    rows += [(9500 + i, f"http://other.example.org/win/{i * 7:030d}?a=1&b=2&c=3") for i in range(5)] + [(9600 + i, f"http://other.example.org/news/{i}") for i in range(5)]
    rules = [urls.Rule("good.example.org", "/", "allow"), urls.Rule("bad.example.org", "/", "block")]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules, max_labelled=40, trees=3).where("rule is null").collect()
    assert len(out) == 10 and all((r.verdict == "block") == (r.page_id < 9600) for r in out)


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        urls.features(spark.createDataFrame(URLS, "page_id long, url string"), [urls.Rule("a", "/", "block")] * (urls.MAX_RULES + 1))
