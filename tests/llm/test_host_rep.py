"""Host reputation: rules, shrinkage, edge cases."""

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import host_rep as H

PAGES = "page_id long, url string"


@pytest.mark.parametrize("url, host, path, rule", [
    ("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/"),
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/"),
    ("https://b.www.example.com/en/", "b.www.example.com", "/en/", "www.example.com/en/"),
    ("https://www.example.com/en", "www.example.com", "/en", "com/"),
    ("ftp://notexample.com/en/x", "notexample.com", "/en/x", "com/"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/"), ("http://net/fr/", "net", "/fr/", "net/fr/"),
    ("http://x.net/de/1", "x.net", "/de/1", None), ("http://x.com", "x.com", "", None),
    ("http://x.com?a=/", "x.com", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ("no scheme.com/x", "", "", None), ("", "", "", None), (None, "", "", None)])
def test_rules(spark, url, host, path, rule):
    r = H.judge_urls(spark.createDataFrame([(1, url)], PAGES), spark.createDataFrame([], "page_id long, bad int")).first()
    assert (r.host, r.path, r.rule) == (host, path, rule)
    assert r.verdict == (dict((t, k) for k, t in H.RULES)[rule] if rule else "allow")


def test_shrinkage(spark):
    pages, bad = [], []
    for host, n, share in (("a.bad.org", 60, 1.0), ("b.bad.org", 60, 0.9), ("c.bad.org", 2, 1.0),
                           ("a.good.org", 60, 0.0), ("b.good.org", 60, 0.1), ("new.good.org", 3, None),
                           ("one.other.org", 1, 1.0)):
        for k in range(n):
            pages.append((len(pages), f"http://{host}/{k}"))
            if share is not None:
                bad.append((len(pages) - 1, int(k < share * n)))
    pages.append((900, None))
    frame = spark.createDataFrame(pages + pages[:1], PAGES).withColumns({"bad": F.lit("clash"), "host": F.lit(1)})
    got = H.judge_urls(frame, spark.createDataFrame(bad + [(901, None)], "page_id long, bad int"),
                       rules=()).collect()
    assert len(got) == len(pages) + 1
    by = {r.host: r for r in got}
    assert by["a.bad.org"].verdict == by["b.bad.org"].verdict == "block"
    assert all(by[h].verdict == "allow" for h in ("a.good.org", "b.good.org", "new.good.org", "one.other.org", ""))
    assert by["c.bad.org"].bad_bound > by["one.other.org"].bad_bound > by["a.good.org"].bad_bound
    kept = H.filter_urls(frame, spark.createDataFrame(bad, "page_id long, bad int"), rules=())
    assert kept.columns == frame.columns
    assert kept.count() == sum(r.verdict == "allow" for r in got)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    assert H.judge_urls(spark.createDataFrame([], PAGES), none).count() == 0
