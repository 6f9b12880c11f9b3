from pyspark.sql import functions as F

from loomtext.functions.urls import canonical_url, domain_parts, domain_path, site_dirs
from loomtext.operators.sites import site_rollup

# url, canonical, site + dirs, (domain, p1, p2), (domain, path)
CASES = [
    ("HTTP://www.m.Example.com/a/b/c.html", "example.com/a/b/c.html", "example.com/a/b",
     ("example.com", "a", "b"), ("example.com", "a")),
    ("m.www.example.com", "www.example.com", "www.example.com", ("www.example.com", "", ""), ("www.example.com", "")),
    ("http://example.com/a/x.html", "example.com/a/x.html", "example.com/a", ("example.com", "a", "x.html"),
     ("example.com", "a")),
    ("http://example.com/x.html", "example.com/x.html", "example.com", ("example.com", "x.html", ""),
     ("example.com", "x.html")),
    ("http://example.com?q=1", "example.com?q=1", "example.com", ("example.com?q=1", "", ""), ("example.com", "")),
    ("http://example.com/search?q=a#z", "example.com/search?q=a#z", "example.com",
     ("example.com", "search?q=a#z", ""), ("example.com", "search")),
    ("http://example.com/home#/p/q", "example.com/home#/p/q", "example.com/home#/p", ("example.com", "home#", "p"),
     ("example.com", "home")),
    ("http://example.com/s?x=1/y", "example.com/s?x=1/y", "example.com/s", ("example.com", "s?x=1", "y"),
     ("example.com", "s?x=1")),
    (".example.com/a", ".example.com/a", ".example.com", ("", "a", ""), (".example.com", "a")),
    ("https://phone.wap.example.com/a/b/", "wap.example.com/a/b/", "wap.example.com/a/b",
     ("wap.example.com", "a", "b"), ("wap.example.com", "a")),
    ("", "", "", ("", "", ""), ("", "")),
]


def test_url_parts_golden(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "url string")
    out = df.select("url", canonical_url(F.col("url")).alias("c"), site_dirs(F.col("url")).alias("s"),
                    domain_parts(F.col("url")).alias("d"), domain_path(F.col("url")).alias("p")).collect()
    got = {r["url"]: (r["c"], r["s"], tuple(r["d"]), tuple(r["p"])) for r in out}
    for url, c, s, d, p in CASES:
        assert got[url] == (c, s, d, p), url


def test_prefix_order(spark):
    df = spark.createDataFrame([("www.m.x",), ("m.www.x",), ("i.phone.x",)], "url string")
    got = {r[0]: r[1] for r in df.select("url", canonical_url(F.col("url"))).collect()}
    assert got == {"www.m.x": "x", "m.www.x": "www.x", "i.phone.x": "phone.x"}


def test_site_rollup(spark):
    df = spark.createDataFrame([("http://a.com/x/1",), ("http://www.a.com/y",), ("http://b.org",)], "url string")
    got = sorted(tuple(r) for r in site_rollup(df).collect())
    assert got == [("a.com", 2, 2), ("b.org", 1, 1)]
