"""URL functions against Python's own urllib/hashlib on hand-made inputs."""

import hashlib
import html
import random
import time
from email.utils import parsedate_to_datetime
from datetime import timezone
from urllib.parse import urljoin, urlparse, urlsplit, urlunsplit

import pytest

from pyspark.sql import functions as F

from frontier.functions import fetch as FT
from frontier.functions import lookup as L
from frontier.functions import urls as U

URLS = ["http://ththre.example.com/fr/825?page=2&ref=x", "https://User@M.Th.Example.NET:8080/en/25#top", "",
        "ftp://a.b.co.uk/x;p?b=2&a=1&a=&c", "//x.org/y", "mailto:a@b.com", "http://[::1]:80/",
        "https://news.example.org/a/b/c/article-12.html?x=1", "HTTP://Example.COM", "https://h.io:443"]


def py_normalize(url):
    raw = str(url or "").strip()
    if not raw:
        return ""
    parts = urlsplit(raw)
    if parts.scheme.lower() not in {"http", "https"} or not (parts.hostname or ""):
        return ""
    return urlunsplit((parts.scheme.lower(), parts.hostname.lower(), parts.path or "/", parts.query, ""))


def test_host_and_normalize(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    rows = df.select("url", U.host_of("url").alias("h"), U.normalize_url("url").alias("n")).collect()
    for r in rows:
        assert r.h == ((urlparse(r.url).hostname or "").lower() if r.url else "")
        assert r.n == py_normalize(r.url)


def test_shard_id_matches_python_md5(spark):
    keys = ["example.com", "a.b.c", "unknown", "ü.de", "x" * 300]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (256, 100, 7, 2 ** 31 - 1):
        got = [r.s for r in df.select(U.shard_id(F.col("k"), n).alias("s")).collect()]
        assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % n for k in keys]


def test_overrides_and_ingestor(spark):
    df = spark.createDataFrame([("wikipedia.org",), ("foo.com",)], "k string")
    r = df.select(U.shard_id(F.col("k"), 256, {"wikipedia.org": 0}).alias("s")).collect()
    assert r[0].s == 0 and r[1].s == int(hashlib.md5(b"foo.com").hexdigest(), 16) % 256
    assert spark.range(1).select(U.ingestor_of(F.lit(47), 16).alias("i")).first().i == 2


def test_registrable_domain_rules(spark):
    rules = U.SuffixRules(["com", "uk", "co.uk", "jp"], wildcard=["ck", "kawasaki.jp"], exception=["www.ck", "city.kawasaki.jp"])
    cases = {"a.b.example.com": "example.com", "example.com": "example.com", "com": None, "x.y.co.uk": "y.co.uk",
             "co.uk": None, "a.b.ck": "a.b.ck", "www.ck": "www.ck", "b.ck": None, "city.kawasaki.jp": "city.kawasaki.jp",
             "a.foo.kawasaki.jp": "a.foo.kawasaki.jp", "localhost": None, "1.2.3.4": None}
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    got = {r.h: r.d for r in df.select("h", U.registrable_domain("h", rules).alias("d")).collect()}
    assert got == cases


def test_shard_key_fallbacks(spark):
    df = spark.createDataFrame([("a.example.com", False), ("a.example.com", True), ("", False), ("localhost", False)],
                               "h string, wl boolean")
    got = [r.k for r in df.select(U.shard_key(F.col("h"), F.col("wl"), rules=U.SuffixRules(["com"])).alias("k")).collect()]
    assert got == ["example.com", "a.example.com", "unknown", "localhost"]


def test_tokens_depth_bucket(spark):
    df = spark.createDataFrame([("https://news.example.org/nba/team/2024;p?q=1",)], "url string")
    r = df.select(U.tokenize_url("url").alias("t"), U.path_depth("url").alias("d"), U.bucket_key("url").alias("b")).first()
    assert r.t == ["news", "example", "org", "nba", "team", "2024", "q", "1"]
    assert r.d == 3
    assert r.b == "depth=3|query=1|num=1|article=1|sports=1|entity=1"


def test_canonicalize(spark):
    df = spark.createDataFrame([("HTTP://Ex.COM/a b/für?b=2&a=&a=1#frag",), ("http://ex.com",)], "u string")
    got = [r.c for r in df.select(U.canonicalize_url("u").alias("c")).collect()]
    assert got == ["http://ex.com/a%20b/f%C3%BCr?a=&a=1&b=2", "http://ex.com/"]


def test_resolve(spark):
    r = spark.range(1).select(
        U.resolve_url(F.lit("http://a.com/x/y/z?q=1"), F.lit("../b")).alias("a"),
        U.resolve_url(F.lit("http://a.com/x/y"), F.lit("/p?x=1")).alias("b"),
        U.resolve_url(F.lit("http://a.com/x/y"), F.lit("//c.org/z")).alias("c"),
        U.resolve_url(F.lit("http://a.com/x/y"), F.lit("?k")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("http://a.com/x/b", "http://a.com/p?x=1", "http://c.org/z", "http://a.com/x/y?k")


def test_resolve_matches_the_library(spark):
    rng = random.Random(4)
    bases = ["http://a.com", "http://a.com/", "http://a.com/1/2/3/4/5/6/7/8/9/10/11/12/f?q=1", "http://a.com/x/y/", "http://a.com/x//y/z", "http://a.com/x/y?p=/1"]
    refs = ["../" * 11 + "t", "../" * 40 + "t", "..", ".", "./", "../", "a/./b/../c", "/a/b/../../../c/.", "//h.org/p", "g?y#z", "?y", "#s", "", "../..", "/./x", "a//b"]
    refs += ["/".join(rng.choice(["..", ".", "a", "b"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = [(b, r) for b in bases for r in refs]
    got = spark.createDataFrame(rows, "b string, r string").select("b", "r", U.resolve_url("b", "r").alias("u")).collect()
    plain = lambda u: u.rstrip("#")
    assert [(r.b, r.r, plain(r.u)) for r in got] == [(b, r, plain(urljoin(b, r))) for b, r in rows]


def test_character_references_match_the_library(spark):
    cases = ["It&#8217;s caf&eacute;", "&amp;&lt;&gt;&quot;&#39;&apos;&nbsp;", "&#x1F600; &#128512", "&copy 2", "&notit; &notin;", "&unknown; & &;", "&#0; &#xD800; &#x110000;",
             "&#150;&#x80;", "&ampamp;", "&AMP", "no refs", "", "&&amp;&", "&CounterClockwiseContourIntegral;", "x&#38;z"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r.c: r.d for r in df.select("c", L.html_unescape("c").alias("d")).collect()}
    assert got == {c: html.unescape(c) for c in cases}
    q = spark.createDataFrame([("/s?a=1&copy=2&amp;b=3&lt;&para",)], "c string")
    assert q.select(L.html_unescape("c", attribute=True).alias("d")).first().d == "/s?a=1&copy=2&b=3<\u00b6"


def test_suffix_rules_are_required():
    with pytest.raises(ValueError):
        U.registrable_domain(F.col("h"), None)
    with pytest.raises(ValueError):
        U.SuffixRules([])


def test_suffix_lookup_does_not_follow_the_rule_count(spark):
    hosts = spark.range(20000).select(F.concat(F.lit("h"), "id", F.lit(".a.b"), (F.col("id") % 90).cast("string"), F.lit(".com")).alias("h"))
    few = U.SuffixRules(["com"] + [f"x{k}.y" for k in range(99)])
    many = U.SuffixRules(["com"] + [f"x{k}.y" for k in range(9999)])
    took = []
    for rules in (few, few, many):
        begin = time.perf_counter()
        assert hosts.select(F.count_if(U.registrable_domain("h", rules).endswith(".com"))).first()[0] == 20000
        took.append(time.perf_counter() - begin)
    assert took[2] < 3 * took[1] + 3


def test_http_dates(spark):
    good = ["Wed, 21 Oct 2015 07:28:00 GMT", "21 Oct 2015 07:28:00 +0200", "Wednesday, 21-Oct-15 07:28:00 GMT", "Wed, 1 Jan 1997 00:00 PST", "Wed, 21 Oct 2015 07:28:00 -0930"]
    bad = ["", "yesterday", "32 Foo 2015 07:28:00 GMT", "Wed, 31 Feb 2015 07:28:00 GMT", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    got = {r.x: r.d for r in df.select("x", FT.iso_utc(FT.http_date("x")).alias("d")).collect()}
    for x in good:
        assert got[x] == parsedate_to_datetime(x).astimezone(timezone.utc).isoformat()
    assert all(got[x] is None for x in bad)
    assert spark.createDataFrame([("Wed Oct 21 07:28:00 2015",)], "x string").select(FT.iso_utc(FT.http_date("x"))).first()[0] == "2015-10-21T07:28:00+00:00"
