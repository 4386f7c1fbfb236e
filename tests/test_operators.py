"""Hand-made cases for page extraction, rolloff idempotence, selection limits,
map merge and sweeps."""

from pyspark.sql import functions as F

from frontier import schema as SC
from frontier.functions import urls as U
from frontier.operators import pages as PX
from frontier.operators import rekey as RK
from frontier.operators import rolloff as RO
from frontier.operators import select as SL
from frontier.operators import stats as STS

HTML = ('<html><head><title> A &amp; B </title><base href="http://b.example.com/dir/">'
        '<link rel="alternate" hreflang="de" href="/de"><link rel="stylesheet" href="/x.css">'
        '<script type="application/ld+json">{}</script></head><body>'
        '<a href="p1">One <b>bold</b></a><a href="/p1?b=2&a=1#f">dup</a><a href="/p1?a=1&b=2">dup2</a>'
        '<a href="img.png">img</a><a rel="nofollow" href="/nf">nf</a><a href="mailto:x@y.z">m</a>'
        '<!-- <a href="/hidden">h</a> --><a href="//c.org/z">ext</a></body></html>')


def test_extract_page(spark):
    df = spark.createDataFrame([(1, "http://A.example.com/index.html", HTML)], "page_id long, url string, html string")
    r = PX.extract_pages(df, keep=("page_id",), rules=U.SuffixRules(["com", "org"])).first()
    assert r.title == "A & B" and r.hreflang_count == 1 and r.has_json_ld and r.status == "ok"
    urls = [(o.url, o.anchor) for o in r.outlinks]
    assert urls == [("http://b.example.com/dir/p1", "One bold"), ("http://b.example.com/p1?a=1&b=2", "dup"),
                    ("http://c.org/z", "ext")]
    ct = spark.createDataFrame([(1, "http://a.com/", HTML, "application/pdf")], "page_id long, url string, html string, ct string")
    r2 = PX.extract_pages(ct, content_type_col="ct", rules=U.SuffixRules(["com"])).first()
    assert r2.status == "fail" and r2.fail_reason == "NonHTML content-type" and r2.outlinks == []


def test_tags_are_read_in_one_pass(spark):
    html = ("<!-- <script type='application/ld+json'></script> --><div title='<a href=/in-value>x</a><base href=/b/>'>"
            "<script>var s = \"<script type='application/ld+json'><a href='/in-script'>\";</script>"
            "<base target=_top><base href='/dir/'><area href=m><a href=one>A <link rel=alternate hreflang=fr href=/fr><i title='</a>'>b</i> &amp; c"
            "<a rel='x, nofollow' href=two>no</a><a name=n>none</a><a href='three?x=1&amp;y=2'>open")
    df = spark.createDataFrame([(1, "http://a.com/p", html), (2, "http://a.com/q", ""), (3, "http://a.com/r", None)], "page_id long, url string, html string")
    rows = {r.page_id: r for r in PX.extract_pages(df, keep=("page_id",), rules=U.SuffixRules(["com"])).collect()}
    assert [(o.url, o.anchor) for o in rows[1].outlinks] == [
        ("http://a.com/dir/m", ""), ("http://a.com/dir/one", "A b & c"), ("http://a.com/dir/three?x=1&y=2", "open")]
    assert rows[1].hreflang_count == 1 and rows[1].has_json_ld is False
    assert [(rows[i].outlinks, rows[i].status, rows[i].title) for i in (2, 3)] == [([], "fail", None)] * 2
    plan = PX.extract_pages(df, rules=U.SuffixRules(["com"]))._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 400_000   # character references travel once for attributes, links and titles each


def test_rolloff_twice_is_once(spark):
    state = SC.conform(spark.createDataFrame([("u", 10, 4)], "url string, num_fetch_ok_90d int, num_fetch_fail_90d int"),
                       SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    counters = spark.createDataFrame([("u", "2024-01-01", 3, 5, True), ("u", "2024-03-01", 1, 1, True),
                                      ("gone", "2024-01-01", 1, 1, True)],
                                     "url string, d string, ok int, fail int, accounted boolean").select(
        "url", F.to_date("d").alias("event_date"), F.lit(0).alias("num_scheduled"), F.col("ok").alias("num_fetch_ok"),
        F.col("fail").alias("num_fetch_fail"), F.lit(0).alias("num_content_update"), "accounted", F.lit(1).alias("shard_id"))
    o1 = RO.rolloff(state, counters, "2024-02-01", "2024-05-01")
    ch = o1.changed.first()
    assert (ch.num_fetch_ok_90d, ch.num_fetch_fail_90d) == (7, 0)
    t = o1.totals.first()
    assert (t.picked, t.processed, t.missing, t.history, t.marked) == (2, 1, 1, 1, 2)
    o2 = RO.rolloff(state, o1.counters, "2024-02-01", "2024-05-01")
    assert o2.totals.first().picked == 0


def test_select_limits(spark):
    st = SC.conform(spark.createDataFrame([("u", 1, 0, True)], "url string, domain_id long, shard_id int, should_crawl boolean"),
                    SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    assert SL.select_by_domain(st, None, None, "example", 0, 5).count() == 0
    assert SL.select_by_domain(st, None, None, "example", 5, 1).count() == 1


def test_map_right_wins_and_reason_sum(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 5, "c": 1})], "x map<string,bigint>, y map<string,bigint>")
    assert dict(df.select(STS.map_right_wins(F.col("x"), F.col("y")).alias("m")).first().m) == {"a": 1, "b": 5, "c": 1}
    rows = spark.createDataFrame([("d", {"a": 1}), ("d", {"a": 2, "b": 1})], "k string, fail_reasons map<string,bigint>")
    assert dict(STS.sum_reason_maps(rows, ["k"], "fail_reasons").first().fail_reasons) == {"a": 3, "b": 1}


def test_parse_deltas_quarantine(spark):
    raw = spark.createDataFrame([('{"generated_at": "2024-01-02T00:00:00+00:00", "counters": {"num_fetch_ok": 2}}',),
                                 ("not json",), ("[1,2]",)], "value string")
    good, bad = STS.parse_deltas(raw)
    assert good.count() == 1 and bad.count() == 2


def test_oversize_sweep_bytes(spark):
    t = spark.createDataFrame([("u" * 2501, 1), ("é" * 1300, 1), ("ok", 2)], "url string, shard_id int")
    rows = RK.oversize_sweep({"url_state": t}).collect()
    assert [(r.table, r.shard_id, r.oversized) for r in rows] == [("url_state", 1, 2)]
    assert RK.drop_oversize(t).count() == 1


RULES = U.SuffixRules(["com", "org"])


def _links(spark, html):
    df = spark.createDataFrame([(1, "http://a.com/d/i.html", html)], "page_id long, url string, html string")
    return [(o.url, o.anchor) for o in PX.extract_pages(df, keep=("page_id",), rules=RULES).first().outlinks]


def test_links_of_hard_markup(spark):
    assert _links(spark, '<a title="a > b" href="/q1">x</a>') == [("http://a.com/q1", "x")]
    assert _links(spark, '<a href="/s?a=1&amp;b=2">x</a><a href="/p?x=&#38;z">y</a>') == [("http://a.com/s?a=1&b=2", "x"), ("http://a.com/p?x=&z=", "y")]
    assert _links(spark, "<a data-h='href=\"/no\"' href=/yes>k</a><!-- <a href=/c>c</a>") == [("http://a.com/yes", "k")]
    assert _links(spark, '<base href="/b&#47;x/"><a href="p">It&#8217;s</a>') == [("http://a.com/b/x/p", "It\u2019s")]
    assert _links(spark, "<a href=/1>one<a href=/2>two <b title='</a>'>b</b></a>") == [("http://a.com/1", "one"), ("http://a.com/2", "two b")]


def test_hostile_pages_are_linear(spark):
    import time
    pages = ["<script " * 27000, "<!--" * 55000, "<a title='" * 22000, "<a href=/x>" * 20000, "<title " * 30000, "</p>" * 55000]
    df = spark.createDataFrame([(k, "http://a.com/", h) for k, h in enumerate(pages)], "page_id long, url string, html string")
    begin = time.perf_counter()
    PX.extract_pages(df, keep=("page_id",), rules=RULES).write.format("noop").mode("overwrite").save()
    assert time.perf_counter() - begin < 20


def test_under_parents_once(spark):
    df = spark.createDataFrame([(1, "x.y.a.com"), (2, "a.com"), (3, "ba.com"), (4, None)], "k long, h string")
    parents = spark.createDataFrame([("a.com",), ("y.a.com",), ("a.com",)], "parent string")
    assert sorted((r.k, r.parent) for r in RK.under_parents(df, "h", parents).collect()) == [(1, "y.a.com"), (2, "a.com")]


def test_dns_names(spark):
    cases = {"localhost": True, "a" * 64 + ".com": True, "a" * 65 + ".com": False, "read more": False, "-a.com": False, "a..b": False, "A.com": False}
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    assert {r.h: r.d for r in df.select("h", RK.is_dns_host("h").alias("d")).collect()} == cases
