"""Queries for re-keying, whitelist refresh, golden injection, link graph and
feature upsert (RK-2..RK-6, AG-8..AG-10, SO-2, WT-9, UM-10, UM-12, UM-13, PF-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import golden as GD
from ..operators import ingest as IG
from ..operators import rekey as RK
from . import fixtures as FX
from . import sqlfrag as Q
from .ingest_queries import _FOLD_SQL
from .registry import register, table


def _fold_state(spark, sf_dir):
    f1 = FX.f1_fetches(spark, sf_dir)
    return IG.final_images(IG.fold_results(FX.f2_old_state(spark, f1), f1, FX.AS_OF))


_HOSTS_SQL = f"""
{_FOLD_SQL},
hc AS (SELECT nullif(lower(regexp_extract(url, '^https?://([^/:]+)', 1)), '') AS host, count(*) AS n
       FROM fold WHERE is_last AND last_fetch_ok IS NOT NULL GROUP BY 1 HAVING host IS NOT NULL)
"""


@register("host_counts", oracle=f"WITH {_HOSTS_SQL} SELECT host, n FROM hc")
def host_counts(spark, sf_dir):
    """AG-8: ok-fetched rows per host."""
    return RK.host_counts(_fold_state(spark, sf_dir)).select("host", "n")


@register("top_hosts", oracle=f"WITH {_HOSTS_SQL} SELECT host, n FROM hc ORDER BY n DESC, host LIMIT 20")
def top_hosts(spark, sf_dir):
    """WT-9: top-20 host candidates by count."""
    return RK.top_hosts(RK.host_counts(_fold_state(spark, sf_dir)), 20).select("host", "n")


@register("projected_shards", oracle=f"""
WITH {_HOSTS_SQL}
SELECT CAST(('0x' || right(md5(host), 2)) AS INTEGER) AS new_shard, count(*) AS hosts, CAST(sum(n) AS BIGINT) AS rows
FROM hc GROUP BY 1
""")
def projected_shards(spark, sf_dir):
    """AG-10: shard distribution if every host were split out."""
    return RK.projected_shards(RK.host_counts(_fold_state(spark, sf_dir)))


@register("whitelist_diff", oracle=f"""
WITH {_HOSTS_SQL},
wl AS (SELECT host FROM hc WHERE CAST(regexp_extract(host, '^h([0-9]+)', 1) AS INTEGER) % 4 = 0),
rb AS (SELECT host, CASE WHEN CAST(regexp_extract(host, '^h([0-9]+)', 1) AS INTEGER) % 3 = 0 THEN 'blocked' ELSE 'ok' END AS status FROM hc)
SELECT hc.host, hc.n, CASE WHEN wl.host IS NOT NULL AND rb.status = 'blocked' THEN 'REMOVE' WHEN wl.host IS NOT NULL THEN 'KEEP'
  WHEN hc.n >= 150 AND rb.status = 'ok' THEN 'ADD' END AS action
FROM hc LEFT JOIN wl USING (host) LEFT JOIN rb USING (host)
WHERE wl.host IS NOT NULL OR (hc.n >= 150 AND rb.status = 'ok')
""")
def whitelist_diff(spark, sf_dir):
    """SO-2: ADD / REMOVE / KEEP labels for split-whitelist refresh
    (whitelist and robots status derived from the host number)."""
    counts = RK.host_counts(_fold_state(spark, sf_dir))
    num = F.regexp_extract("host", "^h([0-9]+)", 1).cast("int")
    wl = counts.filter(num % 4 == 0).select("host", F.lit(None).cast("timestamp").alias("migrated_at"))
    robots = counts.select("host", F.when(num % 3 == 0, "blocked").otherwise("ok").alias("status"))
    return RK.whitelist_diff(counts, wl, robots, 150, rules=FX.SUFFIX_RULES)


_F12 = f"""
st AS ({FX.F6_SQL}),
pend AS (SELECT DISTINCT 'h' || o_custkey || '.example.com' AS host FROM orders WHERE o_custkey % 5 = 0)
"""


def _f12(spark, sf_dir):
    st = FX.f6_selection_state(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    pend = (o.filter(F.col("o_custkey") % 5 == 0)
            .select(F.concat(F.lit("h"), F.col("o_custkey").cast("string"), F.lit(".example.com")).alias("host"))
            .distinct().withColumn("migrated_at", F.lit(None).cast("timestamp")))
    return st, pend


@register("split_plan", oracle=f"""
WITH {_F12}
SELECT url, lower(regexp_extract(url, '^https?://([^/:]+)', 1)) AS host,
  CAST(('0x' || right(md5(lower(regexp_extract(url, '^https?://([^/:]+)', 1))), 2)) AS INTEGER) AS new_shard_id
FROM st WHERE lower(regexp_extract(url, '^https?://([^/:]+)', 1)) IN (SELECT host FROM pend)
""")
def split_plan(spark, sf_dir):
    """RK-2 / RK-7 (dry run): rows that move when pending hosts are split out."""
    st, pend = _f12(spark, sf_dir)
    return RK.plan_split(st, RK.pending_hosts(pend)).select("url", "host", "new_shard_id")


@register("split_apply", oracle=f"""
WITH {_F12},
al AS (SELECT url, domain_id, shard_id, 'old' AS title FROM st UNION ALL
       SELECT url, domain_id + 100000, (shard_id + 1) % 256, 'target' FROM st WHERE CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) % 10 = 0),
mv AS (SELECT *, domain_id < 100000 AND lower(regexp_extract(url, '^https?://([^/:]+)', 1)) IN (SELECT host FROM pend) AS moves FROM al)
SELECT url, domain_id, shard_id, title FROM mv WHERE NOT moves
UNION ALL SELECT url, domain_id + 100000, (CAST(('0x' || right(md5(lower(regexp_extract(url, '^https?://([^/:]+)', 1))), 2)) AS INTEGER) + 1) % 256, title FROM mv
WHERE moves AND url NOT IN (SELECT url FROM mv WHERE NOT moves)
""")
def split_apply(spark, sf_dir):
    """RK-2: rows of split hosts move to (new domain id, new shard) unless the target has the
    URL already; others are untouched."""
    st, pend = _f12(spark, sf_dir)
    number = F.regexp_extract("url", "([0-9]+)$", 1).cast("long")
    st = st.withColumn("title", F.lit("old"))
    target = st.where(number % 10 == 0).withColumn("domain_id", F.col("domain_id") + 100000).withColumn(
        "shard_id", ((F.col("shard_id") + 1) % 256).cast("int")).withColumn("title", F.lit("target"))
    mapping = RK.plan_split(st, pend).select("domain_id", (F.col("domain_id") + 100000).alias("new_domain_id"),
                                             ((F.col("new_shard_id") + 1) % 256).cast("int").alias("new_shard_id")).distinct()
    return RK.rekey(st.unionByName(target), mapping, "domain_id").select("url", "domain_id", "shard_id", "title")


def _odd_domain():
    """Registry values that aren't plain domains: one label, anchor text, labels at the length bound, a leading hyphen."""
    p, digit = F.col("page_id").cast("string"), (F.col("page_id") % 10).cast("string")
    return (F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("localhost"), p)).when(F.col("page_id") % 5 == 1, F.concat(F.lit("read more: "), p))
            .when(F.col("page_id") % 5 == 2, F.concat(F.lit("a" * 63), digit, F.lit(".com")))
            .when(F.col("page_id") % 5 == 3, F.concat(F.lit("b" * 64), digit, F.lit(".com"))).otherwise(F.concat(F.lit("-x"), p, F.lit(".org"))))


@register("classify_domains", oracle=f"""
WITH dom AS ({FX.F5_SQL}),
r AS (SELECT domain_id, domain FROM dom UNION ALL
      SELECT 100000 + page_id, lower(regexp_extract(url, '^https?://([^/:]+)', 1)) FROM pages UNION ALL
      SELECT 200000 + page_id, CASE page_id % 5 WHEN 0 THEN 'localhost' || page_id WHEN 1 THEN 'read more: ' || page_id WHEN 2 THEN repeat('a', 63) || page_id % 10 || '.com'
        WHEN 3 THEN repeat('b', 64) || page_id % 10 || '.com' ELSE '-x' || page_id || '.org' END FROM pages),
k AS (SELECT *, nullif(regexp_extract(domain, '([^.]+\\.(?:com|org|net))$', 1), '') AS canonical FROM r)
SELECT domain_id, domain, canonical,
  CASE WHEN NOT regexp_matches(domain, '^[a-z0-9]([a-z0-9-]{{0,62}}[a-z0-9])?(\\.[a-z0-9]([a-z0-9-]{{0,62}}[a-z0-9])?)*$') THEN 'junk'
       WHEN canonical IS NULL THEN 'unparseable' WHEN canonical = domain THEN 'clean' ELSE 'dirty' END AS kind
FROM k
""")
def classify_domains(spark, sf_dir):
    """RK-6 / PF-10: clean / dirty / unparseable / junk registry domains."""
    reg = FX.f5_domain_state(spark, sf_dir).select("domain_id", "domain").unionByName(
        table(spark, sf_dir, "pages").select((F.col("page_id") + 100000).alias("domain_id"),
                                             F.lower(F.regexp_extract("url", "^https?://([^/:]+)", 1)).alias("domain"))).unionByName(
        table(spark, sf_dir, "pages").select((F.col("page_id") + 200000).alias("domain_id"), _odd_domain().alias("domain")))
    return RK.classify_domains(reg, FX.SUFFIX_RULES)


_HOST = Q.host("url")
_F10 = f"""
f3 AS ({FX.F3_SQL}),
dom AS ({FX.F5_SQL}),
mb AS (SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS id, date_trunc('month', o_orderdate) AS created_at FROM orders),
mq AS (SELECT o_orderkey AS id, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS batch_id FROM orders),
mu AS (SELECT l_orderkey AS query_id, CASE WHEN l_linenumber = 7 THEN 'http://localhost/' || l_orderkey
         WHEN l_linenumber = 6 AND l_partkey % 10 = 0 THEN dst || repeat('x', 2500) ELSE dst END AS url FROM f3),
cand AS (SELECT url, count(*) AS n FROM mu WHERE query_id IN (SELECT id FROM mq WHERE batch_id IN
          (SELECT id FROM mb WHERE created_at <= TIMESTAMP '1998-06-01' - INTERVAL 28 DAY)) GROUP BY url),
old AS ({FX.F3_OLD_SQL}),
c AS (SELECT url, n, CASE WHEN length(url) <= 2500 THEN {Q.REG.format(h=_HOST)} END AS k, url IN (SELECT url FROM old) AS known FROM cand),
newk AS (SELECT k, row_number() OVER (ORDER BY CAST(('0x' || right(md5(k), 2)) AS INTEGER), k) AS rn
         FROM (SELECT DISTINCT k FROM c WHERE k IS NOT NULL) WHERE k NOT IN (SELECT domain FROM dom)),
reg AS (SELECT domain AS k, domain_id, domain_score FROM dom
        UNION ALL SELECT k, CAST((SELECT max(domain_id) FROM dom) + rn AS BIGINT), 0.0 FROM newk)
"""
_OVERRIDES = {"example.net": 7}


def _f10(spark, sf_dir, dry_run=False):
    o = table(spark, sf_dir, "orders")
    ym = F.date_format("o_orderdate", "yyyyMM").cast("int")
    mb = o.select(ym.alias("id"), F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("created_at")).distinct()
    mq = o.select(F.col("o_orderkey").alias("id"), ym.alias("batch_id"))
    f3 = FX.f3_links(spark, sf_dir)
    url = (F.when(F.col("l_linenumber") == 7, F.concat(F.lit("http://localhost/"), F.col("l_orderkey").cast("string")))
           .when((F.col("l_linenumber") == 6) & (F.col("l_partkey") % 10 == 0), F.concat("dst", F.repeat(F.lit("x"), F.lit(2500))))
           .otherwise(F.col("dst")))
    mu = f3.select(F.col("l_orderkey").alias("query_id"), url.alias("url"))
    cand = GD.injectable_urls(mb, mq, mu, "1998-06-01 00:00:00", 28)
    return GD.inject(FX.f3_old_state(spark, f3), FX.f5_domain_state(spark, sf_dir), cand, "1998-06-01 00:00:00",
                     overrides=_OVERRIDES, rules=FX.SUFFIX_RULES, dry_run=dry_run)


@register("golden_inject_counts", oracle=f"""
WITH {_F10}
SELECT CAST(count(*) FILTER (WHERE k IS NOT NULL AND NOT known) AS BIGINT) AS injected,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NOT NULL), 0) - count(*) FILTER (WHERE k IS NOT NULL AND NOT known) AS BIGINT) AS marked,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS failed FROM c
""")
def golden_inject_counts(spark, sf_dir):
    """UM-12 / PF-12 / SS-10: injected / marked / failed records (repeats, hosts without
    a registrable domain and oversized URLs included)."""
    return _f10(spark, sf_dir).counts


@register("golden_inject_dry_run", oracle=f"""
WITH {_F10}
SELECT CAST(coalesce(sum(n) FILTER (WHERE k IS NOT NULL), 0) AS BIGINT) AS injected, CAST(0 AS BIGINT) AS marked,
  CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS failed FROM c
""")
def golden_inject_dry_run(spark, sf_dir):
    """UM-12 dry run: every record that doesn't fail would be injected."""
    return _f10(spark, sf_dir, dry_run=True).counts


_INSERTED = f"""SELECT url, CAST(1 AS SMALLINT) AS source, reg.domain_id, reg.domain_score,
  CASE WHEN k = 'example.net' THEN 7 ELSE {Q.shard256('k')} END AS shard_id FROM c JOIN reg USING (k) WHERE NOT known"""


@register("golden_inject_rows", oracle=f"WITH {_F10} {_INSERTED}")
def golden_inject_rows(spark, sf_dir):
    """UM-12: inserted golden URLs (source = 1; id, score and shard of the domain)."""
    return _f10(spark, sf_dir).inserted.select("url", "source", "domain_id", "domain_score", "shard_id")


@register("golden_inject_history", oracle=f"WITH {_F10} SELECT *, TIMESTAMP '1998-06-01' AS snapshot_at FROM ({_INSERTED})")
def golden_inject_history(spark, sf_dir):
    """UM-12: one history row per inserted URL, none for marked ones."""
    return _f10(spark, sf_dir).history


@register("golden_inject_marked", oracle=f"""
WITH {_F10} SELECT c.url, CAST(1 AS SMALLINT) AS source, old.inlink_count_approx, old.anchor_text FROM c JOIN old USING (url) WHERE k IS NOT NULL
""")
def golden_inject_marked(spark, sf_dir):
    """UM-12: known URLs keep their row and get source = 1."""
    return _f10(spark, sf_dir).marked.select("url", "source", "inlink_count_approx", "anchor_text")


@register("golden_inject_registry", oracle=f"WITH {_F10} SELECT k AS domain, domain_id FROM reg")
def golden_inject_registry(spark, sf_dir):
    """UM-12 / RJ-1: the registry after get-or-create of the injected domains."""
    return _f10(spark, sf_dir).registry.select("domain", "domain_id")


@register("link_graph_edges", oracle=f"""
WITH f3 AS ({FX.F3_SQL}),
al AS (SELECT src, dst, anchor, CAST(l_shipdate AS TIMESTAMP) AS a, CAST(l_shipdate AS TIMESTAMP) AS b FROM f3 UNION ALL
       SELECT src, dst, anchor, CAST(l_shipdate AS TIMESTAMP) - INTERVAL 400 DAY, CAST(l_shipdate AS TIMESTAMP) - INTERVAL 300 DAY FROM f3 WHERE l_linenumber = 1 AND l_orderkey % 4 = 0)
SELECT src, dst, md5(anchor) AS anchor_md5, min(a) AS first_seen, max(b) AS last_seen FROM al GROUP BY 1, 2, 3
""")
def link_graph_edges(spark, sf_dir):
    """UM-13: new sightings upserted into stored link-graph edges, keyed by (src, dst, md5(anchor))."""
    f3 = FX.f3_links(spark, sf_dir)
    day = F.col("l_shipdate").cast("timestamp")
    old = f3.where("l_linenumber = 1 AND l_orderkey % 4 = 0").select(
        "src", "dst", F.unhex(F.md5("anchor")).alias("anchor_md5"), (day - F.expr("INTERVAL 400 DAY")).alias("first_seen"), (day - F.expr("INTERVAL 300 DAY")).alias("last_seen"))
    e = GD.link_edges(old, f3.withColumn("seen_at", day))
    return e.select("src", "dst", F.lower(F.hex("anchor_md5")).alias("anchor_md5"), "first_seen", "last_seen")


@register("feature_upsert", oracle=f"""
WITH f1 AS ({FX.F1_SQL}), ev AS (SELECT event_id, value FROM events),
rec AS (SELECT f1.seq, url, domain_id, fetched_at, CAST(floor(ev.value * 10) AS INTEGER) AS content_length, content_hash,
          CAST(seq % 7 AS INTEGER) AS num_links FROM f1 JOIN ev ON ev.event_id = f1.seq WHERE status = 'ok'),
cur AS (SELECT DISTINCT url, CAST(999 AS BIGINT) AS domain_id FROM f1 WHERE u < 350),
lst AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS r,
          first_value(domain_id) OVER (PARTITION BY url ORDER BY seq) AS fd FROM rec)
SELECT l.url, coalesce(c.domain_id, l.fd) AS domain_id, l.fetched_at, l.content_length, l.content_hash, l.num_links
FROM lst l LEFT JOIN cur c USING (url) WHERE l.r = 1
UNION ALL
SELECT url, domain_id, NULL, NULL, NULL, NULL FROM cur WHERE url NOT IN (SELECT url FROM rec)
""")
def feature_upsert(spark, sf_dir):
    """UM-10: content-feature upsert (last record wins, first domain kept)."""
    f1 = FX.f1_fetches(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "value")
    rec = f1.filter(F.col("status") == "ok").join(ev, "seq").select(
        "seq", "url", "domain_id", "fetched_at", F.floor(F.col("value") * 10).cast("int").alias("content_length"),
        "content_hash", (F.col("seq") % 7).cast("int").alias("num_links"), "shard_id")
    cur = f1.filter(F.col("u") < 350).select("url").distinct().select(
        "url", F.lit(999).cast("long").alias("domain_id"), F.lit(None).cast("timestamp").alias("fetched_at"),
        F.lit(None).cast("int").alias("content_length"), F.lit(None).cast("string").alias("content_hash"),
        F.lit(None).cast("int").alias("num_links"), F.lit(None).cast("int").alias("shard_id"))
    new, _ = GD.upsert_features(cur, rec)
    return new.drop("shard_id")


@register("split_counters", oracle=f"""
WITH {_F12}
SELECT url, CAST(CAST(first_seen AS DATE) AS VARCHAR) AS event_date, num_scheduled_90d AS num_scheduled,
  CAST(('0x' || right(md5(lower(regexp_extract(url, '^https?://([^/:]+)', 1))), 2)) AS INTEGER) AS shard_id
FROM st WHERE lower(regexp_extract(url, '^https?://([^/:]+)', 1)) IN (SELECT host FROM pend)
""")
def split_counters(spark, sf_dir):
    """RK-2: counter rows of moved URLs take the shard of their host."""
    st, pend = _f12(spark, sf_dir)
    counters = st.select("url", F.to_date("first_seen").alias("event_date"), F.col("num_scheduled_90d").alias("num_scheduled"), F.lit(300).alias("shard_id"))
    moved = RK.plan_split(st, RK.pending_hosts(pend)).select("url", F.col("new_shard_id").alias("shard_id"))
    return RK.follow_counters(counters, moved).select("url", F.col("event_date").cast("string").alias("event_date"), "num_scheduled", "shard_id")
