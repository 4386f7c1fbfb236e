"""Queries for operators that stand alone: fetch metadata, bucket folders, quarantine, sweeps,
whitelist upkeep, log parsing and pairing, trailing windows, scheduling metrics, schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schema as SC
from ..functions import fetch as FT
from ..operators import golden as GD
from ..operators import ingest as IG
from ..operators import pages as PX
from ..operators import rekey as RK
from ..operators import rolloff as RO
from ..operators import routing as RT
from ..operators import select as SL
from ..operators import stats as STS
from ..session import ensure_checkpoint_dir
from ..sources import buckets
from ..streaming import logs as LG
from . import fixtures as FX
from .accounting_queries import _F8, f8_delta_json
from .ingest_queries import _FOLD_SQL, _LINK_AGG_SQL
from .registry import register, table
from .select_queries import _ELIGIBLE, _PICKED_EXAMPLE, _URL_ORDER, CAP, MAX_DOMAINS, _inputs


def _folder(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------ fetch metadata (SC-18..SC-20)

@register("http_dates", oracle="""
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 4 THEN NULL WHEN 3 THEN strftime(d - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+00:00')
  WHEN 5 THEN strftime(d + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(d, '%Y-%m-%dT%H:%M:%S+00:00') END AS last_modified
FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS d FROM orders)
""")
def http_dates(spark, sf_dir):
    """SC-18: HTTP dates in mail, hyphen and ctime form, with offsets and named zones, and no dates."""
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(k % 86400).cast("decimal(18,6)"))
    form = lambda p: F.date_format(d, p)
    raw = (F.when(k % 6 == 0, F.concat(form("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).when(k % 6 == 1, F.concat(form("EEEE, dd-MMM-yy HH:mm:ss"), F.lit(" GMT")))
           .when(k % 6 == 2, form("EEE MMM dd HH:mm:ss yyyy")).when(k % 6 == 3, F.concat(form("dd MMM yyyy HH:mm:ss"), F.lit(" +0200")))
           .when(k % 6 == 4, F.concat(F.lit("yesterday, "), form("yyyy"))).otherwise(F.concat(form("EEE, d MMM yyyy HH:mm:ss"), F.lit(" EST"))))
    return table(spark, sf_dir, "orders").select("o_orderkey", FT.iso_utc(FT.http_date(raw)).alias("last_modified"))


@register("fetch_headers", oracle="""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'W/"' || o_orderkey || '"' ELSE repeat('x', 500) END AS etag,
  o_orderkey % 3 > 0 AS is_redirect,
  CASE o_orderkey % 5 WHEN 0 THEN 'HttpError ' || (400 + o_orderkey % 7) WHEN 1 THEN 'IgnoreRequest exceeded DOWNLOAD_MAXSIZE'
    WHEN 2 THEN 'IgnoreRequest Forbidden by robots.txt' WHEN 3 THEN 'TimeoutError' ELSE 'HttpError None' END AS fail_reason FROM orders
""")
def fetch_headers(spark, sf_dir):
    """SC-19 / SC-20: header trim, redirect flag, fail-reason normalisation."""
    k = F.col("o_orderkey")
    etag = (F.when(k % 4 == 0, F.lit(" \t ")).when(k % 4 == 1, F.concat(F.lit('  W/"'), k.cast("string"), F.lit('"\r\n')))
            .otherwise(F.concat(F.lit(" "), F.repeat(F.lit("x"), F.lit(700)))))
    kind = F.when(k % 5 == 3, "TimeoutError").when((k % 5 == 0) | (k % 5 == 4), "HttpError").otherwise("IgnoreRequest")
    status = F.when(k % 5 == 0, 400 + k % 7)
    text = F.when(k % 5 == 1, F.concat(F.lit("Cancelling: size "), k.cast("string"), F.lit(" exceeded DOWNLOAD_MAXSIZE (9)"))).otherwise(F.lit("Forbidden by robots.txt"))
    return table(spark, sf_dir, "orders").select("o_orderkey", FT.header_text(etag).alias("etag"), FT.is_redirect(F.nullif(k % 3, F.lit(0))).alias("is_redirect"),
                                                 FT.fail_reason(kind, status, text).alias("fail_reason"))


@register("content_type_gate", oracle="""
SELECT page_id, CASE WHEN page_id % 4 IN (0, 1) THEN 'ok' ELSE 'fail' END AS status, CASE WHEN page_id % 4 IN (2, 3) THEN 'NonHTML content-type' END AS fail_reason
FROM pages WHERE length(html) > 0
""")
def content_type_gate(spark, sf_dir):
    """PX-5: only HTML content types are read."""
    p = F.col("page_id") % 4
    pages = table(spark, sf_dir, "pages").where("length(html) > 0").withColumn(
        "ct", F.when(p == 0, "text/HTML; charset=utf-8").when(p == 1, "application/xhtml+xml").when(p == 2, "application/pdf"))
    return PX.extract_pages(pages, content_type_col="ct", keep=("page_id",), rules=FX.SUFFIX_RULES).select("page_id", "status", "fail_reason")


# ------------------------------------------------------------ bucket folders (SS-1..SS-4, SC-21)

_SRC_SQL = f"WITH f1 AS ({FX.F1_SQL}), b AS (SELECT *, time_bucket(INTERVAL '60 minutes', fetched_at) AS s FROM f1)"


def _bucketed(spark, sf_dir):
    path = _folder(spark, "buckets")
    f1 = FX.f1_fetches(spark, sf_dir).select(F.col("seq").alias("n"), "url", "status", "fetched_at")
    buckets.write_buckets(f1.repartition(4), path, "fetched_at", 60)
    schema = f1.withColumn("fetched_at", F.col("fetched_at").cast("string")).schema
    return path, schema


@register("bucket_records", oracle=f"""{_SRC_SQL}
SELECT seq AS n, url, status, strftime(s, '%Y%m%d') AS bucket_date, strftime(s, '%H%M') AS bucket_time FROM b
""")
def bucket_records(spark, sf_dir):
    """SS-1 / SS-4 / SC-21: records written into interval folders and read back with their bucket."""
    path, schema = _bucketed(spark, sf_dir)
    return buckets.read_records(spark, path, schema).select("n", "url", "status", "bucket_date", "bucket_time")


@register("bucket_ready", oracle=f"""{_SRC_SQL}
SELECT max(strftime(s, '%Y%m%d%H%M')) AS last_bucket, count(*) AS n FROM b
WHERE s + INTERVAL '120 minutes' <= TIMESTAMP '2024-01-15 12:30:00' AND strftime(s, '%Y%m%d%H%M') > '202401050000'
""")
def bucket_ready(spark, sf_dir):
    """SS-2 / SS-3: the records of ready buckets behind the mark, and the new mark."""
    path, schema = _bucketed(spark, sf_dir)
    r = buckets.read_buckets(spark, path, schema, "2024-01-15 12:30:00", 60, after="202401050000")
    return r.agg(F.max(F.concat("bucket_date", "bucket_time")).alias("last_bucket"), F.count("*").alias("n"))


@register("stats_quarantine", oracle=f"""
WITH {_F8}, h AS (SELECT DISTINCT date_trunc('hour', fetched_at) AS hr FROM f1)
SELECT 'good' AS kind, count(*) AS n FROM h UNION ALL SELECT 'bad', 3 * count(*) FROM h
""")
def stats_quarantine(spark, sf_dir):
    """SS-9: malformed deltas are set aside and counted: cut text, an array, and no JSON for every good one."""
    docs = f8_delta_json(spark, sf_dir)
    bad = docs.select(F.explode(F.array(F.substring("value", 1, 40), F.concat(F.lit("["), "value", F.lit("]")), F.lit("oops"))).alias("value"))
    good, rejected = STS.parse_deltas(docs.unionByName(bad))
    return (good.agg(F.count("*").alias("n")).select(F.lit("good").alias("kind"), "n")
            .unionByName(rejected.agg(F.count("*").alias("n")).select(F.lit("bad").alias("kind"), "n")))


# ------------------------------------------------------------ filters, sweeps, schemas

@register("ingest_oversize_dropped", oracle=f"""
WITH f1 AS ({FX.F1_SQL}) SELECT count(*) FILTER (WHERE seq % 5 > 0) AS kept, count(*) FILTER (WHERE seq % 5 = 0) AS dropped FROM f1
""")
def ingest_oversize_dropped(spark, sf_dir):
    """PF-1 / PF-2: URLs over the length bound and null URLs never reach the fold."""
    f1 = FX.f1_fetches(spark, sf_dir)
    url = F.when(F.col("seq") % 10 == 0, F.concat("url", F.repeat(F.lit("é"), F.lit(2500)))).when(F.col("seq") % 5 > 0, F.col("url"))
    kept = IG.decode_results(f1.withColumn("url", url), FX.AS_OF)
    return kept.agg(F.count("*").alias("kept")).crossJoin(f1.agg(F.count("*").alias("n"))).select("kept", (F.col("n") - F.col("kept")).alias("dropped"))


@register("ingest_text_times", oracle=f"""
WITH f1 AS ({FX.F1_SQL}) SELECT seq, CASE seq % 4 WHEN 3 THEN {FX.AS_OF_SQL} WHEN 1 THEN fetched_at - INTERVAL 2 HOUR ELSE fetched_at END AS fetched_at FROM f1
""")
def ingest_text_times(spark, sf_dir):
    """PF-9: ISO text times with zone, with offset and bare; bad ones take the batch's time."""
    f1 = FX.f1_fetches(spark, sf_dir)
    iso = F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(F.col("seq") % 4 == 0, F.concat(iso, F.lit("+00:00"))).when(F.col("seq") % 4 == 1, F.concat(iso, F.lit("+02:00")))
            .when(F.col("seq") % 4 == 2, iso).otherwise(F.lit("not a time")))
    return IG.decode_results(f1.withColumn("fetched_at", text), FX.AS_OF).select("seq", "fetched_at")


@register("oversize_sweep", oracle=f"""
WITH st AS ({FX.F6_SQL}) SELECT 'url_state' AS "table", shard_id, count(*) AS oversized FROM st WHERE domain_id % 3 = 0 GROUP BY shard_id
""")
def oversize_sweep(spark, sf_dir):
    """PF-3 / SO-3: dry-run count of URLs over 2500 bytes (two-byte characters count twice) per shard."""
    st = FX.f6_selection_state(spark, sf_dir)
    long = F.concat("url", F.repeat(F.lit("é"), F.lit(1250)))
    return RK.oversize_sweep({"url_state": st.withColumn("url", F.when(F.col("domain_id") % 3 == 0, long).otherwise(F.col("url")))})


@register("hosts_under_parents", oracle="""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/:]+)', 1)) AS host FROM pages),
p AS (SELECT DISTINCT regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS parent FROM h WHERE page_id % 2 = 0
      UNION SELECT DISTINCT host FROM h WHERE page_id % 7 = 0),
m AS (SELECT page_id, host, parent, row_number() OVER (PARTITION BY page_id ORDER BY length(parent) DESC) AS r FROM h JOIN p ON host = parent OR ends_with(host, '.' || parent))
SELECT page_id, host, parent FROM m WHERE r = 1
""")
def hosts_under_parents(spark, sf_dir):
    """PF-11: rows below a parent come out once, with the longest parent."""
    h = table(spark, sf_dir, "pages").select("page_id", F.lower(F.regexp_extract("url", "^https?://([^/:]+)", 1)).alias("host"))
    parents = (h.where("page_id % 2 = 0").select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("parent"))
               .unionByName(h.where("page_id % 7 = 0").select(F.col("host").alias("parent"))))
    return RK.under_parents(h, "host", parents).select("page_id", "host", "parent")


@register("conformed_state", oracle="""
SELECT 'u' || o_orderkey AS url, CAST(o_custkey AS BIGINT) AS domain_id, CAST(0 AS INTEGER) AS num_fetch_ok_90d, true AS should_crawl, CAST(0 AS DOUBLE) AS url_score,
  CAST(NULL AS VARCHAR) AS title, CAST(34 AS INTEGER) AS n_columns FROM orders
""")
def conformed_state(spark, sf_dir):
    """SK-1: older rows take the columns of the schema, defaults and types, extra columns go."""
    old = table(spark, sf_dir, "orders").select(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"), F.col("o_custkey").cast("int").alias("domain_id"),
                                                F.col("o_comment").alias("not_in_schema") if "o_comment" in table(spark, sf_dir, "orders").columns else F.lit(1).alias("not_in_schema"))
    new = SC.conform(old, SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    return new.select("url", "domain_id", "num_fetch_ok_90d", "should_crawl", "url_score", "title", F.lit(len(new.columns)).alias("n_columns"))


@register("json_map_merge", oracle=f"""
WITH f1 AS ({FX.F1_SQL}) SELECT seq, 'b' || seq AS shared, 'a' || u AS left_only, 'c' || seq AS right_only FROM f1
""")
def json_map_merge(spark, sf_dir):
    """SC-24: keys of the right map overwrite those of the left."""
    f1 = FX.f1_fetches(spark, sf_dir)
    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    m = STS.map_right_wins(F.create_map(F.lit("l"), text("a", "u"), F.lit("s"), text("x", "u")), F.create_map(F.lit("s"), text("b", "seq"), F.lit("r"), text("c", "seq")))
    return f1.select("seq", m["s"].alias("shared"), m["l"].alias("left_only"), m["r"].alias("right_only"))


# ------------------------------------------------------------ whitelist and rolloff

_WL = """
h AS (SELECT DISTINCT lower(regexp_extract(url, '^https?://([^/:]+)', 1)) AS host FROM pages),
k AS (SELECT host, CAST(('0x' || right(md5(host), 4)) AS INTEGER) AS k FROM h)
"""


def _hosts(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select(F.lower(F.regexp_extract("url", "^https?://([^/:]+)", 1)).alias("host")).distinct()
    return h.withColumn("k", F.conv(F.right(F.md5("host"), F.lit(4)), 16, 10).cast("int"))


@register("whitelist_final", oracle=f"""
WITH {_WL},
cur AS (SELECT host, CASE WHEN k % 2 = 0 THEN TIMESTAMP '2024-01-01' END AS migrated_at FROM k WHERE k % 3 = 0),
ad AS (SELECT host FROM k WHERE k % 5 = 0), rm AS (SELECT host FROM k WHERE k % 7 = 0)
SELECT host, CASE WHEN host IN (SELECT host FROM k WHERE k % 2 = 1) AND migrated_at IS NULL THEN TIMESTAMP '2024-02-01' ELSE migrated_at END AS migrated_at
FROM (SELECT * FROM cur UNION ALL SELECT host, NULL FROM ad WHERE host NOT IN (SELECT host FROM cur)) WHERE host NOT IN (SELECT host FROM rm)
""")
def whitelist_final(spark, sf_dir):
    """SO-2 / SK-2 / PF-14: (current + ADD) - REMOVE, then some pending hosts are stamped."""
    k = _hosts(spark, sf_dir)
    cur = k.where("k % 3 = 0").select("host", F.when(F.col("k") % 2 == 0, F.lit("2024-01-01").cast("timestamp")).alias("migrated_at"))
    diff = (k.where("k % 5 = 0").select("host", F.lit("ADD").alias("action")).unionByName(k.where("k % 7 = 0").select("host", F.lit("REMOVE").alias("action"))))
    final = RK.apply_whitelist_diff(cur, diff, FX.AS_OF)
    return RK.mark_migrated(final, k.where("k % 2 = 1").select("host"), "2024-02-01")


@register("error_rate_parents", oracle=f"""
WITH dom AS ({FX.F5_SQL}), f1 AS ({FX.F1_SQL}),
s AS (SELECT domain_id, CAST(fetched_at AS DATE) AS d, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status <> 'ok') AS fail FROM f1 GROUP BY ALL),
a AS (SELECT domain, CAST(sum(ok) AS BIGINT) AS ok, CAST(sum(fail) AS BIGINT) AS fail FROM s JOIN dom USING (domain_id) WHERE d >= DATE '2024-01-10' GROUP BY domain)
SELECT domain, ok, fail, ok + fail AS attempts, CAST(fail AS DOUBLE) / nullif(ok + fail, 0) AS fail_ratio FROM a WHERE ok + fail >= 20 ORDER BY fail_ratio DESC, domain LIMIT 10
""")
def error_rate_parents(spark, sf_dir):
    """AG-9: the ten domains with the highest fail ratio, of those with enough attempts."""
    ok = F.col("status") == "ok"
    stats = FX.f1_fetches(spark, sf_dir).groupBy("domain_id", F.to_date("fetched_at").alias("event_date")).agg(
        F.count_if(ok).alias("num_fetch_ok"), F.count_if(~ok).alias("num_fetch_fail"))
    return RK.error_rate_parents(stats, FX.f5_domain_state(spark, sf_dir), "2024-01-10", 20, 10)


@register("rolloff_limited", oracle=f"""
WITH c AS ({FX.F4_SQL}), p AS (SELECT url, event_date FROM c WHERE event_date <= DATE '2024-01-10' ORDER BY event_date, url LIMIT 50)
SELECT c.url, CAST(c.event_date AS VARCHAR) AS event_date, p.url IS NULL AS accounted FROM c LEFT JOIN p USING (url, event_date)
""")
def rolloff_limited(spark, sf_dir):
    """WT-8: with a limit, the oldest rows by (day, url) are rolled off and marked, no others."""
    counters = SC.conform(FX.f4_counters(spark, sf_dir), SC.URL_EVENT_COUNTER, SC.COUNTER_DEFAULTS)
    out = RO.rolloff(SC.empty(spark, SC.URL_STATE), counters, "2024-01-10", FX.AS_OF, limit=50)
    return out.counters.select("url", F.col("event_date").cast("string").alias("event_date"), "accounted")


# ------------------------------------------------------------ scheduling metrics (AG-7, SS-8)

_PICKED = f"""
WITH {_ELIGIBLE},
d AS (SELECT shard_id, domain_id, row_number() OVER (PARTITION BY shard_id ORDER BY domain_id) AS r FROM (SELECT DISTINCT shard_id, domain_id FROM el)),
c AS (SELECT el.shard_id, el.domain_id, row_number() OVER (PARTITION BY el.shard_id, el.domain_id ORDER BY {_URL_ORDER}) AS url_rank
      FROM el JOIN d ON el.shard_id = d.shard_id AND el.domain_id = d.domain_id AND d.r <= {MAX_DOMAINS}), pk AS (SELECT * FROM c WHERE url_rank <= {CAP})
"""


def _picked(spark, sf_dir):
    st, dom, q = _inputs(spark, sf_dir)
    return SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)


@register("schedule_domain_metrics", oracle=f"{_PICKED} SELECT domain_id, count(*) AS num_scheduled FROM pk GROUP BY domain_id")
def schedule_domain_metrics(spark, sf_dir):
    """AG-7: URLs scheduled per domain."""
    return SL.scheduling_metrics(_picked(spark, sf_dir))[0]


@register("schedule_shard_metrics", oracle=f"""{_PICKED}
SELECT shard_id, count(DISTINCT domain_id) AS domains, CAST(count(*) AS BIGINT) AS num_scheduled FROM pk GROUP BY shard_id""")
def schedule_shard_metrics(spark, sf_dir):
    """AG-7: domains and URLs scheduled per shard."""
    return SL.scheduling_metrics(_picked(spark, sf_dir))[1]


@register("schedule_deltas", oracle=f"""{_PICKED}
SELECT '2024-02-01' AS event_date, CAST(count(*) AS BIGINT) AS num_scheduled FROM pk""")
def schedule_deltas(spark, sf_dir):
    """SS-8 / AG-5: the offerers' delta documents, written, parsed and folded into the daily summary."""
    good, _ = STS.parse_deltas(SL.scheduling_deltas(_picked(spark, sf_dir), FX.AS_OF))
    return STS.summary_daily(good, FX.AS_OF).select(F.col("event_date").cast("string").alias("event_date"), "num_scheduled")


# ------------------------------------------------------------ logs (ST-5, ST-7, ST-14..ST-16)

_TRAIL = "l AS ({sql}), s AS (SELECT unnest([0, 1]) AS k), x AS (SELECT l.*, time_bucket(INTERVAL '30 minutes', ts) - k * INTERVAL '30 minutes' AS ws FROM l, s)".format(sql=FX.F7_SQL)


@register("log_event_rate_trailing", oracle=f"""
WITH {_TRAIL} SELECT CAST(ws AS VARCHAR) AS window_start, worker_id, count(*) AS n, count(*) / 3600.0 AS rate FROM x GROUP BY ALL
""")
def log_event_rate_trailing(spark, sf_dir):
    """ST-5: events per second over the trailing hour, at every half hour."""
    r = LG.event_rate(FX.f7_logs(spark, sf_dir), "1 hour", "worker_id", 3600, "30 minutes")
    return r.withColumn("window_start", F.col("window_start").cast("string"))


@register("log_success_ratio_trailing", oracle=f"""
WITH {_TRAIL}, a AS (SELECT ws, count(*) FILTER (WHERE event = 'request.end' AND status < 400) AS ok, count(*) FILTER (WHERE event = 'request.end') AS ends,
  count(*) FILTER (WHERE event = 'request.fail' AND NOT coalesce(fail_reason, '') LIKE 'HttpError%') AS fails FROM x GROUP BY ws)
SELECT CAST(ws AS VARCHAR) AS window_start, ok, ends, fails, CAST(ok AS DOUBLE) / nullif(ends + fails, 0) AS success_ratio FROM a
""")
def log_success_ratio_trailing(spark, sf_dir):
    """ST-7: success ratio over the trailing hour, at every half hour."""
    r = LG.success_ratio(FX.f7_logs(spark, sf_dir), "1 hour", "30 minutes")
    return r.withColumn("window_start", F.col("window_start").cast("string"))


@register("log_shard_series", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST(time_bucket(INTERVAL '1 hour', ts) AS VARCHAR) AS window_start, shard_id, CAST(sum(picked_urls) AS BIGINT) AS urls, count(*) AS visits,
  CAST(sum(picked_domains) AS BIGINT) AS domains FROM l WHERE event = 'offer.refill_shard' GROUP BY ALL
""")
def log_shard_series(spark, sf_dir):
    """ST-14: offerer picks per shard and hour."""
    r = LG.shard_consumption_series(FX.f7_logs(spark, sf_dir), "1 hour")
    return r.withColumn("window_start", F.col("window_start").cast("string"))


@register("log_lines_parsed", oracle=f"""
WITH l AS ({FX.F7_SQL}) SELECT event, coalesce(worker_id, 77) AS worker_id, service, latency_ms, count(*) AS n FROM
  (SELECT event, CASE WHEN event_id % 2 = 0 THEN worker_id END AS worker_id, coalesce(service, 'none') AS service, latency_ms FROM l) GROUP BY ALL
""")
def log_lines_parsed(spark, sf_dir):
    """ST-15: JSON lines to typed rows, context stamped where a line lacks it."""
    logs = FX.f7_logs(spark, sf_dir).withColumn("worker_id", F.when(F.col("event_id") % 2 == 0, F.col("worker_id")))
    lines = logs.select(F.to_json(F.struct(*[c for c in logs.columns if c in SC.LOG_EVENT.fieldNames() or c == "event_id"])).alias("value"))
    rows = LG.enrich(LG.parse_log_lines(lines, SC.LOG_EVENT), "none", 77)
    return rows.groupBy("event", "worker_id", "service", "latency_ms").agg(F.count("*").alias("n"))


@register("log_request_latency", oracle="""
WITH e AS (SELECT event_id, CAST(floor(value * 1000) AS BIGINT) % 700000 AS gap, CAST(floor(value) AS BIGINT) AS dl FROM events)
SELECT event_id AS request_id, gap AS total_ms, dl AS download_latency_ms, gap - dl AS pre_response_ms FROM e WHERE gap <= 600000 AND event_id % 9 > 0
""")
def log_request_latency(spark, sf_dir):
    """ST-16: request starts paired with their ends on the request id within ten minutes; unpaired ones give nothing."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"), "value")
    gap = F.floor(F.col("value") * 1000).cast("long") % 700000
    ends = e.where("request_id % 9 > 0").select("request_id", F.timestamp_micros(F.unix_micros("ts") + gap * 1000).alias("ts"),
                                                 F.floor("value").cast("long").alias("download_latency_ms"))
    return LG.request_latency(e.select("request_id", "ts"), ends)


# ------------------------------------------------------------ the rest of ingest, queue and routing outputs

def _folded(spark, sf_dir):
    f1 = FX.f1_fetches(spark, sf_dir)
    return IG.record_outcomes(FX.f2_old_state(spark, f1), f1, FX.AS_OF)


@register("ingest_metrics_with_links", oracle=f"""
WITH {_FOLD_SQL}, {_LINK_AGG_SQL}, lold AS ({FX.F3_OLD_SQL})
SELECT CAST((SELECT count(*) FROM fold WHERE new_link) + (SELECT count(*) FROM agg WHERE url NOT IN (SELECT url FROM lold)) AS BIGINT) AS new_links,
  CAST((SELECT count(*) FROM fold WHERE is_ok) AS BIGINT) AS num_fetch_ok, CAST((SELECT count(*) FROM fold WHERE NOT is_ok) AS BIGINT) AS num_fetch_fail,
  CAST((SELECT count(*) FROM fold WHERE is_upd) AS BIGINT) AS num_content_update
""")
def ingest_metrics_with_links(spark, sf_dir):
    """AG-4: metrics of a batch of results and links: URLs that either inserted count as new."""
    f3 = FX.f3_links(spark, sf_dir)
    _, _, results = IG.upsert_links(FX.f3_old_state(spark, f3), IG.aggregate_links(FX.f3_link_records(spark, sf_dir)), FX.AS_OF)
    return IG.batch_metrics(_folded(spark, sf_dir), results)[0]


@register("ingest_global_reasons", oracle=f"""
WITH f1 AS ({FX.F1_SQL}) SELECT fail_reason AS reason, count(*) AS n FROM f1 WHERE fail_reason IS NOT NULL GROUP BY 1
""")
def ingest_global_reasons(spark, sf_dir):
    """AG-4: fail reasons of a batch over all domains."""
    return IG.global_reasons(IG.batch_metrics(_folded(spark, sf_dir))[2])


@register("queue_remaining", oracle=f"""
WITH {_PICKED_EXAMPLE}, qb AS (SELECT DISTINCT domain_id, domain_id % 97 AS m FROM picked),
pop AS (SELECT domain_id FROM qb WHERE domain_id % 7 <> 0 ORDER BY m, domain_id LIMIT 25)
SELECT domain_id FROM qb WHERE domain_id NOT IN (SELECT domain_id FROM pop)
""")
def queue_remaining(spark, sf_dir):
    """WT-7: what a limited pop leaves in the queue, batches of domains in flight included."""
    qb = SL.queue_batches(_picked(spark, sf_dir), FX.AS_OF).withColumn(
        "generated_at", (F.lit("2024-01-31").cast("timestamp") + F.make_dt_interval(mins=(F.col("domain_id") % 97).cast("int"))).cast("string"))
    return SL.pop_batches(qb, 25, SL.queued_domains(qb).where("domain_id % 7 = 0"))[1].select("domain_id")


@register("select_counters_conflict", oracle=f"""
WITH {_PICKED_EXAMPLE}, old AS (SELECT url, CAST(o_orderkey % 4 AS INTEGER) AS n, o_orderkey % 3 = 0 AS accounted FROM
  (SELECT *, CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) AS o_orderkey FROM st) WHERE o_orderkey % 2 = 0)
SELECT coalesce(o.url, p.url) AS url, CAST(coalesce(o.n, 0) + CASE WHEN p.url IS NULL THEN 0 ELSE 1 END AS INTEGER) AS num_scheduled,
  CAST(coalesce(o.n, 0) * 10 AS INTEGER) AS num_fetch_ok, CASE WHEN p.url IS NULL THEN o.accounted ELSE true END AS accounted FROM old o FULL JOIN picked p ON p.url = o.url
""")
def select_counters_conflict(spark, sf_dir):
    """UM-11: counters of a day that some picked URLs have already: scheduled adds one and the
    row counts as accounted again, the other counters stay."""
    st, dom, q = _inputs(spark, sf_dir)
    k = F.regexp_extract("url", "([0-9]+)$", 1).cast("long")
    old = SC.conform(st.where(k % 2 == 0).select("url", F.to_date(F.lit(FX.AS_OF)).alias("event_date"), (k % 4).alias("num_scheduled"), (k % 4 * 10).alias("num_fetch_ok"),
                                                 (k % 3 == 0).alias("accounted"), "shard_id"), SC.URL_EVENT_COUNTER, SC.COUNTER_DEFAULTS)
    delta = SL.apply_selection(st, SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF), FX.AS_OF).counter_delta
    return SL.merge_schedule_counters(old, delta).select("url", "num_scheduled", "num_fetch_ok", "accounted")


@register("feature_history", oracle=f"""
WITH f1 AS ({FX.F1_SQL}) SELECT url, domain_id, fetched_at, CAST(seq % 1000 AS INTEGER) AS content_length, content_hash FROM f1 WHERE status = 'ok'
""")
def feature_history(spark, sf_dir):
    """UM-10: every feature record goes to history, repeats of a URL included."""
    rec = FX.f1_fetches(spark, sf_dir).where("status = 'ok'").withColumn("content_length", (F.col("seq") % 1000).cast("int")).withColumn("num_links", F.lit(0))
    return GD.upsert_features(SC.empty(spark, SC.CONTENT_FEATURE), rec)[1].select("url", "domain_id", "fetched_at", "content_length", "content_hash")


@register("dispatch_results", oracle="""
WITH k AS (SELECT page_id, CASE WHEN host = '' THEN 'unknown' ELSE coalesce(nullif(regexp_extract(host, '([^.]+\\.[^.]+)$', 1), ''), host) END AS k FROM
  (SELECT page_id, lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), ':.*$', '')) AS host FROM pages))
SELECT CAST(CAST(('0x' || right(md5(k), 2)) AS INTEGER) // 16 AS INTEGER) AS ingestor_id, CAST(1 AS BIGINT) AS n_partitions, count(*) AS n FROM k GROUP BY 1
""")
def dispatch_results(spark, sf_dir):
    """RJ-5: records of one ingestor lie in one partition."""
    routed = RT.with_shard_columns(table(spark, sf_dir, "pages").select("page_id", "url"), "url", rules=FX.SUFFIX_RULES)
    return (RT.dispatch(routed).withColumn("p", F.spark_partition_id()).groupBy("ingestor_id")
            .agg(F.countDistinct("p").alias("n_partitions"), F.count("*").alias("n")))


@register("queue_counts", oracle=f"""
WITH {_PICKED_EXAMPLE}, qb AS (SELECT DISTINCT domain_id, domain_id % 3 AS m FROM picked),
q AS (SELECT domain_id FROM qb UNION ALL SELECT domain_id FROM qb WHERE m = 0 UNION ALL SELECT NULL FROM qb WHERE m = 1)
SELECT count(*) AS batches, count(domain_id) AS domain_batches, count(DISTINCT domain_id) AS domains FROM q
""")
def queue_counts(spark, sf_dir):
    """SS-6: ready batches of a queue, those that name a domain, and distinct domains (some
    domains wait twice, some batches have no domain)."""
    qb = SL.queue_batches(_picked(spark, sf_dir), FX.AS_OF)
    m = F.col("domain_id") % 3
    times = F.when(m == 0, F.array("domain_id", "domain_id")).when(m == 1, F.array(F.col("domain_id"), F.lit(None))).otherwise(F.array("domain_id"))
    return SL.queue_counts(qb.select(F.explode(times).alias("domain_id")))


@register("stats_summary_reasons", oracle=f"""
WITH {_F8} SELECT event_date, fail_reason AS reason, CAST(count(*) AS BIGINT) AS n FROM r WHERE fail_reason IS NOT NULL GROUP BY ALL
""")
def stats_summary_reasons(spark, sf_dir):
    """AG-5 / SC-23: the fail reasons of the daily summary, one row each."""
    good, _ = STS.parse_deltas(f8_delta_json(spark, sf_dir))
    return STS.summary_daily(good, FX.AS_OF).select(F.col("event_date").cast("string").alias("event_date"), F.explode("fail_reasons").alias("reason", "n"))


@register("select_limits", oracle=f"""
WITH {_PICKED_EXAMPLE} SELECT CAST(cap AS INTEGER) AS cap, CAST(most AS INTEGER) AS most, CAST(count(p.url) AS BIGINT) AS n FROM (VALUES (0, {MAX_DOMAINS}), ({CAP}, 0), (-1, -1), ({CAP}, {MAX_DOMAINS})) l(cap, most)
LEFT JOIN picked p ON cap > 0 AND most > 0 GROUP BY ALL
""")
def select_limits(spark, sf_dir):
    """WT-4: a limit of zero or less selects nothing."""
    st, dom, q = _inputs(spark, sf_dir)
    out = None
    for cap, most in ((0, MAX_DOMAINS), (CAP, 0), (-1, -1), (CAP, MAX_DOMAINS)):
        one = SL.select_by_domain(st, dom, q, "example", cap, most, FX.AS_OF).agg(F.count("*").alias("n")).select(F.lit(cap).alias("cap"), F.lit(most).alias("most"), "n")
        out = one if out is None else out.unionByName(one)
    return out
