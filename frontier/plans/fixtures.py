"""Stand-in inputs built from the driver tables (FIXTURES.md F1..F12).

Each builder only reshapes driver rows into the schema an operator expects;
it does none of the operator's work.  The matching DuckDB text (``*_SQL``) is
used by the oracle queries so both sides start from identical input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as SC
from ..functions import urls as U
from .registry import table

# The public suffixes of the hosts in the driver tables: the rule table that the
# registered queries pass (a deployment passes the whole public list).
SUFFIX_RULES = U.SuffixRules(["com", "org", "net"])

# The clock of the ingest fixtures (after the last event).
AS_OF = "2024-02-01 00:00:00"
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

# ---------------------------------------------------------------- F1 fetches
F1_SQL = """
SELECT event_id AS seq, event_id % 700 AS u,
  'https://h' || (event_id % 700 % 40) || '.example.com/p/' || (event_id % 700) AS url,
  CAST((event_id % 700 % 40) + 1 AS BIGINT) AS domain_id, ts AS fetched_at,
  CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN 'fail' ELSE 'ok' END AS status,
  CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN CASE event_id % 5 WHEN 0 THEN 'HttpError 503'
    WHEN 1 THEN 'HttpError 404' WHEN 2 THEN 'TimeoutError' WHEN 3 THEN 'IgnoreRequest Forbidden by robots.txt'
    ELSE 'DNSLookupError' END END AS fail_reason,
  CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN NULL
    ELSE sha1(CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR)) END AS content_hash,
  CASE WHEN event_id % 3 = 0 THEN 't' || (event_id % 9) END AS title
FROM events
"""


def f1_fetches(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    u = F.col("event_id") % 700
    fail = (F.col("event_type") == "error") | (F.col("event_id") % 11 == 0)
    reason = (F.when(F.col("event_id") % 5 == 0, "HttpError 503").when(F.col("event_id") % 5 == 1, "HttpError 404")
              .when(F.col("event_id") % 5 == 2, "TimeoutError")
              .when(F.col("event_id") % 5 == 3, "IgnoreRequest Forbidden by robots.txt").otherwise("DNSLookupError"))
    return e.select(
        F.col("event_id").alias("seq"), u.alias("u"),
        F.concat(F.lit("https://h"), (u % 40).cast("string"), F.lit(".example.com/p/"), u.cast("string")).alias("url"),
        ((u % 40) + 1).cast("long").alias("domain_id"), F.col("ts").cast("timestamp").alias("fetched_at"),
        F.when(fail, "fail").otherwise("ok").alias("status"), F.when(fail, reason).alias("fail_reason"),
        F.when(~fail, F.sha1(F.floor(F.col("value") / 20).cast("long").cast("string"))).alias("content_hash"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("t"), (F.col("event_id") % 9).cast("string"))).alias("title"),
        F.lit(None).cast("int").alias("shard_id"),
    )


# ------------------------------------------------------------- F2 old state
F2_SQL = """
SELECT DISTINCT url, domain_id, CAST(u % 5 AS INTEGER) AS n_ok, CAST(u % 4 AS INTEGER) AS n_fail,
  CAST(u % 2 AS INTEGER) AS n_upd, CAST(u % 3 AS INTEGER) AS n_cf,
  TIMESTAMP '2023-12-01' + to_minutes(CAST(u AS INTEGER)) AS last_ok,
  CASE WHEN u % 2 = 0 THEN sha1('0') END AS content_hash, CAST(u % 3 AS SMALLINT) AS robots_bits,
  CASE WHEN u % 6 = 0 THEN 'old' END AS title
FROM f1 WHERE u < 350
"""


def f2_old_state(spark, f1):
    u = F.col("u")
    rows = f1.filter(u < 350).select(
        "url", "domain_id", (u % 5).cast("int").alias("num_fetch_ok_90d"), (u % 4).cast("int").alias("num_fetch_fail_90d"),
        (u % 2).cast("int").alias("num_content_update_90d"), (u % 3).cast("int").alias("num_consecutive_fail"),
        (F.lit("2023-12-01").cast("timestamp") + F.make_dt_interval(mins=u.cast("int"))).alias("last_fetch_ok"),
        F.when(u % 2 == 0, F.sha1(F.lit("0"))).alias("content_hash"), (u % 3).cast("short").alias("robots_bits"),
        F.when(u % 6 == 0, F.lit("old")).alias("title")).distinct()
    return SC.conform(rows.withColumn("should_crawl", F.lit(True)), SC.URL_STATE, SC.URL_STATE_DEFAULTS)


# ------------------------------------------------------------------ F3 links
F3_SQL = """
SELECT 'https://s' || l_suppkey || '.example.org/o/' || l_orderkey AS src,
  CASE WHEN l_partkey % 2 = 0 THEN 'https://s' || l_suppkey || '.example.org/i/' || l_partkey
       ELSE 'https://p' || (l_partkey % 97) || '.example.net/i/' || l_partkey END AS dst,
  CASE WHEN l_partkey % 2 = 0 THEN 0 ELSE 1 END AS ext,
  CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE p_name END AS anchor,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def f3_links(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    even = F.col("l_partkey") % 2 == 0
    return j.select(
        F.concat(F.lit("https://s"), F.col("l_suppkey").cast("string"), F.lit(".example.org/o/"),
                 F.col("l_orderkey").cast("string")).alias("src"),
        F.when(even, F.concat(F.lit("https://s"), F.col("l_suppkey").cast("string"), F.lit(".example.org/i/"),
                              F.col("l_partkey").cast("string")))
         .otherwise(F.concat(F.lit("https://p"), (F.col("l_partkey") % 97).cast("string"), F.lit(".example.net/i/"),
                             F.col("l_partkey").cast("string"))).alias("dst"),
        F.when(even, 0).otherwise(1).alias("ext"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.col("p_name")).alias("anchor"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


F3_LINK_RECORDS_SQL = """
SELECT dst AS url, 'new' AS status, CAST(l_suppkey + 1 AS BIGINT) AS domain_id,
  CAST(l_suppkey % 10 AS DOUBLE) / 10 AS domain_score, src AS discovered_from,
  CAST(1 AS SMALLINT) AS discovery_source_type, CAST(l_orderkey % 7 AS DOUBLE) / 7 AS parent_page_score,
  1 AS inlink_count_approx, ext AS inlink_count_external, anchor AS anchor_text,
  l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM f3
"""


def f3_link_records(spark, sf_dir):
    """Routed ``new`` link records (A3 schema) with a strict ``seq``."""
    f3 = f3_links(spark, sf_dir)
    return f3.select(
        F.col("dst").alias("url"), F.lit("new").alias("status"), (F.col("l_suppkey") + 1).cast("long").alias("domain_id"),
        ((F.col("l_suppkey") % 10).cast("double") / 10).alias("domain_score"), F.col("src").alias("discovered_from"),
        F.lit(1).cast("short").alias("discovery_source_type"),
        ((F.col("l_orderkey") % 7).cast("double") / 7).alias("parent_page_score"),
        F.lit(1).alias("inlink_count_approx"), F.col("ext").alias("inlink_count_external"),
        F.col("anchor").alias("anchor_text"), F.lit(None).cast("int").alias("shard_id"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("seq"))


F3_OLD_SQL = """
SELECT DISTINCT dst AS url, CAST(l_partkey % 5 AS INTEGER) AS inlink_count_approx,
  CAST(l_partkey % 2 AS INTEGER) AS inlink_count_external,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'old' END AS anchor_text
FROM f3 WHERE l_partkey % 3 = 0
"""


def f3_old_state(spark, f3):
    rows = f3.filter(F.col("l_partkey") % 3 == 0).select(
        F.col("dst").alias("url"), (F.col("l_partkey") % 5).cast("int").alias("inlink_count_approx"),
        (F.col("l_partkey") % 2).cast("int").alias("inlink_count_external"),
        F.when(F.col("l_partkey") % 4 == 0, F.lit(None)).otherwise(F.lit("old")).alias("anchor_text")).distinct()
    return SC.conform(rows.withColumn("domain_id", F.lit(0).cast("long")), SC.URL_STATE, SC.URL_STATE_DEFAULTS)


# ------------------------------------------------------------ F4 counters
F4_SQL = """
SELECT 'https://u' || user_id || '.example.com/' AS url, CAST(ts AS DATE) AS event_date,
  CAST(count(*) FILTER (WHERE event_type = 'signup') AS INTEGER) AS num_scheduled,
  CAST(count(*) FILTER (WHERE event_type IN ('view', 'click', 'purchase')) AS INTEGER) AS num_fetch_ok,
  CAST(count(*) FILTER (WHERE event_type = 'error') AS INTEGER) AS num_fetch_fail,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS INTEGER) AS num_content_update,
  TRUE AS accounted, min(user_id) AS user_id
FROM events GROUP BY 1, 2
"""


def f4_counters(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.groupBy(
        F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example.com/")).alias("url"),
        F.to_date(F.col("ts")).alias("event_date")).agg(
        F.count_if(et == "signup").cast("int").alias("num_scheduled"),
        F.count_if(et.isin("view", "click", "purchase")).cast("int").alias("num_fetch_ok"),
        F.count_if(et == "error").cast("int").alias("num_fetch_fail"),
        F.count_if(et == "purchase").cast("int").alias("num_content_update"),
        F.lit(True).alias("accounted"), F.min("user_id").alias("user_id"))


F4_CURRENT_SQL = """
SELECT DISTINCT 'https://u' || user_id || '.example.com/' AS url, CAST((user_id % 2) * 60 + 5 AS INTEGER) AS n_ok,
  CAST(user_id % 7 AS INTEGER) AS n_fail, CAST(user_id % 3 AS INTEGER) AS n_upd, CAST(user_id % 4 AS INTEGER) AS n_sched
FROM events WHERE user_id % 10 <> 0
"""


def f4_current(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id").distinct().filter(F.col("user_id") % 10 != 0)
    rows = e.select(
        F.concat(F.lit("https://u"), F.col("user_id").cast("string"), F.lit(".example.com/")).alias("url"),
        ((F.col("user_id") % 2) * 60 + 5).cast("int").alias("num_fetch_ok_90d"),
        (F.col("user_id") % 7).cast("int").alias("num_fetch_fail_90d"),
        (F.col("user_id") % 3).cast("int").alias("num_content_update_90d"),
        (F.col("user_id") % 4).cast("int").alias("num_scheduled_90d"),
        F.col("user_id").cast("long").alias("domain_id"))
    return SC.conform(rows, SC.URL_STATE, SC.URL_STATE_DEFAULTS)


# ------------------------------------------------------- F5 domain_state
F5_SQL = f"""
SELECT CAST(c_custkey + 1 AS BIGINT) AS domain_id, 'h' || c_custkey || '.example.com' AS domain,
  CAST(c_custkey % 256 AS INTEGER) AS shard_id, c_acctbal / 10000 AS domain_score,
  CASE c_custkey % 3 WHEN 0 THEN {AS_OF_SQL} + INTERVAL 1 DAY WHEN 1 THEN {AS_OF_SQL} - INTERVAL 1 DAY END
    AS crawl_paused_until,
  CAST(c_custkey % 9 AS INTEGER) AS domain_fail_count
FROM customer
"""


def f5_domain_state(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    asof = F.lit(AS_OF).cast("timestamp")
    return c.select(
        (k + 1).cast("long").alias("domain_id"), F.concat(F.lit("h"), k.cast("string"), F.lit(".example.com")).alias("domain"),
        (k % 256).cast("int").alias("shard_id"), (F.col("c_acctbal") / 10000).alias("domain_score"),
        F.when(k % 3 == 0, asof + F.expr("INTERVAL 1 DAY")).when(k % 3 == 1, asof - F.expr("INTERVAL 1 DAY"))
         .alias("crawl_paused_until"),
        (k % 9).cast("int").alias("domain_fail_count"))


# ------------------------------------------------------ F6 selection state
F6_SQL = """
SELECT 'https://h' || o_custkey || '.example.com/' || o_orderkey AS url, CAST(o_custkey + 1 AS BIGINT) AS domain_id,
  o_totalprice / 600000 AS url_score,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS url_score_updated_at,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS last_scheduled,
  o_orderdate AS first_seen, o_orderstatus <> 'F' AS should_crawl,
  CAST(o_custkey % 10 AS DOUBLE) / 10 AS domain_score,
  CAST(('0x' || right(md5('h' || o_custkey || '.example.com'), 2)) AS INTEGER) AS shard_id,
  CAST(o_orderkey % 5 AS INTEGER) AS num_scheduled_90d
FROM orders
"""


def f6_selection_state(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    host = F.concat(F.lit("h"), F.col("o_custkey").cast("string"), F.lit(".example.com"))
    od = F.col("o_orderdate").cast("timestamp")
    rows = o.select(
        F.concat(F.lit("https://"), host, F.lit("/"), F.col("o_orderkey").cast("string")).alias("url"),
        (F.col("o_custkey") + 1).cast("long").alias("domain_id"),
        (F.col("o_totalprice") / 600000).alias("url_score"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).otherwise(od).alias("url_score_updated_at"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(od + F.expr("INTERVAL 1 DAY")).alias("last_scheduled"),
        od.alias("first_seen"), (F.col("o_orderstatus") != "F").alias("should_crawl"),
        ((F.col("o_custkey") % 10).cast("double") / 10).alias("domain_score"),
        U.shard_id(host).alias("shard_id"),
        (F.col("o_orderkey") % 5).cast("int").alias("num_scheduled_90d"))
    return SC.conform(rows, SC.URL_STATE, SC.URL_STATE_DEFAULTS)


# ----------------------------------------------------------------- F7 logs
F7_SQL = """
SELECT ts, CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END AS level,
  CASE WHEN event_type = 'signup' THEN 'offerer' ELSE 'crawler' END AS service,
  CAST(user_id % 16 AS INTEGER) AS worker_id, CAST(user_id % 256 AS INTEGER) AS shard_id,
  CASE event_type WHEN 'view' THEN 'request.start' WHEN 'click' THEN 'request.end' WHEN 'error' THEN 'request.fail'
    WHEN 'purchase' THEN 'spider.heartbeat' ELSE 'offer.refill_shard' END AS event,
  'd' || user_id AS domain,
  CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 7 = 0 THEN 404 ELSE 200 END END AS status,
  CAST(floor(value) AS BIGINT) AS latency_ms,
  CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 'HttpError 503' WHEN 1 THEN 'HttpError 404'
    WHEN 2 THEN 'TimeoutError' WHEN 3 THEN 'IgnoreRequest Forbidden by robots.txt' ELSE 'DNSLookupError' END END
    AS fail_reason,
  CASE WHEN event_type = 'error' THEN 'batch failed at row ' || event_id || chr(10) || 'trace' END AS error,
  CAST(floor(value) AS BIGINT) % 50 AS inflight, CAST(floor(value) AS BIGINT) % 200 AS pending,
  CAST(user_id % 40 AS BIGINT) AS active_domains, CAST(floor(value) AS BIGINT) % 13 AS transferring,
  CAST(event_id % 17 AS BIGINT) AS slot_queue,
  CASE WHEN event_type = 'signup' THEN event_id % 100 END AS picked_urls,
  CASE WHEN event_type = 'signup' THEN event_id % 7 END AS picked_domains,
  value / 10 AS lag_minutes, event_id
FROM events
"""


def f7_logs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    v = F.floor(F.col("value")).cast("long")
    eid = F.col("event_id")
    reason = (F.when(eid % 5 == 0, "HttpError 503").when(eid % 5 == 1, "HttpError 404").when(eid % 5 == 2, "TimeoutError")
              .when(eid % 5 == 3, "IgnoreRequest Forbidden by robots.txt").otherwise("DNSLookupError"))
    return e.select(
        F.col("ts").cast("timestamp").alias("ts"), F.when(et == "error", "WARNING").otherwise("INFO").alias("level"),
        F.when(et == "signup", "offerer").otherwise("crawler").alias("service"),
        (F.col("user_id") % 16).cast("int").alias("worker_id"), (F.col("user_id") % 256).cast("int").alias("shard_id"),
        F.when(et == "view", "request.start").when(et == "click", "request.end").when(et == "error", "request.fail")
         .when(et == "purchase", "spider.heartbeat").otherwise("offer.refill_shard").alias("event"),
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("domain"),
        F.when(et == "click", F.when(eid % 7 == 0, 404).otherwise(200)).alias("status"),
        v.alias("latency_ms"), F.when(et == "error", reason).alias("fail_reason"),
        F.when(et == "error", F.concat(F.lit("batch failed at row "), eid.cast("string"), F.lit("\ntrace"))).alias("error"),
        (v % 50).alias("inflight"), (v % 200).alias("pending"), (F.col("user_id") % 40).cast("long").alias("active_domains"),
        (v % 13).alias("transferring"), (eid % 17).cast("long").alias("slot_queue"),
        F.when(et == "signup", eid % 100).alias("picked_urls"), F.when(et == "signup", eid % 7).alias("picked_domains"),
        (F.col("value") / 10).alias("lag_minutes"), eid.alias("event_id"))
