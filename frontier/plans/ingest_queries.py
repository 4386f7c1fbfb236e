"""Queries for the ingest operators (UM-1..UM-9, AG-4, PF-6..PF-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest as IG
from . import fixtures as FX
from .registry import register

# DuckDB: the ordered fold of F1 over F2 (one row per fetch record).
_FOLD_SQL = f"""
f1 AS ({FX.F1_SQL}), old AS ({FX.F2_SQL}),
b AS (SELECT f1.seq, f1.url, f1.domain_id, f1.fetched_at, f1.status = 'ok' AS is_ok, f1.fail_reason,
        f1.content_hash AS h, CASE WHEN f1.status = 'ok' THEN f1.title END AS t,
        CASE WHEN f1.fail_reason LIKE 'IgnoreRequest Forbidden by robots.txt%' THEN 2
             WHEN f1.status = 'ok' OR f1.fail_reason = 'NonHTML content-type'
                  OR coalesce(f1.fail_reason, '') LIKE 'HttpError %' THEN 1 ELSE 0 END AS rb,
        o.url IS NOT NULL AS has_old, o.domain_id AS o_domain_id, o.n_ok, o.n_fail, o.n_upd, o.n_cf,
        o.last_ok, o.content_hash AS o_hash, o.robots_bits AS o_rb, o.title AS o_title,
        row_number() OVER (PARTITION BY f1.url ORDER BY f1.seq) AS rn,
        count(*) OVER (PARTITION BY f1.url) AS n_url
      FROM f1 LEFT JOIN old o ON f1.url = o.url),
c AS (SELECT *, coalesce(last_value(CASE WHEN is_ok THEN h END IGNORE NULLS) OVER (PARTITION BY url ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), o_hash) AS prev_hash FROM b),
d AS (SELECT *, coalesce(is_ok AND h IS NOT NULL AND h IS DISTINCT FROM prev_hash, false) AS is_upd FROM c),
fold AS (
SELECT url, seq, (NOT has_old AND rn = 1) AS new_link, is_upd, is_ok, rn = n_url AS is_last, fail_reason,
  CASE WHEN has_old THEN o_domain_id ELSE first_value(domain_id) OVER w END AS domain_id,
  CAST(coalesce(n_ok, 0) + sum(CASE WHEN is_ok THEN 1 ELSE 0 END) OVER w AS INTEGER) AS num_fetch_ok_90d,
  CAST(coalesce(n_fail, 0) + sum(CASE WHEN is_ok THEN 0 ELSE 1 END) OVER w AS INTEGER) AS num_fetch_fail_90d,
  CAST(coalesce(n_upd, 0) + sum(CASE WHEN is_upd THEN 1 ELSE 0 END) OVER w AS INTEGER) AS num_content_update_90d,
  CAST(CASE WHEN max(CASE WHEN is_ok THEN rn END) OVER w IS NULL THEN coalesce(n_cf, 0) + rn
            ELSE rn - max(CASE WHEN is_ok THEN rn END) OVER w END AS INTEGER) AS num_consecutive_fail,
  coalesce(last_value(CASE WHEN is_ok THEN fetched_at END IGNORE NULLS) OVER w, last_ok) AS last_fetch_ok,
  last_value(CASE WHEN is_upd THEN fetched_at END IGNORE NULLS) OVER w AS last_content_update,
  coalesce(last_value(CASE WHEN is_upd THEN h END IGNORE NULLS) OVER w,
           CASE WHEN has_old THEN o_hash ELSE first_value(h) OVER w END) AS content_hash,
  CAST(coalesce(last_value(CASE WHEN rb <> 0 THEN rb END IGNORE NULLS) OVER w, o_rb, 0) AS SMALLINT) AS robots_bits,
  coalesce(last_value(t IGNORE NULLS) OVER w, o_title) AS title,
  CASE WHEN NOT is_ok THEN fail_reason END AS last_fail_reason
FROM d WINDOW w AS (PARTITION BY url ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

_FOLD_COLS = ["url", "seq", "new_link", "is_upd", "domain_id", "num_fetch_ok_90d", "num_fetch_fail_90d",
              "num_content_update_90d", "num_consecutive_fail", "last_fetch_ok", "last_content_update",
              "content_hash", "robots_bits", "title", "last_fail_reason"]


def _fold(spark, sf_dir, extra_state=None):
    f1 = FX.f1_fetches(spark, sf_dir)
    state = FX.f2_old_state(spark, f1)
    if extra_state is not None:
        state = state.unionByName(extra_state)
    return IG.fold_results(state, f1, FX.AS_OF), state


def _outcomes(spark, sf_dir):
    f1 = FX.f1_fetches(spark, sf_dir)
    return IG.record_outcomes(FX.f2_old_state(spark, f1), f1, FX.AS_OF)


@register("ingest_results_history", headline=True, oracle=f"WITH {_FOLD_SQL} SELECT {', '.join(_FOLD_COLS)} FROM fold")
def ingest_results_history(spark, sf_dir):
    """UM-1..UM-4: every post-image of the ordered fetch-result upsert."""
    folded, _ = _fold(spark, sf_dir)
    return folded.select(*_FOLD_COLS)


@register("ingest_state_merge", oracle=f"""
WITH {_FOLD_SQL}, cur AS ({FX.F4_CURRENT_SQL})
SELECT url, num_fetch_ok_90d, num_fetch_fail_90d, num_consecutive_fail, content_hash, FALSE AS should_crawl
FROM fold WHERE is_last
UNION ALL
SELECT url, n_ok, n_fail, 0, NULL, TRUE FROM cur
""")
def ingest_state_merge(spark, sf_dir):
    """UM-1 + merge: new url_state = final images of the batch + untouched rows."""
    folded, state = _fold(spark, sf_dir, FX.f4_current(spark, sf_dir))
    new_state = IG.merge_state(state, IG.final_images(folded))
    return new_state.select("url", "num_fetch_ok_90d", "num_fetch_fail_90d", "num_consecutive_fail",
                            "content_hash", "should_crawl")


@register("ingest_counters", oracle=f"""
WITH {_FOLD_SQL}, f4 AS ({FX.F4_SQL})
SELECT url, CAST(CAST({FX.AS_OF_SQL} AS DATE) AS VARCHAR) AS event_date, CAST(0 AS INTEGER) AS num_scheduled,
  CAST(sum(CASE WHEN is_ok THEN 1 ELSE 0 END) AS INTEGER) AS num_fetch_ok,
  CAST(sum(CASE WHEN is_ok THEN 0 ELSE 1 END) AS INTEGER) AS num_fetch_fail,
  CAST(sum(CASE WHEN is_upd THEN 1 ELSE 0 END) AS INTEGER) AS num_content_update, TRUE AS accounted
FROM fold GROUP BY url
UNION ALL
SELECT url, CAST(event_date AS VARCHAR), num_scheduled, num_fetch_ok, num_fetch_fail, num_content_update, accounted FROM f4
""")
def ingest_counters(spark, sf_dir):
    """UM-5: daily event counters after merging a batch's increments."""
    folded, _ = _fold(spark, sf_dir)
    counters = FX.f4_counters(spark, sf_dir).drop("user_id").withColumn("shard_id", F.lit(None).cast("int"))
    merged = IG.merge_counters(counters, IG.counter_delta(folded, FX.AS_OF))
    return merged.drop("shard_id").withColumn("event_date", F.col("event_date").cast("string"))


# Fixed values, written out: minutes by fail reason.
_PAUSE_CASE = """WHEN 'IgnoreRequest Forbidden by robots.txt' THEN 1440 WHEN 'ConnectionRefusedError' THEN 720 WHEN 'HttpError 410' THEN 1440
  WHEN 'NonHTML content-type' THEN 360 WHEN 'HttpError 403' THEN 360 WHEN 'HttpError 400' THEN 360 WHEN 'HttpError 429' THEN 60
  WHEN 'TimeoutError' THEN 60 WHEN 'ResponseNeverReceived' THEN 60"""


def pause_sql(where: str) -> str:
    """DuckDB: domain back-off one record after the other, over the F1 records ``where`` holds for."""
    return f"""
WITH RECURSIVE f1 AS ({FX.F1_SQL}), dom AS ({FX.F5_SQL}),
r AS (SELECT domain_id, status = 'ok' AS is_ok,
        coalesce(CASE fail_reason {_PAUSE_CASE} END,
                 CASE WHEN fail_reason LIKE 'HttpError 5%' THEN 30 END) AS base,
        row_number() OVER (PARTITION BY domain_id ORDER BY seq) AS k FROM f1 WHERE {where}),
st(domain_id, k, until, fails) AS (
  SELECT domain_id, CAST(0 AS BIGINT), CAST(crawl_paused_until AS TIMESTAMP), CAST(domain_fail_count AS INTEGER) FROM dom
  UNION ALL
  SELECT st.domain_id, r.k,
    CASE WHEN r.is_ok THEN CASE WHEN fails > 0 THEN NULL ELSE until END
         WHEN base IS NOT NULL AND (until IS NULL OR until < {FX.AS_OF_SQL})
           THEN {FX.AS_OF_SQL} + to_minutes(CAST(base * power(2, least(fails, 6)) AS BIGINT)) ELSE until END,
    CASE WHEN r.is_ok THEN 0
         WHEN base IS NOT NULL AND (until IS NULL OR until < {FX.AS_OF_SQL}) THEN fails + 1 ELSE fails END
  FROM st JOIN r ON r.domain_id = st.domain_id AND r.k = st.k + 1),
fin AS (SELECT domain_id, arg_max(struct_pack(u := until, f := fails), k) AS s FROM st GROUP BY domain_id)
"""


@register("ingest_domain_pause", oracle=f"""
{pause_sql("seq % 7 < 4 OR status <> 'ok'")}
SELECT d.domain_id, d.domain, d.shard_id, d.domain_score, s.u AS crawl_paused_until, s.f AS domain_fail_count
FROM dom d JOIN fin USING (domain_id) WHERE s.u IS DISTINCT FROM d.crawl_paused_until OR s.f <> d.domain_fail_count
""")
def ingest_domain_pause(spark, sf_dir):
    """UM-9 / PF-8 / SC-22: domains paused or reset by a batch, record by record (the
    oracle applies one record after the other)."""
    f1 = FX.f1_fetches(spark, sf_dir).where("seq % 7 < 4 OR status <> 'ok'")
    records = IG.record_outcomes(FX.f2_old_state(spark, f1), f1, FX.AS_OF)
    return IG.domain_pause(FX.f5_domain_state(spark, sf_dir), records, FX.AS_OF)


_LINK_AGG_SQL = f"""
f3 AS ({FX.F3_SQL}), lr AS ({FX.F3_LINK_RECORDS_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
      FROM lr WHERE url IS NOT NULL AND url <> ''),
an AS (SELECT url, anchor_text, row_number() OVER (PARTITION BY url ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn2
       FROM lr WHERE coalesce(anchor_text, '') <> ''),
s AS (SELECT url, sum(coalesce(inlink_count_approx, 1)) AS approx, sum(coalesce(inlink_count_external, 0)) AS ext
      FROM lr GROUP BY url),
agg AS (SELECT r.url, r.discovered_from, r.domain_id, r.domain_score, r.parent_page_score,
          CAST(s.approx AS INTEGER) AS inlink_count_approx, CAST(s.ext AS INTEGER) AS inlink_count_external,
          an.anchor_text
        FROM r JOIN s USING (url) LEFT JOIN an ON an.url = r.url AND an.rn2 = 1 WHERE r.rn = 1)
"""


@register("links_aggregate", oracle=f"""
WITH {_LINK_AGG_SQL}
SELECT url, discovered_from, domain_id, parent_page_score, inlink_count_approx, inlink_count_external, anchor_text FROM agg
""")
def links_aggregate(spark, sf_dir):
    """UM-6: per-URL aggregation of discovery records (map-side combined)."""
    agg = IG.aggregate_links(FX.f3_link_records(spark, sf_dir))
    return agg.select("url", "discovered_from", "domain_id", "parent_page_score", "inlink_count_approx",
                      "inlink_count_external", "anchor_text")


@register("links_upsert", oracle=f"""
WITH {_LINK_AGG_SQL}, old AS ({FX.F3_OLD_SQL})
SELECT g.url, o.url IS NULL AS inserted,
  CAST(CASE WHEN o.url IS NULL THEN g.inlink_count_approx ELSE o.inlink_count_approx + g.inlink_count_approx END AS INTEGER)
    AS inlink_count_approx,
  CAST(CASE WHEN o.url IS NULL THEN g.inlink_count_external ELSE o.inlink_count_external + g.inlink_count_external END
    AS INTEGER) AS inlink_count_external,
  CASE WHEN o.url IS NULL THEN nullif(g.anchor_text, '') ELSE coalesce(o.anchor_text, nullif(g.anchor_text, '')) END
    AS anchor_text,
  CASE WHEN o.url IS NULL THEN g.domain_score ELSE 0.0 END AS domain_score,
  CASE WHEN o.url IS NULL THEN g.discovered_from END AS discovered_from,
  CASE WHEN o.url IS NULL THEN g.domain_id ELSE 0 END AS domain_id
FROM agg g LEFT JOIN old o USING (url)
""")
def links_upsert(spark, sf_dir):
    """UM-7: link upsert: insert unseen URLs, add inlink counters to known ones."""
    f3 = FX.f3_links(spark, sf_dir)
    state = FX.f3_old_state(spark, f3)
    agg = IG.aggregate_links(FX.f3_link_records(spark, sf_dir))
    _, _, res = IG.upsert_links(state, agg, FX.AS_OF)
    return res.select(
        "url", "inserted", "inlink_count_approx", "inlink_count_external", "anchor_text", "domain_score",
        "discovered_from", "domain_id")


@register("ingest_domain_metrics", oracle=f"""
WITH {_FOLD_SQL}
SELECT domain_id, CAST(sum(CASE WHEN is_ok THEN 1 ELSE 0 END) AS BIGINT) AS num_fetch_ok,
  CAST(sum(CASE WHEN is_ok THEN 0 ELSE 1 END) AS BIGINT) AS num_fetch_fail,
  CAST(sum(CASE WHEN is_upd THEN 1 ELSE 0 END) AS BIGINT) AS num_content_update
FROM fold GROUP BY domain_id
""")
def ingest_domain_metrics(spark, sf_dir):
    """AG-4: per-domain batch metrics."""
    return IG.batch_metrics(_outcomes(spark, sf_dir))[1]


@register("ingest_fail_reasons", oracle=f"""
WITH {_FOLD_SQL}
SELECT domain_id, fail_reason AS reason, CAST(count(*) AS BIGINT) AS n FROM fold
WHERE fail_reason IS NOT NULL AND fail_reason <> '' GROUP BY ALL
""")
def ingest_fail_reasons(spark, sf_dir):
    """AG-4: fail-reason counts per domain."""
    return IG.batch_metrics(_outcomes(spark, sf_dir))[2]


@register("ingest_global_metrics", oracle=f"""
WITH {_FOLD_SQL}
SELECT CAST(count(*) FILTER (WHERE new_link) AS BIGINT) AS new_links,
  CAST(sum(CASE WHEN is_ok THEN 1 ELSE 0 END) AS BIGINT) AS num_fetch_ok,
  CAST(sum(CASE WHEN is_ok THEN 0 ELSE 1 END) AS BIGINT) AS num_fetch_fail,
  CAST(sum(CASE WHEN is_upd THEN 1 ELSE 0 END) AS BIGINT) AS num_content_update
FROM fold
""")
def ingest_global_metrics(spark, sf_dir):
    """AG-4: global batch metrics."""
    return IG.batch_metrics(_outcomes(spark, sf_dir))[0]
