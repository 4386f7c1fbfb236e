"""Queries for selection and queue operators (WT-*, AG-1, AG-2, UM-11, SS-5, SS-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import select as SL
from . import fixtures as FX
from .registry import register

CAP, MAX_DOMAINS = 2, 3
_ELIGIBLE = f"""
st AS ({FX.F6_SQL}), dom AS ({FX.F5_SQL}),
el AS (SELECT * FROM st WHERE should_crawl AND domain_id % 50 <> 0
        AND domain_id NOT IN (SELECT domain_id FROM dom WHERE crawl_paused_until > {FX.AS_OF_SQL}))
"""
_URL_ORDER = ("url_score DESC NULLS LAST, domain_score DESC NULLS LAST, last_scheduled ASC NULLS FIRST, "
              "first_seen ASC NULLS LAST, url")


def _inputs(spark, sf_dir):
    st = FX.f6_selection_state(spark, sf_dir)
    queued = st.select("domain_id").filter(F.col("domain_id") % 50 == 0).distinct()  # domains already queued
    return st, FX.f5_domain_state(spark, sf_dir), queued


@register("select_example", oracle=f"""
WITH {_ELIGIBLE},
d AS (SELECT shard_id, domain_id, row_number() OVER (PARTITION BY shard_id ORDER BY domain_id) AS r
      FROM (SELECT DISTINCT shard_id, domain_id FROM el)),
c AS (SELECT el.shard_id, el.domain_id, el.url,
        row_number() OVER (PARTITION BY el.shard_id, el.domain_id ORDER BY {_URL_ORDER}) AS url_rank
      FROM el JOIN d ON el.shard_id = d.shard_id AND el.domain_id = d.domain_id AND d.r <= {MAX_DOMAINS})
SELECT shard_id, domain_id, url, CAST(url_rank AS INTEGER) AS url_rank FROM c WHERE url_rank <= {CAP}
""")
def select_example(spark, sf_dir):
    """WT-1: lowest domain ids per shard, top URLs per domain; paused and
    queued domains excluded (RJ-6, RJ-7, RJ-9)."""
    st, dom, q = _inputs(spark, sf_dir)
    return SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)


@register("select_ranked", headline=True, oracle=f"""
WITH {_ELIGIBLE},
a AS (SELECT shard_id, domain_id,
        max(CASE WHEN url_score_updated_at IS NOT NULL THEN url_score END) AS g, max(url_score) AS b,
        max(domain_score) AS ds, min(first_seen) AS fs FROM el GROUP BY ALL),
d AS (SELECT shard_id, domain_id, row_number() OVER (PARTITION BY shard_id ORDER BY g DESC NULLS LAST,
        b DESC NULLS LAST, ds DESC NULLS LAST, fs ASC NULLS LAST, domain_id) AS r FROM a),
c AS (SELECT el.shard_id, el.domain_id, el.url,
        row_number() OVER (PARTITION BY el.shard_id, el.domain_id ORDER BY
          CASE WHEN url_score_updated_at IS NULL THEN 1 ELSE 0 END, {_URL_ORDER}) AS url_rank
      FROM el JOIN d ON el.shard_id = d.shard_id AND el.domain_id = d.domain_id AND d.r <= {MAX_DOMAINS})
SELECT shard_id, domain_id, url, CAST(url_rank AS INTEGER) AS url_rank FROM c WHERE url_rank <= {CAP}
""")
def select_ranked(spark, sf_dir):
    """WT-2 / AG-1: domains ranked by refreshed best score, then URLs
    refreshed-first."""
    st, dom, q = _inputs(spark, sf_dir)
    return SL.select_by_domain(st, dom, q, "ranked", CAP, MAX_DOMAINS, FX.AS_OF)


@register("select_read_only", oracle=f"""
WITH st AS ({FX.F6_SQL}),
el AS (SELECT * FROM st WHERE should_crawl AND domain_id % 50 <> 0),
d AS (SELECT shard_id, domain_id, row_number() OVER (PARTITION BY shard_id ORDER BY domain_id) AS r
      FROM (SELECT DISTINCT shard_id, domain_id FROM el)),
c AS (SELECT el.shard_id, el.domain_id, el.url,
        row_number() OVER (PARTITION BY el.shard_id, el.domain_id ORDER BY {_URL_ORDER}) AS url_rank
      FROM el JOIN d ON el.shard_id = d.shard_id AND el.domain_id = d.domain_id AND d.r <= {MAX_DOMAINS})
SELECT shard_id, domain_id, url, CAST(url_rank AS INTEGER) AS url_rank FROM c WHERE url_rank <= {CAP}
""")
def select_read_only(spark, sf_dir):
    """WT-3: selection without the pause check and without any update."""
    st, dom, q = _inputs(spark, sf_dir)
    return SL.select_by_domain(st, dom, q, "read_only", CAP, MAX_DOMAINS, FX.AS_OF)


@register("domain_best_scores", oracle=f"""
WITH {_ELIGIBLE}
SELECT shard_id, domain_id, max(CASE WHEN url_score_updated_at IS NOT NULL THEN url_score END) AS best_golden_discovery_score,
  max(url_score) AS best_any_score, max(domain_score) AS best_domain_score, min(first_seen) AS oldest_first_seen
FROM el GROUP BY ALL
""")
def domain_best_scores(spark, sf_dir):
    """AG-1: per-domain best scores over eligible rows."""
    st, dom, q = _inputs(spark, sf_dir)
    return SL.domain_best_scores(SL.eligible_rows(st, dom, q, FX.AS_OF))


@register("eligible_domains", oracle=f"WITH {_ELIGIBLE} SELECT DISTINCT domain_id FROM el")
def eligible_domains(spark, sf_dir):
    """AG-2: distinct eligible domains."""
    st, dom, q = _inputs(spark, sf_dir)
    return SL.eligible_rows(st, dom, q, FX.AS_OF).select("domain_id").distinct()


_PICKED_EXAMPLE = f"""
{_ELIGIBLE},
d AS (SELECT shard_id, domain_id, row_number() OVER (PARTITION BY shard_id ORDER BY domain_id) AS r
      FROM (SELECT DISTINCT shard_id, domain_id FROM el)),
c AS (SELECT el.shard_id, el.domain_id, el.url,
        row_number() OVER (PARTITION BY el.shard_id, el.domain_id ORDER BY {_URL_ORDER}) AS url_rank
      FROM el JOIN d ON el.shard_id = d.shard_id AND el.domain_id = d.domain_id AND d.r <= {MAX_DOMAINS}),
picked AS (SELECT * FROM c WHERE url_rank <= {CAP})
"""


@register("select_apply_state", oracle=f"""
WITH {_PICKED_EXAMPLE}
SELECT st.url, FALSE AS should_crawl, {FX.AS_OF_SQL} AS last_scheduled,
  CAST(st.num_scheduled_90d + 1 AS INTEGER) AS num_scheduled_90d, st.url_score
FROM st JOIN picked p ON st.url = p.url
""")
def select_apply_state(spark, sf_dir):
    """UM-11 / RJ-10: state rows updated by a selection."""
    st, dom, q = _inputs(spark, sf_dir)
    picked = SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)
    return SL.apply_selection(st, picked, FX.AS_OF).changed.select(
        "url", "should_crawl", "last_scheduled", "num_scheduled_90d", "url_score")


@register("select_schedule_counters", oracle=f"""
WITH {_PICKED_EXAMPLE}
SELECT url, CAST(CAST({FX.AS_OF_SQL} AS DATE) AS VARCHAR) AS event_date, CAST(1 AS INTEGER) AS num_scheduled,
  TRUE AS accounted FROM picked
""")
def select_schedule_counters(spark, sf_dir):
    """UM-11: daily counter rows written by a selection."""
    st, dom, q = _inputs(spark, sf_dir)
    picked = SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)
    d = SL.apply_selection(st, picked, FX.AS_OF).counter_delta
    empty = d.sparkSession.createDataFrame([], "url string, event_date date, num_scheduled int, num_fetch_ok int, "
                                           "num_fetch_fail int, num_content_update int, accounted boolean, shard_id int")
    m = SL.merge_schedule_counters(empty, d)
    return m.select("url", F.col("event_date").cast("string").alias("event_date"), "num_scheduled", "accounted")


@register("queue_batches", oracle=f"""
WITH {_PICKED_EXAMPLE}
SELECT '{FX.AS_OF}' AS generated_at, domain_id, CAST(count(*) AS INTEGER) AS n_urls,
  string_agg(url, ' ' ORDER BY url_rank) AS urls FROM picked GROUP BY domain_id
""")
def queue_batches(spark, sf_dir):
    """SS-5: one queue record per domain with its URLs in rank order."""
    st, dom, q = _inputs(spark, sf_dir)
    picked = SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)
    qb = SL.queue_batches(picked, FX.AS_OF)
    return qb.select("generated_at", "domain_id", F.size("urls").alias("n_urls"), F.array_join("urls", " ").alias("urls"))


@register("queue_pop", oracle=f"""
WITH {_PICKED_EXAMPLE},
qb AS (SELECT DISTINCT domain_id, CAST(TIMESTAMP '2024-01-31' + to_minutes(CAST(domain_id % 97 AS INTEGER)) AS VARCHAR)
         AS generated_at FROM picked)
SELECT domain_id, generated_at FROM qb WHERE domain_id % 7 <> 0 ORDER BY generated_at, domain_id LIMIT 25
""")
def queue_pop(spark, sf_dir):
    """WT-7 / SS-6: pop the 25 oldest queue batches, skipping in-flight domains."""
    st, dom, q = _inputs(spark, sf_dir)
    picked = SL.select_by_domain(st, dom, q, "example", CAP, MAX_DOMAINS, FX.AS_OF)
    qb = SL.queue_batches(picked, FX.AS_OF).withColumn(
        "generated_at", (F.lit("2024-01-31").cast("timestamp")
                         + F.make_dt_interval(mins=(F.col("domain_id") % 97).cast("int"))).cast("string"))
    in_flight = SL.queued_domains(qb).filter(F.col("domain_id") % 7 == 0)
    popped, _ = SL.pop_batches(qb, 25, in_flight)
    return popped.select("domain_id", "generated_at")


@register("scorer_claim", oracle=f"""
WITH st AS ({FX.F6_SQL}),
c AS (SELECT shard_id, url, row_number() OVER (PARTITION BY shard_id ORDER BY first_seen ASC NULLS LAST, url) AS claim_rank
      FROM st WHERE should_crawl AND url_score_updated_at IS NULL)
SELECT shard_id, url, CAST(claim_rank AS INTEGER) AS claim_rank FROM c WHERE claim_rank <= 5
""")
def scorer_claim(spark, sf_dir):
    """WT-6 / PF-5: oldest unscored crawlable URLs per shard (5 per shard)."""
    st = FX.f6_selection_state(spark, sf_dir)
    return SL.claim_unscored(st, 5).select("shard_id", "url", "claim_rank")


@register("refill_allocation", oracle=f"""
WITH st AS ({FX.F6_SQL}),
sd AS (SELECT CAST(shard_id // 16 AS INTEGER) AS offerer_id, shard_id,
         (shard_id % 16 + 16 - (shard_id // 16) % 16) % 16 AS rotation_pos,
         CAST(count(DISTINCT domain_id) AS BIGINT) AS available FROM st WHERE should_crawl GROUP BY ALL),
qo AS (SELECT offerer_id, CAST(offerer_id * 10 AS BIGINT) AS queued FROM (SELECT DISTINCT offerer_id FROM sd)),
need AS (SELECT offerer_id, 200 - queued AS slots FROM qo WHERE queued < 120),
d AS (SELECT sd.*, need.slots, coalesce(sum(available) OVER (PARTITION BY sd.offerer_id ORDER BY rotation_pos, shard_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sd JOIN need USING (offerer_id))
SELECT offerer_id, shard_id, CAST(greatest(0, least(available, slots - before)) AS BIGINT) AS take
FROM d WHERE greatest(0, least(available, slots - before)) > 0
""")
def refill_allocation(spark, sf_dir):
    """WT-5: refill slots of offerers under the low watermark, shard by shard
    in rotation order (watermark 120, max 200)."""
    st = FX.f6_selection_state(spark, sf_dir).filter("should_crawl")
    sd = st.groupBy((F.floor(F.col("shard_id") / 16)).cast("int").alias("offerer_id"), "shard_id").agg(
        F.countDistinct("domain_id").cast("long").alias("available"))
    sd = sd.withColumn("rotation_pos", (F.col("shard_id") % 16 + 16 - F.col("offerer_id") % 16) % 16)
    qo = sd.select("offerer_id").distinct().withColumn("queued", (F.col("offerer_id") * 10).cast("long"))
    return SL.allocate_refill(qo, sd, 120, 200)
