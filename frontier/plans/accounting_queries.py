"""Queries for rolloff (RK-1, AG-3, AG-12) and the stats fold (AG-5, AG-6,
SC-23..SC-25, SS-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rolloff as RO
from ..operators import stats as STS
from . import fixtures as FX
from .registry import register

CUTOFF = "2024-01-20"
_ROLL_SQL = f"""
f4 AS ({FX.F4_SQL}), cur AS ({FX.F4_CURRENT_SQL}),
picked AS (SELECT * FROM f4 WHERE accounted AND event_date <= DATE '{CUTOFF}'),
proc AS (SELECT p.* FROM picked p JOIN cur c USING (url)),
miss AS (SELECT p.* FROM picked p LEFT JOIN cur c USING (url) WHERE c.url IS NULL),
pbu AS (SELECT url, sum(num_scheduled) s, sum(num_fetch_ok) o, sum(num_fetch_fail) f, sum(num_content_update) u
        FROM proc GROUP BY url)
"""


def _roll(spark, sf_dir):
    return RO.rolloff(FX.f4_current(spark, sf_dir), FX.f4_counters(spark, sf_dir).drop("user_id")
                      .withColumn("shard_id", F.lit(None).cast("int")), CUTOFF, FX.AS_OF)


@register("rolloff_state", headline=True, oracle=f"""
WITH {_ROLL_SQL}
SELECT c.url, CAST(greatest(0, c.n_sched - p.s) AS INTEGER) AS num_scheduled_90d,
  CAST(greatest(0, c.n_ok - p.o) AS INTEGER) AS num_fetch_ok_90d,
  CAST(greatest(0, c.n_fail - p.f) AS INTEGER) AS num_fetch_fail_90d,
  CAST(greatest(0, c.n_upd - p.u) AS INTEGER) AS num_content_update_90d
FROM cur c JOIN pbu p USING (url)
""")
def rolloff_state(spark, sf_dir):
    """RK-1 / AG-3: 90-day counters after rolling off rows up to the cutoff."""
    return _roll(spark, sf_dir).changed.select("url", "num_scheduled_90d", "num_fetch_ok_90d", "num_fetch_fail_90d",
                                               "num_content_update_90d")


@register("rolloff_totals", oracle=f"""
WITH {_ROLL_SQL}
SELECT (SELECT count(*) FROM picked) AS picked, (SELECT count(*) FROM proc) AS processed,
  (SELECT count(*) FROM miss) AS missing, (SELECT count(*) FROM pbu) AS history,
  (SELECT count(*) FROM proc) + (SELECT count(*) FROM miss) AS marked
""")
def rolloff_totals(spark, sf_dir):
    """AG-12 / SO-1 / RJ-11: picked, processed, missing, history and marked counts."""
    return _roll(spark, sf_dir).totals


@register("rolloff_counters", oracle=f"""
WITH {_ROLL_SQL}
SELECT url, CAST(event_date AS VARCHAR) AS event_date, num_fetch_ok,
  NOT (accounted AND event_date <= DATE '{CUTOFF}') AS accounted FROM f4
""")
def rolloff_counters(spark, sf_dir):
    """RK-1: counter rows with rolled-off rows (present or missing URL) marked."""
    c = _roll(spark, sf_dir).counters
    return c.select("url", F.col("event_date").cast("string").alias("event_date"), "num_fetch_ok", "accounted")


# ------------------------------------------------------------- stats deltas

def f8_delta_json(spark, sf_dir):
    """F8: one stats-delta JSON document per hour built from F1's records
    (per-domain ok/fail counts and fail reasons)."""
    f1 = FX.f1_fetches(spark, sf_dir).withColumn("hr", F.date_trunc("hour", "fetched_at"))
    ok = F.col("status") == "ok"
    per = f1.groupBy("hr", "domain_id").agg(F.count_if(ok).cast("long").alias("num_fetch_ok"),
                                            F.count_if(~ok).cast("long").alias("num_fetch_fail"))
    rs = (f1.filter(F.col("fail_reason").isNotNull()).groupBy("hr", "domain_id", "fail_reason")
          .agg(F.count(F.lit(1)).alias("n"))
          .groupBy("hr", "domain_id").agg(F.map_from_entries(F.collect_list(F.struct("fail_reason", "n")))
                                          .alias("fail_reasons")))
    per = per.join(rs, ["hr", "domain_id"], "left")
    doc = per.groupBy("hr").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("domain_id").cast("string"), F.struct(
            F.lit(0).cast("long").alias("num_scheduled"), "num_fetch_ok", "num_fetch_fail",
            F.lit(0).cast("long").alias("num_content_update"), "fail_reasons")))).alias("domains"),
        F.sum("num_fetch_ok").alias("num_fetch_ok"), F.sum("num_fetch_fail").alias("num_fetch_fail"))
    gr = (f1.filter(F.col("fail_reason").isNotNull()).groupBy("hr", "fail_reason").agg(F.count(F.lit(1)).alias("n"))
          .groupBy("hr").agg(F.map_from_entries(F.collect_list(F.struct("fail_reason", "n"))).alias("fr")))
    doc = doc.join(gr, "hr", "left")
    return doc.select(F.to_json(F.struct(
        F.date_format("hr", "yyyy-MM-dd'T'HH:mm:ssxxx").alias("generated_at"), F.lit("ingestor").alias("source"),
        F.struct(F.col("num_fetch_ok"), F.col("num_fetch_fail"), F.col("fr").alias("fail_reasons")).alias("counters"),
        "domains")).alias("value"))


_F8 = f"""
f1 AS ({FX.F1_SQL}), dom AS ({FX.F5_SQL}),
r AS (SELECT CAST(CAST(fetched_at AS DATE) AS VARCHAR) AS event_date, domain_id, status = 'ok' AS ok, fail_reason FROM f1)
"""


@register("stats_summary_daily", oracle=f"""
WITH {_F8}
SELECT event_date, CAST(0 AS BIGINT) AS new_links, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS num_fetch_ok,
  CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS num_fetch_fail, CAST(0 AS BIGINT) AS error_count
FROM r GROUP BY event_date
""")
def stats_summary_daily(spark, sf_dir):
    """AG-5 / SS-8 / SC-25: daily summary folded from parsed stats deltas."""
    good, _ = STS.parse_deltas(f8_delta_json(spark, sf_dir))
    s = STS.summary_daily(good, FX.AS_OF)
    return s.select(F.col("event_date").cast("string").alias("event_date"), "new_links", "num_fetch_ok",
                    "num_fetch_fail", "error_count")


@register("stats_domain_daily", oracle=f"""
WITH {_F8}
SELECT r.domain_id, r.event_date, d.shard_id, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS num_fetch_ok,
  CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS num_fetch_fail, CAST(0 AS BIGINT) AS num_scheduled
FROM r JOIN dom d USING (domain_id) GROUP BY ALL
""")
def stats_domain_daily(spark, sf_dir):
    """AG-6: per-domain daily stats (registry join supplies shard_id)."""
    good, _ = STS.parse_deltas(f8_delta_json(spark, sf_dir))
    d = STS.domain_stats_daily(good, FX.f5_domain_state(spark, sf_dir), FX.AS_OF)
    return d.select("domain_id", F.col("event_date").cast("string").alias("event_date"), "shard_id",
                    "num_fetch_ok", "num_fetch_fail", "num_scheduled")


@register("stats_domain_fail_reasons", oracle=f"""
WITH {_F8}
SELECT domain_id, event_date, fail_reason AS reason, CAST(count(*) AS BIGINT) AS n
FROM r WHERE fail_reason IS NOT NULL AND domain_id IN (SELECT domain_id FROM dom) GROUP BY ALL
""")
def stats_domain_fail_reasons(spark, sf_dir):
    """SC-23: per-domain daily fail-reason maps (summed key-wise), as rows."""
    good, _ = STS.parse_deltas(f8_delta_json(spark, sf_dir))
    d = STS.domain_stats_daily(good, FX.f5_domain_state(spark, sf_dir), FX.AS_OF)
    return STS.reason_rows(d.withColumn("event_date", F.col("event_date").cast("string")),
                           ["domain_id", "event_date"], "fail_reasons")
