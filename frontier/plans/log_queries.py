"""Queries for log analytics (ST-5..ST-14, AG-11) over F7 logs; hour windows
(the driver events are sparse)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import logs as LG
from . import fixtures as FX
from .registry import register

_W = "time_bucket(INTERVAL '1 hour', ts)"


def _logs(spark, sf_dir):
    return FX.f7_logs(spark, sf_dir)


def _ws(df):
    return df.withColumn("window_start", F.col("window_start").cast("string"))


@register("log_event_rate", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start, worker_id, count(*) AS n, count(*) / 3600.0 AS rate FROM l GROUP BY ALL
""")
def log_event_rate(spark, sf_dir):
    """ST-5: events per second per worker (1 h windows)."""
    return _ws(LG.event_rate(_logs(spark, sf_dir), "1 hour", "worker_id", 3600))


@register("log_top_domains", oracle=f"""
WITH l AS ({FX.F7_SQL}),
c AS (SELECT {_W} AS ws, domain, count(*) AS n FROM l GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, domain) AS rank FROM c)
SELECT CAST(ws AS VARCHAR) AS window_start, domain, n, n / 3600.0 AS rate, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10
""")
def log_top_domains(spark, sf_dir):
    """ST-6: top-10 domains by rate in every hour."""
    return _ws(LG.top_domains(_logs(spark, sf_dir), "1 hour", 10, 3600))


@register("log_success_ratio", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start,
  count(*) FILTER (WHERE event = 'request.end' AND status < 400) AS ok,
  count(*) FILTER (WHERE event = 'request.end') AS ends,
  count(*) FILTER (WHERE event = 'request.fail' AND NOT coalesce(fail_reason, '') LIKE 'HttpError%') AS fails,
  CAST(count(*) FILTER (WHERE event = 'request.end' AND status < 400) AS DOUBLE) /
    nullif(count(*) FILTER (WHERE event = 'request.end') + count(*) FILTER (WHERE event = 'request.fail'
      AND NOT coalesce(fail_reason, '') LIKE 'HttpError%'), 0) AS success_ratio
FROM l GROUP BY 1
""")
def log_success_ratio(spark, sf_dir):
    """ST-7: request success ratio per hour."""
    return _ws(LG.success_ratio(_logs(spark, sf_dir), "1 hour"))


@register("log_latency_quantiles", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start, worker_id,
  quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99
FROM l WHERE event = 'request.end' GROUP BY ALL
""")
def log_latency_quantiles(spark, sf_dir):
    """ST-8: exact latency p50/p95/p99 per worker per hour."""
    return _ws(LG.latency_quantiles(_logs(spark, sf_dir), "1 hour"))


@register("log_gauge_averages", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start, worker_id, avg(inflight) AS avg_inflight, avg(pending) AS avg_pending,
  avg(active_domains) AS avg_active_domains, avg(transferring) AS avg_transferring, avg(slot_queue) AS avg_slot_queue
FROM l WHERE event = 'spider.heartbeat' GROUP BY ALL
""")
def log_gauge_averages(spark, sf_dir):
    """ST-9: gauge averages per worker per hour."""
    return _ws(LG.gauge_averages(_logs(spark, sf_dir), "1 hour"))


@register("log_error_tail", oracle=f"""
WITH l AS ({FX.F7_SQL}) SELECT event_id, worker_id, fail_reason FROM l WHERE level IN ('ERROR', 'WARNING')
""")
def log_error_tail(spark, sf_dir):
    """ST-10: error / warning lines."""
    return LG.error_tail(_logs(spark, sf_dir)).select("event_id", "worker_id", "fail_reason")


@register("log_lag_average", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start, worker_id, avg(lag_minutes) AS avg_lag_minutes FROM l GROUP BY ALL
""")
def log_lag_average(spark, sf_dir):
    """ST-11: average ingest lag per worker per hour."""
    return _ws(LG.lag_average(_logs(spark, sf_dir), "1 hour"))


@register("log_error_counts", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT CAST({_W} AS VARCHAR) AS window_start, worker_id, count(*) AS errors FROM l WHERE event = 'request.fail' GROUP BY ALL
""")
def log_error_counts(spark, sf_dir):
    """ST-12: failure events per worker per hour."""
    return _ws(LG.error_counts(_logs(spark, sf_dir), "1 hour", "request.fail"))


@register("log_errors_by_kind", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT regexp_replace(split_part(error, chr(10), 1), '[0-9]+', 'N', 'g') AS kind, count(*) AS n
FROM l WHERE error IS NOT NULL GROUP BY 1
""")
def log_errors_by_kind(spark, sf_dir):
    """ST-13: error counts by normalised first line."""
    return LG.errors_by_kind(_logs(spark, sf_dir))


@register("log_shard_consumption", oracle=f"""
WITH l AS ({FX.F7_SQL})
SELECT shard_id, CAST(sum(picked_urls) AS BIGINT) AS urls, count(*) AS visits, CAST(sum(picked_domains) AS BIGINT) AS domains
FROM l WHERE event = 'offer.refill_shard' GROUP BY shard_id
""")
def log_shard_consumption(spark, sf_dir):
    """ST-14: per-shard offerer consumption summary."""
    return LG.shard_consumption(_logs(spark, sf_dir))


@register("log_inflight_distribution", oracle=f"""
WITH l AS ({FX.F7_SQL}), h AS (SELECT worker_id, inflight FROM l WHERE event = 'spider.heartbeat')
SELECT worker_id, round(avg(inflight), 2) AS mean,
  list_sort(list(inflight))[CAST(greatest(1, least(count(*), ceil(count(*) * 0.5))) AS INTEGER)] AS p50,
  list_sort(list(inflight))[CAST(greatest(1, least(count(*), ceil(count(*) * 0.9))) AS INTEGER)] AS p90,
  max(inflight) AS max, count(*) FILTER (WHERE inflight >= 8) AS at_limit
FROM h GROUP BY worker_id
""")
def log_inflight_distribution(spark, sf_dir):
    """AG-11: mean / nearest-rank p50, p90 / max / at-limit count of in-flight
    requests per worker (limit 8)."""
    h = _logs(spark, sf_dir).filter(F.col("event") == "spider.heartbeat").withColumn("lim", F.lit(8))
    return LG.distribution_stats(h, "inflight", ["worker_id"], "lim")
