"""Log analytics over the structured event log (SURVEY §2.12 ST-5..ST-16,
AG-11).  Every function takes a batch *or* streaming DataFrame of log events
(``ts, level, service, worker_id, shard_id, event, ...``) and returns a
windowed aggregate, so the same code runs in ``spark.read`` dashboards and in
``readStream`` jobs with a watermark.  Windows are Spark windows
``[start, end)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _win(ts: str, width: str, slide: str | None = None) -> Column:
    return F.window(F.col(ts).cast("timestamp"), width, slide) if slide else F.window(F.col(ts).cast("timestamp"), width)


def event_rate(logs: DataFrame, width: str = "1 minute", by: str = "worker_id", seconds: int = 60,
               slide: str | None = None) -> DataFrame:
    """ST-5: events per second per ``by``.  With ``slide`` the windows trail: one ends at
    every step and covers the ``width`` before it; without, they tumble."""
    return (logs.groupBy(_win("ts", width, slide).alias("w"), by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), by, "n", (F.col("n") / seconds).alias("rate")))


def top_domains(logs: DataFrame, width: str = "1 minute", k: int = 10, seconds: int = 60) -> DataFrame:
    """ST-6: top-k domains by event rate in every window (ties by domain)."""
    r = event_rate(logs, width, "domain", seconds)
    w = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col("domain"))
    return r.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def success_ratio(logs: DataFrame, width: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """ST-7: ok request ends (status < 400) over (ends + fails that are not
    HTTP errors) per window (trailing with ``slide``); NULL when the denominator is 0."""
    end = F.col("event") == "request.end"
    ok = end & (F.col("status") < 400)
    fail = (F.col("event") == "request.fail") & ~F.coalesce(F.col("fail_reason"), F.lit("")).startswith("HttpError")
    a = logs.groupBy(_win("ts", width, slide).alias("w")).agg(
        F.count_if(ok).alias("ok"), F.count_if(end).alias("ends"), F.count_if(fail).alias("fails"))
    return a.select(F.col("w.start").alias("window_start"), "ok", "ends", "fails",
                    F.try_divide(F.col("ok").cast("double"), F.nullif(F.col("ends") + F.col("fails"), F.lit(0)))
                    .alias("success_ratio"))


def _ranked_counts(df: DataFrame, value: Column, by: list) -> DataFrame:
    """``by``, ``__v``, ``__c``, ``__upto``, ``__n``: how often each value occurs, how many rows
    have it or a smaller one, and all rows.  Rows are counted before any group is ordered,
    so a group holds its distinct values only."""
    counts = df.withColumn("__v", value).where("__v IS NOT NULL").groupBy(*by, "__v").agg(F.count("*").alias("__c"))
    w = Window.partitionBy(*by)
    return (counts.withColumn("__upto", F.sum("__c").over(w.orderBy("__v"))).withColumn("__n", F.sum("__c").over(w)))


def latency_quantiles(logs: DataFrame, width: str = "1 minute", qs=(0.5, 0.95, 0.99)) -> DataFrame:
    """ST-8: exact, interpolated latency quantiles of request ends per worker and window."""
    ends = logs.filter(F.col("event") == "request.end").withColumn("window_start", _win("ts", width)["start"])
    by = ["window_start", "worker_id"]
    r = _ranked_counts(ends, F.col("latency_ms").cast("double"), by)

    def at(rank: Column) -> Column:   # the value of a rank that counts from 0
        return F.min(F.when(F.col("__upto") > rank, F.col("__v")))

    aggs = []
    for q in qs:
        place = q * (F.col("__n") - 1)
        part = F.max(place - F.floor(place))
        aggs.append((at(F.floor(place)) + (at(F.ceil(place)) - at(F.floor(place))) * part).alias(f"p{int(round(q * 100))}"))
    return r.groupBy(*by).agg(*aggs)


GAUGES = ("inflight", "pending", "active_domains", "transferring", "slot_queue")


def gauge_averages(logs: DataFrame, width: str = "1 minute", event: str = "spider.heartbeat") -> DataFrame:
    """ST-9: averages of the spider gauges per worker in one pass."""
    a = (logs.filter(F.col("event") == event)
         .groupBy(_win("ts", width).alias("w"), "worker_id").agg(*[F.avg(g).alias("avg_" + g) for g in GAUGES]))
    return a.select(F.col("w.start").alias("window_start"), "worker_id", *["avg_" + g for g in GAUGES])


def error_tail(logs: DataFrame, levels=("ERROR", "WARNING")) -> DataFrame:
    """ST-10: error and warning lines (an append-only filter)."""
    return logs.filter(F.col("level").isin(*levels))


def lag_average(logs: DataFrame, width: str = "1 minute") -> DataFrame:
    """ST-11: average ingest lag per worker."""
    a = logs.filter(F.col("lag_minutes").isNotNull()).groupBy(_win("ts", width).alias("w"), "worker_id") \
            .agg(F.avg("lag_minutes").alias("avg_lag_minutes"))
    return a.select(F.col("w.start").alias("window_start"), "worker_id", "avg_lag_minutes")


def error_counts(logs: DataFrame, width: str = "5 minutes", event: str = "ingest.batch_error") -> DataFrame:
    """ST-12: error events per worker per window."""
    a = logs.filter(F.col("event") == event).groupBy(_win("ts", width).alias("w"), "worker_id") \
            .agg(F.count(F.lit(1)).alias("errors"))
    return a.select(F.col("w.start").alias("window_start"), "worker_id", "errors")


def error_kind(error: Column) -> Column:
    """ST-13: first line of an error message with every digit run replaced by N."""
    first = F.substring_index(error, "\n", 1)
    return F.regexp_replace(first, "[0-9]+", "N")


def errors_by_kind(logs: DataFrame) -> DataFrame:
    return (logs.filter(F.col("error").isNotNull()).groupBy(error_kind(F.col("error")).alias("kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def shard_consumption(logs: DataFrame, event: str = "offer.refill_shard") -> DataFrame:
    """ST-14: per-shard summary of offerer picks (URLs, visits, domains)."""
    return (logs.filter(F.col("event") == event).groupBy("shard_id")
            .agg(F.sum("picked_urls").cast("long").alias("urls"), F.count(F.lit(1)).alias("visits"),
                 F.sum("picked_domains").cast("long").alias("domains")))


def shard_consumption_series(logs: DataFrame, width: str = "5 minutes", event: str = "offer.refill_shard") -> DataFrame:
    """ST-14: offerer picks per shard over time."""
    a = (logs.filter(F.col("event") == event).groupBy(_win("ts", width).alias("w"), "shard_id")
         .agg(F.sum("picked_urls").cast("long").alias("urls"), F.count(F.lit(1)).alias("visits"),
              F.sum("picked_domains").cast("long").alias("domains")))
    return a.select(F.col("w.start").alias("window_start"), "shard_id", "urls", "visits", "domains")


def parse_log_lines(lines: DataFrame, schema, col: str = "value") -> DataFrame:
    """ST-15: JSON log lines -> typed columns (unknown fields ignored,
    malformed lines give NULL fields)."""
    return lines.select(F.from_json(F.col(col), schema).alias("r")).select("r.*")


def enrich(logs: DataFrame, service: str, worker_id: int, shard_id: int | None = None) -> DataFrame:
    """ST-15: stamp service / worker / shard context onto log rows that lack it."""
    out = logs.withColumn("service", F.coalesce(F.col("service"), F.lit(service))) \
              .withColumn("worker_id", F.coalesce(F.col("worker_id"), F.lit(worker_id)))
    if shard_id is not None:
        out = out.withColumn("shard_id", F.coalesce(F.col("shard_id"), F.lit(shard_id)))
    return out


def request_latency(starts: DataFrame, ends: DataFrame, key: str = "request_id",
                    max_gap: str = "10 minutes") -> DataFrame:
    """ST-16: pair request starts with ends on a request id and derive total, download and
    pre-response milliseconds."""
    return _paired(starts, ends, key, max_gap, None, "inner")


def _paired(starts: DataFrame, ends: DataFrame, key: str, max_gap: str, late: str | None, how: str) -> DataFrame:
    s = starts.select(F.col(key), F.col("ts").cast("timestamp").alias("t_start"))
    e = ends.select(F.col(key).alias("__k"), F.col("ts").cast("timestamp").alias("t_end"),
                    F.col("download_latency_ms"))
    if late is not None:
        s, e = s.withWatermark("t_start", late), e.withWatermark("t_end", late)
    j = s.join(e, (F.col(key) == F.col("__k")) & (F.col("t_end") >= F.col("t_start"))
               & (F.col("t_end") <= F.col("t_start") + F.expr(f"INTERVAL {max_gap}")), how)
    total = ((F.unix_micros("t_end") - F.unix_micros("t_start")) / 1000).cast("long")
    return j.select(key, *(["t_start"] if how != "inner" else []), total.alias("total_ms"), F.col("download_latency_ms"),
                    (total - F.col("download_latency_ms")).alias("pre_response_ms"))


def stream_request_latency(starts: DataFrame, ends: DataFrame, key: str = "request_id", max_gap: str = "10 minutes", late: str = "20 minutes") -> DataFrame:
    """ST-16 on streams: every start once, with its end's milliseconds, or with nulls when the
    watermarks of both streams have passed the last moment its end could come. Both watermarks
    and the bounded gap let the engine drop what can't be paired any more."""
    return _paired(starts, ends, key, max_gap, late, "left_outer")


def distribution_stats(df: DataFrame, value: str, by: list[str], limit_col: str | None = None) -> DataFrame:
    """AG-11: mean (2 dp), nearest-rank p50 / p90, max and the number of
    values at their limit, per group."""
    r = _ranked_counts(df, F.col(value), by)

    def rank(q: float) -> Column:
        return F.min(F.when(F.col("__upto") >= F.greatest(F.lit(1), F.ceil(q * F.col("__n"))), F.col("__v")))

    out = r.groupBy(*by).agg(F.round(F.sum(F.col("__v") * F.col("__c")) / F.sum("__c"), 2).alias("mean"), rank(0.5).alias("p50"),
                             rank(0.9).alias("p90"), F.max("__v").alias("max"))
    if limit_col is None:
        return out
    return out.join(df.groupBy(*by).agg(F.count_if(F.col(value) >= F.col(limit_col)).alias("at_limit")), by)
