"""Logical table schemas (one StructType per table family, plus ``shard_id``)
and additive schema evolution (``conform``, SK-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, L, I, SH, D, B, TS, DT = (T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(),
                             T.DoubleType(), T.BooleanType(), T.TimestampType(), T.DateType())


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# url_state current/history: the union of the ORM mixin and the columns the
# ingest SQL writes (``source``, ``discovered_from``).
URL_STATE = _struct(
    ("url", S), ("domain_id", L), ("first_seen", TS), ("last_scheduled", TS),
    ("last_fetch_ok", TS), ("last_content_update", TS), ("last_modified", TS),
    ("num_scheduled_90d", I), ("num_fetch_ok_90d", I), ("num_fetch_fail_90d", I),
    ("num_content_update_90d", I), ("num_consecutive_fail", I), ("last_fail_reason", S),
    ("content_hash", S), ("should_crawl", B), ("url_score", D), ("url_score_updated_at", TS),
    ("domain_score", D), ("source", SH), ("discovered_from", S), ("title", S),
    ("hreflang_count", I), ("has_json_ld", B), ("etag", S), ("cache_control", S),
    ("is_redirect", B), ("redirect_hop_count", SH), ("discovery_source_type", SH),
    ("parent_page_score", D), ("inlink_count_approx", I), ("inlink_count_external", I),
    ("anchor_text", S), ("robots_bits", SH), ("shard_id", I),
)

# Column defaults of url_state for a freshly inserted row.
URL_STATE_DEFAULTS = {
    "num_scheduled_90d": 0, "num_fetch_ok_90d": 0, "num_fetch_fail_90d": 0,
    "num_content_update_90d": 0, "num_consecutive_fail": 0, "should_crawl": True,
    "url_score": 0.0, "domain_score": 0.0, "source": 0, "inlink_count_approx": 0,
    "inlink_count_external": 0, "discovery_source_type": 0, "robots_bits": 0,
}

URL_HISTORY = T.StructType(URL_STATE.fields + [T.StructField("snapshot_at", TS, True)])

URL_EVENT_COUNTER = _struct(
    ("url", S), ("event_date", DT), ("num_scheduled", I), ("num_fetch_ok", I),
    ("num_fetch_fail", I), ("num_content_update", I), ("accounted", B), ("shard_id", I),
)
COUNTER_DEFAULTS = {"num_scheduled": 0, "num_fetch_ok": 0, "num_fetch_fail": 0,
                    "num_content_update": 0, "accounted": True}

CONTENT_FEATURE = _struct(
    ("url", S), ("domain_id", L), ("fetched_at", TS), ("content_length", I),
    ("content_hash", S), ("num_links", I), ("shard_id", I),
)

DOMAIN_STATE = _struct(
    ("domain_id", L), ("domain", S), ("shard_id", I), ("domain_score", D),
    ("crawl_paused_until", TS), ("domain_fail_count", I),
)
DOMAIN_STATE_DEFAULTS = {"domain_score": 0.0, "domain_fail_count": 0}

REASON_MAP = T.MapType(S, L)

DOMAIN_STATS_DAILY = _struct(
    ("domain_id", L), ("event_date", DT), ("shard_id", I), ("num_scheduled", L),
    ("num_fetch_ok", L), ("num_fetch_fail", L), ("num_content_update", L),
) .add("fail_reasons", REASON_MAP)

SUMMARY_DAILY = _struct(
    ("event_date", DT), ("new_links", L), ("num_scheduled", L), ("num_fetch_ok", L),
    ("num_fetch_fail", L), ("num_content_update", L), ("error_count", L),
    ("offer_error", L), ("route_error", L), ("ingest_error", L), ("stats_error", L),
    ("extract_error", L),
).add("fail_reasons", REASON_MAP)

# Crawl result record as written by the fetcher (JSONL).
OUTLINK = _struct(("url", S), ("domain", S), ("anchor", S))
CRAWL_RESULT = _struct(
    ("url", S), ("domain", S), ("fetched_at", S), ("status", S), ("fail_reason", S),
    ("content", S),
).add("outlinks", T.ArrayType(OUTLINK)).add("title", S).add("hreflang_count", I) \
 .add("has_json_ld", B).add("last_modified", S).add("etag", S).add("cache_control", S) \
 .add("is_redirect", B).add("redirect_hop_count", I)

# Routed result / routed link records (router output).
ROUTED_OUTLINK = _struct(("url", S), ("domain_id", L), ("anchor", S))
ROUTED_RESULT = _struct(
    ("url", S), ("status", S), ("fetched_at", S), ("fail_reason", S), ("content", S),
).add("outlinks", T.ArrayType(ROUTED_OUTLINK)).add("shard_id", I).add("domain_id", L) \
 .add("content_hash", S).add("title", S).add("hreflang_count", I).add("has_json_ld", B) \
 .add("last_modified", S).add("etag", S).add("cache_control", S).add("is_redirect", B) \
 .add("redirect_hop_count", I)
ROUTED_LINK = _struct(
    ("url", S), ("status", S), ("shard_id", I), ("domain_id", L), ("domain_score", D),
    ("discovered_from", S), ("discovery_source_type", SH), ("parent_page_score", D),
    ("inlink_count_approx", I), ("inlink_count_external", I), ("anchor_text", S),
)

# Stats delta file (one JSON object per file).
_DELTA_DOMAIN = _struct(("num_scheduled", L), ("num_fetch_ok", L), ("num_fetch_fail", L),
                        ("num_content_update", L)).add("fail_reasons", REASON_MAP)
DELTA_COUNTER_FIELDS = ("new_links", "num_scheduled", "num_fetch_ok", "num_fetch_fail",
                        "num_content_update", "error_count", "offer_error", "route_error",
                        "ingest_error", "stats_error", "extract_error")
STATS_DELTA = _struct(("generated_at", S), ("source", S)) \
    .add("counters", T.StructType([T.StructField(c, L) for c in DELTA_COUNTER_FIELDS]
                                  + [T.StructField("fail_reasons", REASON_MAP)])) \
    .add("domains", T.MapType(S, _DELTA_DOMAIN)) \
    .add("shards", T.MapType(S, _struct(("domains", L), ("num_scheduled", L))))

QUEUE_BATCH = _struct(("generated_at", S), ("domain_id", L)).add("urls", T.ArrayType(S))

LOG_EVENT = _struct(
    ("ts", TS), ("level", S), ("service", S), ("worker_id", I), ("shard_id", I), ("event", S),
    ("domain", S), ("status", I), ("latency_ms", L), ("fail_reason", S), ("error", S),
    ("inflight", L), ("pending", L), ("active_domains", L), ("transferring", L),
    ("slot_queue", L), ("picked_urls", L), ("picked_domains", L), ("lag_minutes", D),
)

SPLIT_WHITELIST = _struct(("host", S), ("migrated_at", TS))


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Additive schema evolution (SK-1): add missing columns (default or NULL),
    cast present ones, and order columns as in ``schema``.  Extra columns are
    dropped.  Pure projection - no shuffle."""
    defaults = defaults or {}
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
        elif f.name in defaults:
            c = F.lit(defaults[f.name])
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
