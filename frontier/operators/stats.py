"""Stats deltas and daily rollups (SURVEY §2.7 AG-5, AG-6; §2.3 SC-23..SC-25;
§2.1 SS-8, SS-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as SC

# Counter fields the daily summary knows; anything else in a
# delta is ignored.
SUMMARY_FIELDS = ("new_links", "num_scheduled", "num_fetch_ok", "num_fetch_fail", "num_content_update",
                  "error_count", "offer_error", "route_error", "ingest_error", "stats_error", "extract_error")
DOMAIN_FIELDS = ("num_scheduled", "num_fetch_ok", "num_fetch_fail", "num_content_update")


def parse_deltas(raw: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """SS-8/SS-9: parse JSON delta text; returns ``(good, bad)`` where bad rows
    (malformed JSON or not an object) are quarantined, never dropped."""
    parsed = raw.withColumn("__d", F.from_json(F.col(col), SC.STATS_DELTA, {"mode": "PERMISSIVE"}))
    ok = F.col("__d").isNotNull() & F.col(col).rlike(r"^\s*\{") & F.try_parse_json(F.col(col)).isNotNull()
    good = parsed.filter(ok).select("__d.*")
    bad = parsed.filter(~ok).select(F.col(col).alias("raw"))
    return good, bad


def delta_day(generated_at: Column, as_of) -> Column:
    """SC-25: the ISO day of ``generated_at`` (in the stamp's own offset),
    else the day of ``as_of``."""
    d = F.try_to_date(F.substring(generated_at, 1, 10), "yyyy-MM-dd")
    return F.coalesce(d, F.to_date(F.lit(as_of).cast("timestamp")))




def reason_rows(df: DataFrame, keys: list[str], map_col: str) -> DataFrame:
    """Explode a reason->count map into ``keys + [reason, n]`` rows."""
    return df.select(*keys, F.explode(F.col(map_col)).alias("reason", "n"))


def sum_reason_maps(df: DataFrame, keys: list[str], map_col: str) -> DataFrame:
    """SC-23: per group, the key-wise sum of reason->count maps
    (``groupBy(keys, reason).sum`` then ``map_from_entries``)."""
    r = reason_rows(df, keys, map_col).groupBy(*keys, "reason").agg(F.sum("n").alias("n"))
    return r.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias(map_col))


def summary_daily(deltas: DataFrame, as_of) -> DataFrame:
    """AG-5: daily global summary from deltas: known counter fields summed,
    fail reasons summed per key."""
    d = deltas.withColumn("event_date", delta_day(F.col("generated_at"), as_of))
    sums = d.groupBy("event_date").agg(*[F.sum(F.coalesce(F.col("counters." + c), F.lit(0))).cast("long").alias(c)
                                         for c in SUMMARY_FIELDS])
    reasons = sum_reason_maps(d.select("event_date", F.col("counters.fail_reasons").alias("fail_reasons")),
                              ["event_date"], "fail_reasons")
    return sums.join(reasons, "event_date", "left")


def domain_stats_daily(deltas: DataFrame, domain_state: DataFrame, as_of) -> DataFrame:
    """AG-6: per-domain daily stats: the ``domains`` map is exploded, keys
    that are not integers are skipped, unknown domains are skipped (inner
    join to the registry, which also supplies ``shard_id``)."""
    d = deltas.select(delta_day(F.col("generated_at"), as_of).alias("event_date"),
                      F.explode("domains").alias("k", "v"))
    d = d.select("event_date", F.col("k").try_cast("long").alias("domain_id"), "v").filter(F.col("domain_id").isNotNull())
    d = d.join(domain_state.select("domain_id", "shard_id"), "domain_id", "inner")
    sums = d.groupBy("domain_id", "event_date", "shard_id").agg(
        *[F.sum(F.coalesce(F.col("v." + c), F.lit(0))).cast("long").alias(c) for c in DOMAIN_FIELDS])
    reasons = sum_reason_maps(d.select("domain_id", "event_date", F.col("v.fail_reasons").alias("fail_reasons")),
                              ["domain_id", "event_date"], "fail_reasons")
    return sums.join(reasons, ["domain_id", "event_date"], "left")


def merge_daily(old: DataFrame, new: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    """Fold a day's stats into stored daily rows: counters add, reason maps
    add key-wise (``map_zip_with``)."""
    n = new.select(*keys, *[F.col(c).alias("n_" + c) for c in fields], F.col("fail_reasons").alias("n_fr"),
                   *([F.col("shard_id").alias("n_shard")] if "shard_id" in new.columns and "shard_id" not in keys else []))
    j = old.join(n, keys, "full_outer")
    add = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    cols = [*keys, *[add(F.col(c), F.col("n_" + c)).cast("long").alias(c) for c in fields],
            F.map_zip_with(F.coalesce(F.col("fail_reasons"), F.create_map().cast("map<string,bigint>")),
                           F.coalesce(F.col("n_fr"), F.create_map().cast("map<string,bigint>")),
                           lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))).alias("fail_reasons")]
    if "shard_id" in old.columns and "shard_id" not in keys:
        cols.append(F.coalesce(F.col("shard_id"), F.col("n_shard")).alias("shard_id"))
    return j.select(*cols)


def map_right_wins(a, b) -> Column:
    """SC-24: JSONB ``a || b`` - keys of ``b`` overwrite ``a`` (no duplicate-key
    error, unlike ``map_concat``)."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(y, x))
