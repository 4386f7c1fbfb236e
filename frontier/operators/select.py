"""URL selection for the fetch queue (SURVEY §2.8, WT-1..WT-9, UM-11, AG-1/2,
RJ-6/7/9/10, SS-5/6).

Selection runs over all shards at once: domains are ranked inside their
shard with ``row_number() <= max_domains``, URLs inside their domain with
``row_number() <= cap``.  Spark plans both as a WindowGroupLimit (a partial
top-k before the shuffle), so a hot shard or domain is cut to k rows per map
task before anything moves.  Paused and already-queued domains are removed
with anti joins before any ranking.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as SC


# Per-domain URL order of the example strategy (PostgreSQL
# defaults spelled out: ASC = NULLS LAST unless stated).
def example_url_order() -> list[Column]:
    return [F.col("url_score").desc_nulls_last(), F.col("domain_score").desc_nulls_last(),
            F.col("last_scheduled").asc_nulls_first(), F.col("first_seen").asc_nulls_last(), F.col("url")]


def ranked_url_order() -> list[Column]:
    return [F.when(F.col("url_score_updated_at").isNull(), 1).otherwise(0)] + example_url_order()


#: Parts of a shard that a claim orders on their own first.
CLAIM_PARTS = 32
ORDERS = {"example": example_url_order, "ranked": ranked_url_order, "read_only": example_url_order}


def eligible_rows(state: DataFrame, domain_state: DataFrame | None, queued: DataFrame | None,
                  as_of, check_pause: bool = True) -> DataFrame:
    """PF-4 + RJ-6 + RJ-7: crawlable rows of domains that are neither paused
    (``crawl_paused_until > as_of``) nor already queued."""
    rows = state.filter(F.col("should_crawl"))
    if queued is not None:
        rows = rows.join(queued.select("domain_id").distinct(), "domain_id", "left_anti")
    if check_pause and domain_state is not None:
        paused = domain_state.filter(F.col("crawl_paused_until") > F.lit(as_of).cast("timestamp")).select("domain_id")
        rows = rows.join(paused, "domain_id", "left_anti")
    return rows


def domain_best_scores(rows: DataFrame) -> DataFrame:
    """AG-1: per (shard, domain): best refreshed score, best score, best domain
    score, oldest first_seen."""
    return rows.groupBy("shard_id", "domain_id").agg(
        F.max(F.when(F.col("url_score_updated_at").isNotNull(), F.col("url_score"))).alias("best_golden_discovery_score"),
        F.max("url_score").alias("best_any_score"), F.max("domain_score").alias("best_domain_score"),
        F.min("first_seen").alias("oldest_first_seen"))


def select_by_domain(state: DataFrame, domain_state: DataFrame | None = None, queued: DataFrame | None = None,
                     strategy: str = "example", per_domain_cap: int = 100, max_domains: int = 200,
                     as_of=None) -> DataFrame:
    """WT-1/WT-2/WT-3/WT-4: pick up to ``per_domain_cap`` URLs from each of the
    first ``max_domains`` eligible domains of every shard.

    Returns ``shard_id, domain_id, url, url_rank``; empty when a limit <= 0.
    """
    if per_domain_cap <= 0 or max_domains <= 0:
        return state.select("shard_id", "domain_id", "url", F.lit(0).alias("url_rank")).limit(0)
    rows = eligible_rows(state, domain_state, queued, as_of, check_pause=(strategy != "read_only"))
    if strategy == "ranked":
        doms = domain_best_scores(rows)
        dorder = [F.col("best_golden_discovery_score").desc_nulls_last(), F.col("best_any_score").desc_nulls_last(),
                  F.col("best_domain_score").desc_nulls_last(), F.col("oldest_first_seen").asc_nulls_last(),
                  F.col("domain_id")]
    else:
        doms = rows.select("shard_id", "domain_id").distinct()
        dorder = [F.col("domain_id")]
    top = (doms.withColumn("__drank", F.row_number().over(Window.partitionBy("shard_id").orderBy(*dorder)))
               .filter(F.col("__drank") <= max_domains).select("shard_id", "domain_id"))
    cand = rows.join(top, ["shard_id", "domain_id"], "left_semi")
    w = Window.partitionBy("shard_id", "domain_id").orderBy(*ORDERS[strategy]())
    return (cand.withColumn("url_rank", F.row_number().over(w)).filter(F.col("url_rank") <= per_domain_cap)
                .select("shard_id", "domain_id", "url", "url_rank"))


@dataclass
class SelectionUpdate:
    changed: DataFrame        # updated url_state rows
    counter_delta: DataFrame  # url, event_date, num_scheduled (+1), accounted


def apply_selection(state: DataFrame, picked: DataFrame, as_of) -> SelectionUpdate:
    """UM-11 / RJ-10: picked rows get should_crawl=false, last_scheduled=as_of,
    num_scheduled_90d+1; their daily counter gets num_scheduled+1 and
    accounted=true."""
    now = F.lit(as_of).cast("timestamp")
    p = picked.select("url").distinct()
    changed = state.join(p, "url", "left_semi").select(*[
        (F.lit(False).alias(c) if c == "should_crawl" else
         now.alias(c) if c == "last_scheduled" else
         (F.coalesce(F.col(c), F.lit(0)) + 1).cast("int").alias(c) if c == "num_scheduled_90d" else F.col(c))
        for c in SC.URL_STATE.fieldNames()])
    delta = changed.select("url", F.to_date(now).alias("event_date"), F.lit(1).alias("num_scheduled"),
                           F.lit(True).alias("accounted"), "shard_id")
    return SelectionUpdate(changed, delta)


def merge_schedule_counters(counters: DataFrame, delta: DataFrame) -> DataFrame:
    """UM-11 counter upsert: num_scheduled + 1 and accounted = TRUE on conflict."""
    d = delta.select("url", "event_date", F.col("num_scheduled").alias("d_n"), F.lit(True).alias("__d"),
                     F.col("shard_id").alias("d_shard"))
    j = counters.join(d, ["url", "event_date"], "full_outer")
    out = []
    for c in SC.URL_EVENT_COUNTER.fieldNames():
        if c in ("url", "event_date"):
            out.append(F.col(c))
        elif c == "num_scheduled":
            out.append((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col("d_n"), F.lit(0))).cast("int").alias(c))
        elif c == "accounted":
            out.append(F.when(F.col("__d").isNotNull(), F.lit(True)).otherwise(F.col(c)).alias(c))
        elif c == "shard_id":
            out.append(F.coalesce(F.col(c), F.col("d_shard")).alias(c))
        else:
            out.append(F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c))
    return j.select(*out)


def queue_batches(picked: DataFrame, generated_at) -> DataFrame:
    """SS-5: one queue record per domain: ``generated_at, domain_id, urls``
    (URLs in rank order).  The per-domain array is bounded by the cap."""
    return (picked.groupBy("domain_id")
            .agg(F.sort_array(F.collect_list(F.struct("url_rank", "url"))).alias("__u"))
            .select(F.lit(generated_at).cast("string").alias("generated_at"), "domain_id",
                    F.transform("__u", lambda x: x["url"]).alias("urls")))


def queued_domains(queue: DataFrame) -> DataFrame:
    """SS-6: distinct queued domain ids."""
    return queue.select("domain_id").distinct()


def queue_counts(queue: DataFrame) -> DataFrame:
    """SS-6: one row: ``batches`` that wait, ``domain_batches`` (those that name a domain) and ``domains``."""
    per = queue.groupBy("domain_id").agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("batches"),
                   F.coalesce(F.sum(F.when(F.col("domain_id").isNotNull(), F.col("n"))), F.lit(0)).alias("domain_batches"), F.count("domain_id").alias("domains"))


def pop_batches(queue: DataFrame, limit: int = 0, in_flight: DataFrame | None = None):
    """WT-7: oldest batches first (generated_at, domain_id), skipping domains
    in flight; ``limit`` 0 = all.  Returns ``(popped, remaining)``."""
    q = queue
    if in_flight is not None:
        q = q.join(in_flight.select("domain_id").distinct(), "domain_id", "left_anti")
    if limit and limit > 0:
        # TakeOrderedAndProject: per-partition top-k, then a k-row merge
        popped = q.orderBy(F.col("generated_at").asc_nulls_last(), F.col("domain_id")).limit(limit)
    else:
        popped = q
    remaining = queue.join(popped.select("domain_id", "generated_at"), ["domain_id", "generated_at"], "left_anti")
    return popped, remaining


def claim_unscored(state: DataFrame, per_shard_limit: int) -> DataFrame:
    """WT-6 / PF-5: oldest unscored crawlable rows of every shard (first_seen
    ascending, NULLs last, then url), at most ``per_shard_limit`` per shard.
    Two levels: every part of a shard (by URL hash) keeps its oldest, so a shard with a
    third of the table is ordered by ``CLAIM_PARTS`` tasks, and one task orders no more than
    ``CLAIM_PARTS`` x the limit, whatever the limit is."""
    rows = state.filter(F.col("should_crawl") & F.col("url_score_updated_at").isNull())
    oldest = [F.col("first_seen").asc_nulls_last(), F.col("url")]
    part = Window.partitionBy("shard_id", "__part").orderBy(*oldest)
    first = (rows.withColumn("__part", F.pmod(F.xxhash64("url"), F.lit(CLAIM_PARTS))).withColumn("__rank", F.row_number().over(part))
             .filter(F.col("__rank") <= per_shard_limit).drop("__part", "__rank"))
    return first.withColumn("claim_rank", F.row_number().over(Window.partitionBy("shard_id").orderBy(*oldest))).filter(F.col("claim_rank") <= per_shard_limit)


def allocate_refill(queued_per_offerer: DataFrame, shard_demand: DataFrame, low_watermark: int,
                    max_queued: int) -> DataFrame:
    """WT-5: offerers below the low watermark refill ``max_queued - queued``
    slots, visiting their shards in rotation order; each shard takes what it
    offers from the slots still free.

    ``queued_per_offerer``: offerer_id, queued.  ``shard_demand``:
    offerer_id, shard_id, rotation_pos, available (domains the shard could
    offer).  Returns offerer_id, shard_id, take."""
    need = (queued_per_offerer.filter(F.col("queued") < low_watermark)
            .select("offerer_id", (F.lit(max_queued) - F.col("queued")).alias("slots")))
    d = shard_demand.join(need, "offerer_id")
    w = (Window.partitionBy("offerer_id").orderBy("rotation_pos", "shard_id")
         .rowsBetween(Window.unboundedPreceding, -1))
    before = F.coalesce(F.sum("available").over(w), F.lit(0))
    take = F.greatest(F.lit(0), F.least(F.col("available"), F.col("slots") - before))
    return d.select("offerer_id", "shard_id", take.cast("long").alias("take")).filter(F.col("take") > 0)


def scheduling_metrics(picked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AG-7: of picked URLs (``shard_id, domain_id, url``), the URLs scheduled per domain, and
    per shard its domains and URLs."""
    domains = picked.groupBy("domain_id").agg(F.count("*").alias("num_scheduled"))
    per = picked.groupBy("shard_id", "domain_id").agg(F.count("*").alias("n"))   # counted before the distinct
    shards = per.groupBy("shard_id").agg(F.count("*").alias("domains"), F.sum("n").alias("num_scheduled"))
    return domains, shards


def scheduling_deltas(picked: DataFrame, generated_at, shards_per_offerer: int = 16, source: str = "offerer") -> DataFrame:
    """SS-8: one stats-delta document (``value``) per offerer for its picked URLs, in the form
    that the daily fold reads.  An offerer's maps hold what it picked in one refill, which
    the selection caps bound."""
    rows = picked.withColumn("offerer", F.floor(F.col("shard_id") / shards_per_offerer).cast("int"))
    domains = (rows.groupBy("offerer", "domain_id").agg(F.count("*").alias("n")).groupBy("offerer")
               .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("domain_id").cast("string"), F.struct(F.col("n").alias("num_scheduled")))))).alias("domains"),
                    F.sum("n").alias("total")))
    shards = (scheduling_metrics(picked)[1].withColumn("offerer", F.floor(F.col("shard_id") / shards_per_offerer).cast("int")).groupBy("offerer")
              .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("shard_id").cast("string"), F.struct("domains", "num_scheduled"))))).alias("shards")))
    stamp = F.date_format(F.lit(generated_at).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return domains.join(shards, "offerer").select(F.to_json(F.struct(
        stamp.alias("generated_at"), F.lit(source).alias("source"), F.struct(F.col("total").alias("num_scheduled")).alias("counters"), "domains", "shards")).alias("value"))
