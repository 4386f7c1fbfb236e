"""Golden URL injection, link-graph edges
(UM-13) and content-feature upsert (UM-10)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as SC
from ..functions import urls as U
from ..session import cut_lineage
from .routing import resolve_domains


def injectable_urls(batches: DataFrame, queries: DataFrame, urls: DataFrame, as_of, age_days: int = 28) -> DataFrame:
    """PF-12 / SS-10 / RJ-12: URLs of metric batches at least ``age_days`` old
    (``created_at <= as_of - age``), via the batch -> query -> url chain; one row
    per record, repeats included."""
    old = batches.filter(F.col("created_at") <= F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(age_days)))
    q = queries.join(old.select(F.col("id").alias("batch_id")), "batch_id", "left_semi")
    return urls.join(q.select(F.col("id").alias("query_id")), "query_id", "left_semi").select("url")


@dataclass
class Injection:
    """Outcome of :func:`inject`."""

    inserted: DataFrame    # new URL_STATE rows
    history: DataFrame     # one history row per inserted URL
    marked: DataFrame      # existing rows, now with source = 1
    registry: DataFrame    # the domain registry with every new domain
    counts: DataFrame      # injected, marked, failed: records


def inject(state: DataFrame, registry: DataFrame, candidates: DataFrame, as_of, max_url_len: int = 2500,
           num_shards: int = 256, overrides: Mapping[str, int] | None = None, *, rules: U.SuffixRules | None,
           dry_run: bool = False) -> Injection:
    """UM-12: golden URLs.  A record fails if its URL is longer than
    ``max_url_len`` characters or its host has no eTLD+1.  The first record of an
    unknown URL inserts it with ``source = 1`` and the id, score and shard of its
    domain (get-or-create; shard of the eTLD+1 with the configured overrides),
    and writes a history row; every other record marks the existing row, without
    history.  ``dry_run`` counts all records that don't fail as injected and
    leaves the tables as they are.  ``candidates`` is read once for its distinct
    URLs (with their domains a written stage); repeats are counted by then."""
    c = candidates.groupBy("url").agg(F.count("*").alias("n"))
    c = c.withColumn("domain", F.when(F.length("url") <= max_url_len, U.registrable_domain(U.host_of(F.col("url")), rules)))
    c = c.join(state.select("url", F.lit(True).alias("known")), "url", "left").withColumn("known", F.col("known").isNotNull())
    c = cut_lineage(c.withColumn("shard_id", U.shard_id(F.col("domain"), num_shards, overrides)))
    good = F.col("domain").isNotNull()
    injected = F.col("n") if dry_run else (~F.col("known")).cast("bigint")
    total = lambda v: F.coalesce(F.sum(v), F.lit(0)).cast("bigint")
    counts = c.agg(total(F.when(good, injected)).alias("injected"), total(F.when(good, F.col("n") - injected)).alias("marked"),
                   total(F.when(~good, F.col("n"))).alias("failed"))
    if dry_run:
        c = c.where("false")
    good_rows = c.where(good)
    new_registry, resolved = resolve_domains(registry, good_rows.select("domain", "shard_id").distinct())
    own = resolved.select("domain", "domain_id", "domain_score")
    rows = (good_rows.where(~F.col("known")).join(own, "domain")
            .select("url", "domain_id", "domain_score", "shard_id", F.lit(1).alias("source"),
                    F.lit(as_of).cast("timestamp").alias("first_seen"), F.lit(0).alias("discovery_source_type")))
    inserted = SC.conform(rows, SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    history = inserted.select("url", "domain_id", "domain_score", "source", "shard_id", F.lit(as_of).cast("timestamp").alias("snapshot_at"))
    marked = state.join(good_rows.where("known").select("url"), "url", "left_semi").withColumn("source", F.lit(1).cast("short"))
    return Injection(inserted, history, marked, new_registry, counts)


def link_edges(edges_old: DataFrame, links: DataFrame, seen_at_col: str = "seen_at") -> DataFrame:
    """UM-13: link-graph edge upsert on ``(src, dst, md5(anchor))``:
    first_seen = min, last_seen = max over old and new sightings."""
    new = links.select(F.col("src"), F.col("dst"), F.unhex(F.md5(F.coalesce(F.col("anchor"), F.lit("")))).alias("anchor_md5"),
                       F.col(seen_at_col).alias("first_seen"), F.col(seen_at_col).alias("last_seen"))
    allrows = edges_old.select("src", "dst", "anchor_md5", "first_seen", "last_seen").unionByName(new)
    return allrows.groupBy("src", "dst", "anchor_md5").agg(F.min("first_seen").alias("first_seen"),
                                                          F.max("last_seen").alias("last_seen"))


def upsert_features(current: DataFrame, records: DataFrame):
    """UM-10: content features: the last record (by ``seq``) per URL
    overwrites fetched_at / content_length / content_hash / num_links; the
    first domain_id is kept for existing URLs; every record is appended to
    history (no freshness guard).  Returns ``(new_current, history)``."""
    w = Window.partitionBy("url").orderBy(F.col("seq").desc())
    last = records.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).drop("__r")
    first_dom = records.groupBy("url").agg(F.min_by("domain_id", "seq").alias("__first_dom"))
    cols = ["url", "domain_id", "fetched_at", "content_length", "content_hash", "num_links", "shard_id"]
    n = last.join(first_dom, "url").select(
        "url", F.col("__first_dom").alias("n_domain_id"), *[F.col(c).alias("n_" + c) for c in cols[2:]],
        F.lit(True).alias("__n"))
    j = current.select(*cols).join(n, "url", "full_outer")
    out = j.select("url", F.coalesce(F.col("domain_id"), F.col("n_domain_id")).alias("domain_id"),
                   *[F.when(F.col("__n").isNotNull(), F.col("n_" + c)).otherwise(F.col(c)).alias(c) for c in cols[2:]])
    history = records.select(*cols)
    return out, history
