"""Routing operators: host -> shard key -> shard id ->
ingestor, domain registry get-or-create, outlink explosion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import cut_lineage


def with_shard_columns(df: DataFrame, url_col: str = "url", whitelist: DataFrame | None = None,
                       num_shards: int = 256, overrides: Mapping[str, int] | None = None,
                       shards_per_ingestor: int = 16, *, rules: U.SuffixRules | None,
                       prefix: str = "") -> DataFrame:
    """Add ``host``, ``shard_key``, ``shard_id``, ``ingestor_id`` (SC-1, SC-4..6).

    The split whitelist (``host`` column) is a plain left join: its side is
    broadcast at run time if its bytes allow it."""
    return _shard_of_host(df.withColumn(prefix + "host", U.host_of(F.col(url_col))), whitelist, num_shards, overrides,
                          shards_per_ingestor, rules, prefix)


def _shard_of_host(df: DataFrame, whitelist: DataFrame | None, num_shards: int, overrides: Mapping[str, int] | None,
                   shards_per_ingestor: int, rules: U.SuffixRules | None, prefix: str = "") -> DataFrame:
    host, out, split = prefix + "host", df, None
    if whitelist is not None:
        wl = whitelist.select(F.col("host").alias("__wl_host")).distinct() \
                      .withColumn("__wl_hit", F.lit(True))
        out = out.join(wl, out[host] == wl["__wl_host"], "left").drop("__wl_host")
        split = F.col("__wl_hit")
    out = out.withColumn(prefix + "shard_key", U.shard_key(F.col(host), split, rules=rules))
    if whitelist is not None:
        out = out.drop("__wl_hit")
    out = out.withColumn(prefix + "shard_id", U.shard_id(F.col(prefix + "shard_key"), num_shards, overrides))
    return out.withColumn(prefix + "ingestor_id", U.ingestor_of(F.col(prefix + "shard_id"), shards_per_ingestor))


ID_BUCKETS = 256


def resolve_domains(registry: DataFrame, keys: DataFrame, overwrite_shard: bool = False):
    """RJ-1 / RJ-2: domain registry get-or-create.

    ``keys``: ``domain, shard_id`` (one shard per domain key).  Unseen
    domains get new dense ids after ``max(domain_id)``: ids are numbered per
    md5 bucket of the domain (a window per bucket) plus the bucket's offset
    (a 256-row prefix sum), so no step runs in a single task.  Existing
    domains keep id, score and shard - unless ``overwrite_shard`` (RJ-2), in
    which case the key's shard replaces the stored one.

    Returns ``(new_registry, resolved)``; ``resolved`` is ``domain,
    domain_id, domain_score, shard_id`` for every key."""
    k = keys.select("domain", "shard_id").dropDuplicates(["domain"])
    reg = registry.select("domain_id", "domain", "shard_id", "domain_score", "crawl_paused_until", "domain_fail_count")
    new = k.join(reg.select("domain"), "domain", "left_anti").withColumn("__b", U.md5_mod(F.col("domain"), ID_BUCKETS))
    new = new.withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy("domain")))
    counts = new.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(
        Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # <= 256 rows
    base = reg.agg(F.coalesce(F.max("domain_id"), F.lit(0)).alias("__base"))         # one row
    new_rows = (new.join(F.broadcast(offsets.select("__b", "__off")), "__b").crossJoin(F.broadcast(base))
                .select((F.col("__base") + F.col("__off") + F.col("__rn")).cast("long").alias("domain_id"), "domain",
                        F.col("shard_id").cast("int").alias("shard_id"), F.lit(0.0).alias("domain_score"),
                        F.lit(None).cast("timestamp").alias("crawl_paused_until"), F.lit(0).alias("domain_fail_count")))
    if overwrite_shard:
        upd = reg.join(k.select("domain", F.col("shard_id").alias("__ks")), "domain", "left").withColumn(
            "shard_id", F.coalesce(F.col("__ks"), F.col("shard_id"))).drop("__ks")
        reg = upd.select(*new_rows.columns)
    new_registry = reg.select(*new_rows.columns).unionByName(new_rows)
    resolved = k.select("domain").join(new_registry, "domain", "inner").select(
        "domain", "domain_id", F.coalesce(F.col("domain_score"), F.lit(0.0)).alias("domain_score"), "shard_id")
    return new_registry, resolved


def route_results(records: DataFrame, registry: DataFrame, id_cols: list[str], whitelist: DataFrame | None = None,
                  num_shards: int = 256, overrides: Mapping[str, int] | None = None,
                  shards_per_ingestor: int = 16, *, rules: U.SuffixRules | None, ordered: bool = False):
    """RJ-3 / RJ-4 / RJ-5 / SC-7: route crawl records.

    ``id_cols`` name the columns that identify a record in its source; give
    stored records, or ones whose extraction is staged, since they are read for
    their hosts and again for each output.  Shard, registry id and score are
    worked out once for every distinct host; a link meets its target in one
    join on the host, and its source columns come along from the page's row.

    Returns ``(routed_results, link_records, new_registry)``:
    * routed results: record columns + ``host, shard_key, shard_id,
      ingestor_id, domain_id, content_hash`` and outlinks as
      ``array<struct<url, domain_id, anchor>>``;
    * link records (one per outlink, status ``new``): target shard, domain id
      and score, ``parent_page_score`` = the *source* domain's score,
      ``inlink_count_external`` = source key differs from target key;
      ``ordered`` adds ``id_cols`` and ``pos``, the link's place in its page;
    * the registry with every unseen domain key added (RJ-1).
    """
    recs = records.withColumn("__host", U.host_of(F.col("url")))

    def exploded(df: DataFrame, *columns) -> DataFrame:
        # outer, then a filter: an inner explode has the whole extraction copied into an inferred size() > 0 filter
        rows = df.select(*columns, F.posexplode_outer("outlinks").alias("__pos", "__l"))
        return (rows.where(F.coalesce(F.col("__l.url"), F.lit("")) != "")
                .withColumn("__dst_host", U.host_of(F.col("__l.url"))))

    seen = recs.select(F.col("__host").alias("host")).unionByName(exploded(recs).select(F.col("__dst_host").alias("host"))).distinct()
    hosts = _shard_of_host(seen, whitelist, num_shards, overrides, shards_per_ingestor, rules)
    hosts = cut_lineage(hosts)
    new_registry, resolved = resolve_domains(registry, hosts.select(F.col("shard_key").alias("domain"), "shard_id"))
    known = cut_lineage(hosts.join(resolved.select(F.col("domain").alias("shard_key"), "domain_id", "domain_score"), "shard_key"))
    src = known.withColumnRenamed("host", "__host").withColumn("host", F.col("__host"))
    routed = recs.join(src, "__host", "left").drop("__host")
    dst = known.select(F.col("host").alias("__dst_host"), *[F.col(c).alias(f"__d_{c}") for c in
                                                             ("shard_key", "shard_id", "ingestor_id", "domain_id", "domain_score")])
    links = exploded(routed, *id_cols, F.col("url").alias("discovered_from"), F.col("shard_key").alias("__src_key"),
                     F.col("domain_score").alias("__src_score")).join(dst, "__dst_host")
    link_records = links.select(
        F.col("__l.url").alias("url"), F.lit("new").alias("status"), F.col("__d_shard_id").alias("shard_id"),
        F.col("__d_ingestor_id").alias("ingestor_id"), F.col("__d_domain_id").alias("domain_id"),
        F.col("__d_domain_score").alias("domain_score"), "discovered_from",
        F.lit(1).cast("short").alias("discovery_source_type"), F.col("__src_score").alias("parent_page_score"),
        F.lit(1).alias("inlink_count_approx"), (F.col("__src_key") != F.col("__d_shard_key")).cast("int").alias("inlink_count_external"),
        F.col("__l.anchor").alias("anchor_text"), *([*id_cols, F.col("__pos").alias("pos")] if ordered else []))
    arrays = links.groupBy(*id_cols).agg(F.sort_array(F.collect_list(F.struct(
        "__pos", F.col("__l.url").alias("url"), F.col("__d_domain_id").alias("domain_id"), F.col("__l.anchor").alias("anchor")))).alias("__ol"))
    routed = (routed.join(arrays, id_cols, "left")
              .withColumn("outlinks", F.coalesce(F.transform("__ol", lambda x: F.struct(
                  x["url"].alias("url"), x["domain_id"].alias("domain_id"), x["anchor"].alias("anchor"))),
                  F.array().cast("array<struct<url:string,domain_id:bigint,anchor:string>>")))
              .withColumn("content_hash", U.content_hash(F.col("status"), F.col("content")))
              .drop("__ol", "domain_score"))
    return routed, link_records, new_registry


def dispatch(df: DataFrame, by: str = "ingestor_id") -> DataFrame:
    """RJ-5: co-locate records of one ingestor (hash partitioning on the key);
    write with ``partitionBy(by)`` to get one folder per ingestor."""
    return df.repartition(by)
