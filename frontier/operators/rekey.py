"""Re-keying and shard maintenance (SURVEY §2.11 RK-2..RK-7, §2.9 SO-2,
§2.7 AG-8..AG-10, AG-13, §2.2 PF-10/11/14, SK-2).

All jobs are ``plan_*`` (a report DataFrame, the dry run) or ``apply_*``
(new table DataFrames).  Every mapping is an equi-join; subdomain-of tests
explode each host's parent suffixes and join on them instead of a LIKE
predicate (no theta join)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U

# Valid DNS host name pattern.
DNS_HOST_RE = r"^[a-z0-9]([a-z0-9-]{0,62}[a-z0-9])?(\.[a-z0-9]([a-z0-9-]{0,62}[a-z0-9])?)*$"


def is_dns_host(host) -> Column:
    """PF-10: valid DNS host name."""
    return U._c(host).rlike(DNS_HOST_RE)


def parent_suffixes(host) -> Column:
    """All proper dotted suffixes of a host (``a.b.c`` -> ``[b.c, c]``)."""
    labels = F.split(U._c(host), r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
                       lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))


def under_parents(df: DataFrame, host_col: str, parents: DataFrame) -> DataFrame:
    """PF-11: rows whose host equals a parent or is a subdomain of it
    (``host = p OR host LIKE '%.p'``) as an equi-join of the distinct hosts'
    suffixes with the parents; adds ``parent``, the longest one of a host that
    lies below several, so that a row comes out once."""
    hosts = df.select(F.col(host_col).alias("__h")).where(F.col(host_col).isNotNull()).distinct()
    cand = hosts.withColumn("parent", F.explode(F.array_union(F.array("__h"), parent_suffixes(F.col("__h")))))
    found = (cand.join(parents.select("parent").distinct(), "parent")
             .groupBy("__h").agg(F.max_by("parent", F.length("parent")).alias("parent")))
    return df.join(found, df[host_col] == found["__h"]).drop("__h")


def host_counts(state: DataFrame, parent: str | None = None) -> DataFrame:
    """AG-8: ok-fetched rows per host (optionally under one parent), with the
    shards the host's rows live in."""
    rows = state.filter(F.col("last_fetch_ok").isNotNull()).withColumn("host", U.host_extract_sql(F.col("url")))
    rows = rows.filter(F.col("host").isNotNull())
    if parent:
        rows = rows.filter((F.col("host") == parent) | F.col("host").endswith("." + parent))
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                    F.array_sort(F.collect_set("shard_id")).alias("shards"))


def top_hosts(counts: DataFrame, k: int = 20) -> DataFrame:
    """WT-9: top-k host candidates by count (ties by host)."""
    return counts.orderBy(F.col("n").desc(), F.col("host")).limit(k)


def error_rate_parents(stats: DataFrame, registry: DataFrame, since, min_attempts: int, k: int) -> DataFrame:
    """AG-9: parents (registry domains) with the highest fail ratio over daily
    stats since ``since``; at least ``min_attempts`` attempts; ratio uses
    NULLIF on the denominator."""
    s = stats.filter(F.col("event_date") >= F.to_date(F.lit(since))).join(registry.select("domain_id", "domain"),
                                                                          "domain_id")
    a = s.groupBy("domain").agg(F.sum("num_fetch_ok").alias("ok"), F.sum("num_fetch_fail").alias("fail"))
    a = a.withColumn("attempts", F.col("ok") + F.col("fail")).filter(F.col("attempts") >= min_attempts)
    a = a.withColumn("fail_ratio", F.try_divide(F.col("fail").cast("double"), F.nullif(F.col("attempts"), F.lit(0))))
    return a.orderBy(F.col("fail_ratio").desc_nulls_last(), F.col("domain")).limit(k)


def projected_shards(counts: DataFrame, num_shards: int = 256,
                     overrides: Mapping[str, int] | None = None) -> DataFrame:
    """AG-10: shard each host would get if split out, and hosts per shard."""
    c = counts.withColumn("new_shard", U.shard_id(F.col("host"), num_shards, overrides))
    return c.groupBy("new_shard").agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("rows"))


def whitelist_diff(counts: DataFrame, whitelist: DataFrame, robots: DataFrame, min_count: int,
                   *, rules: U.SuffixRules | None) -> DataFrame:
    """SO-2: label scanned hosts ADD (count >= min, robots ok, not an apex
    domain, not listed), REMOVE (listed and robots blocked) or KEEP (listed,
    not blocked).  ``robots``: host, status ('ok' | 'blocked')."""
    wl = whitelist.select("host", F.lit(True).alias("__listed"))
    rb = robots.select("host", F.col("status").alias("__robots"))
    j = counts.join(wl, "host", "left").join(rb, "host", "left")
    listed = F.coalesce(F.col("__listed"), F.lit(False))
    blocked = F.col("__robots") == "blocked"
    apex = F.coalesce(U.registrable_domain(F.col("host"), rules) == F.col("host"), F.lit(False))
    label = (F.when(listed & F.coalesce(blocked, F.lit(False)), "REMOVE").when(listed, "KEEP")
             .when((F.col("n") >= min_count) & (F.col("__robots") == "ok") & ~apex, "ADD"))
    return j.select("host", "n", label.alias("action")).filter(F.col("action").isNotNull())


def apply_whitelist_diff(whitelist: DataFrame, diff: DataFrame, as_of) -> DataFrame:
    """SO-2 / SK-2: final list = (current + ADD) - REMOVE; listed hosts that
    were not scanned stay; added hosts are pending (``migrated_at`` NULL)."""
    add = diff.filter(F.col("action") == "ADD").select("host", F.lit(None).cast("timestamp").alias("migrated_at"))
    rem = diff.filter(F.col("action") == "REMOVE").select("host")
    return whitelist.select("host", "migrated_at").unionByName(add).dropDuplicates(["host"]).join(rem, "host", "left_anti")


def pending_hosts(whitelist: DataFrame) -> DataFrame:
    """PF-14: whitelist entries not yet migrated."""
    return whitelist.filter(F.col("migrated_at").isNull())


def mark_migrated(whitelist: DataFrame, hosts: DataFrame, as_of) -> DataFrame:
    """PF-14: stamp ``migrated_at`` on the given hosts."""
    h = hosts.select("host", F.lit(True).alias("__m"))
    return whitelist.join(h, "host", "left").withColumn(
        "migrated_at", F.when(F.col("__m").isNotNull() & F.col("migrated_at").isNull(),
                              F.lit(as_of).cast("timestamp")).otherwise(F.col("migrated_at"))).drop("__m")


def plan_split(state: DataFrame, pending: DataFrame, num_shards: int = 256,
               overrides: Mapping[str, int] | None = None) -> DataFrame:
    """RK-2 (dry run): rows whose host is a pending split host, with the
    target shard (host as its own key)."""
    rows = state.withColumn("host", U.host_extract_sql(F.col("url")))
    moving = rows.join(pending.select("host").distinct(), "host", "left_semi")
    return moving.withColumn("new_shard_id", U.shard_id(F.col("host"), num_shards, overrides))


def rekey(state: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """RK-2 core: replace ``domain_id``/``shard_id`` of rows matched by ``key`` (a column of
    both inputs, once in ``mapping``) with the mapping's ``new_domain_id``, ``new_shard_id``.
    Target-wins: a moved URL that a row which doesn't move already has is discarded; of two
    moved rows of one URL the one with the smallest (old shard, old domain) stays.  Rows that
    don't move only pass an anti join on the mapped keys."""
    m = mapping.select(key, "new_domain_id", "new_shard_id")
    stay = state.join(m.select(key), key, "left_anti").select(*state.columns)
    order = Window.partitionBy("url").orderBy("__shard", "__domain")
    moved = (state.join(m, key).withColumn("__shard", F.col("shard_id")).withColumn("__domain", F.col("domain_id"))
             .withColumn("domain_id", F.col("new_domain_id")).withColumn("shard_id", F.col("new_shard_id"))
             .withColumn("__r", F.row_number().over(order)).where("__r = 1").select(*state.columns))
    return stay.unionByName(moved.join(stay.select("url"), "url", "left_anti").select(*state.columns))


def follow_counters(counters: DataFrame, moved_state: DataFrame) -> DataFrame:
    """RK-2: counter rows of moved URLs, re-sharded with them."""
    return counters.drop("shard_id").join(moved_state.select("url", "shard_id"), "url", "inner")


def classify_domains(registry: DataFrame, rules: U.SuffixRules | None) -> DataFrame:
    """RK-6: clean (domain is its own eTLD+1), dirty (a subdomain: canonical =
    eTLD+1), unparseable (no eTLD+1), junk (not a DNS host)."""
    reg = U.registrable_domain(F.col("domain"), rules)
    return registry.select("domain_id", "domain", reg.alias("canonical"),
                           F.when(~is_dns_host(F.col("domain")), "junk").when(reg.isNull(), "unparseable")
                           .when(reg == F.col("domain"), "clean").otherwise("dirty").alias("kind"))


def oversize_sweep(tables: Mapping[str, DataFrame], max_bytes: int = 2500) -> DataFrame:
    """PF-3 / SO-3: dry-run counts of URLs over ``max_bytes`` bytes per table
    family and shard (a union over the families)."""
    parts = [t.filter(F.octet_length("url") > max_bytes).select(F.lit(name).alias("table"), "shard_id")
             for name, t in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table", "shard_id").agg(F.count(F.lit(1)).alias("oversized"))


def drop_oversize(t: DataFrame, max_bytes: int = 2500) -> DataFrame:
    """PF-3 execute: the table without oversized URLs."""
    return t.filter(F.octet_length("url") <= max_bytes)


def owned_rows(tables: Mapping[str, DataFrame], state: DataFrame, domains: DataFrame) -> DataFrame:
    """AG-13 / RJ-13: rows per (``table``, ``domain_id``) of the given domains, the dry run of a
    move. Rows of a table without ``domain_id`` belong to the domain of the URL's state row in
    their shard; a row counts once, however many state rows there are."""
    d = domains.select("domain_id").where("domain_id IS NOT NULL").distinct()
    owners = state.join(d, "domain_id", "left_semi").select("url", "shard_id", "domain_id").distinct()
    parts = []
    for name, t in tables.items():
        if "domain_id" in t.columns:
            rows = t.join(d, "domain_id", "left_semi").groupBy("domain_id").agg(F.count(F.lit(1)).alias("rows"))
        else:   # counted by URL before the join
            rows = (t.groupBy("url", "shard_id").agg(F.count(F.lit(1)).alias("n")).join(owners, ["url", "shard_id"])
                    .groupBy("domain_id").agg(F.sum("n").alias("rows")))
        parts.append(rows.select(F.lit(name).alias("table"), "domain_id", "rows"))
    return reduce(DataFrame.unionByName, parts)
