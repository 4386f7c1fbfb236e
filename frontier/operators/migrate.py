"""Moving domains between keys and shards.

A job is a table of moves (one row per domain that moves) and one call of
:func:`migrate`, which carries every table along:

* :func:`plan_unsplit` - subdomains that were split out return to their parent;
* :func:`plan_reshard` - domains with a configured shard move to it;
* :func:`plan_merge` - registry rows that are subdomains join their registrable domain.

Only rows of moving domains, and the rows that they collide with, are joined and
aggregated; all others pass by an anti join on the (few) moving domain ids or keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..session import cut_lineage
from .rekey import is_dns_host, under_parents
from .routing import resolve_domains

COUNTERS = ("num_scheduled", "num_fetch_ok", "num_fetch_fail", "num_content_update")


@dataclass
class Tables:
    """The keyed tables that follow a domain; absent ones stay absent."""

    state: DataFrame
    counters: DataFrame
    registry: DataFrame
    history: DataFrame | None = None
    features: DataFrame | None = None
    domain_stats: DataFrame | None = None


@dataclass
class Moves:
    """``moves``: domain_id, domain, old_shard, new_domain_id, new_shard; ``registry``: the
    registry after the job (targets present, sources gone or on their new shard)."""

    moves: DataFrame
    registry: DataFrame


def _without(registry: DataFrame, gone: DataFrame) -> DataFrame:
    return registry.join(gone.select("domain_id"), "domain_id", "left_anti")


def _into(registry: DataFrame, sources: DataFrame, num_shards: int, overrides: Mapping[str, int] | None, overwrite: bool) -> Moves:
    """Moves of ``sources`` (domain_id, domain, shard_id, target): the target domain is
    created where it is missing; ``overwrite`` also sets its shard where it is known."""
    keys = sources.select(F.col("target").alias("domain")).distinct().withColumn("shard_id", U.shard_id(F.col("domain"), num_shards, overrides))
    new_registry, resolved = resolve_domains(registry, keys, overwrite_shard=overwrite)
    # rows go to the shard of the key, whatever shard a known target is registered on
    to = resolved.select(F.col("domain").alias("target"), F.col("domain_id").alias("new_domain_id")).join(
        keys.select(F.col("domain").alias("target"), F.col("shard_id").alias("new_shard")), "target")
    # written once: one row per moving domain, read by every table's step
    moves = cut_lineage(sources.join(to, "target").select("domain_id", "domain", F.col("shard_id").alias("old_shard"), "new_domain_id", "new_shard"))
    return Moves(moves, cut_lineage(_without(new_registry, moves)))


def plan_unsplit(registry: DataFrame, whitelist: DataFrame, num_shards: int = 256, overrides: Mapping[str, int] | None = None, *,
                 rules: U.SuffixRules | None) -> Moves:
    """RK-3: the parents are the registrable domains of the split whitelist (``host``); every
    registry subdomain of a parent that isn't (or is no longer) on the list moves to it."""
    hosts = whitelist.select("host").distinct()
    parents = hosts.select(U.registrable_domain(F.col("host"), rules).alias("parent")).where("parent IS NOT NULL").distinct()
    below = under_parents(registry.select("domain_id", "domain", "shard_id"), "domain", parents).where("domain <> parent")
    victims = below.join(hosts, below["domain"] == hosts["host"], "left_anti").withColumnRenamed("parent", "target")
    # parents without a victim are made sure of as well
    keys = parents.select(F.col("parent").alias("domain")).withColumn("shard_id", U.shard_id(F.col("domain"), num_shards, overrides))
    known, _ = resolve_domains(registry, keys, overwrite_shard=True)
    known, victims = cut_lineage(known), cut_lineage(victims)
    return _into(known, victims, num_shards, overrides, overwrite=True)


def plan_reshard(registry: DataFrame, overrides: Mapping[str, int], num_shards: int = 256) -> Moves:
    """RK-4: registry domains with a configured shard other than their own."""
    rows = registry.where(F.col("domain").isin(sorted(overrides)))
    rows = rows.withColumn("new_shard", U.shard_id(F.col("domain"), num_shards, overrides)).where("new_shard <> shard_id")
    moves = cut_lineage(rows.select("domain_id", "domain", F.col("shard_id").alias("old_shard"), F.col("domain_id").alias("new_domain_id"), "new_shard"))
    to = moves.select("domain_id", F.col("new_shard").alias("__s"))
    registry = registry.join(to, "domain_id", "left").withColumn("shard_id", F.coalesce("__s", "shard_id")).drop("__s")
    return Moves(moves, registry)


def plan_merge(registry: DataFrame, num_shards: int = 256, overrides: Mapping[str, int] | None = None, domain_like: str | None = None, *,
               rules: U.SuffixRules | None) -> Moves:
    """RK-5: registry rows that are subdomains (``domain_like`` narrows them by a LIKE
    pattern) join their registrable domain; anchor text and hosts without one stay."""
    rows = registry if domain_like is None else registry.where(F.col("domain").like(domain_like))
    rows = rows.where(is_dns_host(F.col("domain"))).withColumn("target", U.registrable_domain(F.col("domain"), rules))
    dirty = rows.where("target IS NOT NULL AND target <> domain").select("domain_id", "domain", "shard_id", "target")
    return _into(registry, dirty, num_shards, overrides, overwrite=False)


def _first(c: str) -> Column:
    """The value of the row that was there first, null or not."""
    return F.min(F.struct("__rank", F.col(c).alias("v")))["v"].alias(c)


def _first_set(c: str) -> Column:
    return F.min(F.when(F.col(c).isNotNull(), F.struct("__rank", F.col(c).alias("v"))))["v"].alias(c)


def _state_rules(c: str) -> Column:
    """UM-14: what becomes of a column where a moved row meets one of the same URL."""
    if c in ("source", "discovery_source_type"):
        return F.max(c).alias(c)
    if c in ("inlink_count_approx", "inlink_count_external"):
        return F.sum(c).cast("int").alias(c)
    if c in ("discovered_from", "title", "hreflang_count", "has_json_ld", "last_modified", "etag", "cache_control", "is_redirect",
             "redirect_hop_count", "parent_page_score", "anchor_text"):
        return _first_set(c)
    if c == "robots_bits":
        last = F.max(F.when(F.col(c) != 0, F.struct("__rank", F.col(c).alias("v"))))["v"]
        return F.coalesce(last, F.min(F.struct("__rank", F.col(c).alias("v")))["v"]).alias(c)
    return _first(c)


def _moving(df: DataFrame, moves: DataFrame) -> DataFrame:
    """Rows of moving domains on their old shard, re-keyed; ``__rank`` is the source domain's name."""
    m = moves.select("domain_id", F.col("old_shard").alias("shard_id"), "new_domain_id", "new_shard", F.col("domain").alias("__rank"))
    return (df.join(m, ["domain_id", "shard_id"]).withColumn("domain_id", F.col("new_domain_id")).withColumn("shard_id", F.col("new_shard"))
            .drop("new_domain_id", "new_shard"))


def _staying(df: DataFrame, moves: DataFrame) -> DataFrame:
    return df.join(moves.select("domain_id", F.col("old_shard").alias("shard_id")), ["domain_id", "shard_id"], "left_anti")


def _collide(df: DataFrame, moves: DataFrame, keys: list[str], rule) -> DataFrame:
    """``df`` after the moves, where rows that meet on ``keys`` become one by ``rule``
    (column name to aggregate). The row that didn't move comes first, moved ones by the
    name of their domain."""
    columns = df.columns
    moved, stay = cut_lineage(_moving(df, moves)), _staying(df, moves)
    met = stay.join(moved.select(*keys).distinct(), keys, "left_semi").withColumn("__rank", F.lit(""))
    one = moved.unionByName(met).groupBy(*keys).agg(*[rule(c) for c in columns if c not in keys])
    return stay.join(moved.select(*keys).distinct(), keys, "left_anti").unionByName(one.select(*columns))


def migrate(tables: Tables, plan: Moves, merge_columns: bool = False) -> Tables:
    """Carry every table along the moves.

    * state: a moved URL that the target shard already has is dropped (its row stays as
      it is), or with ``merge_columns`` merged into it column by column (UM-14);
    * counters of the URLs that now belong to a target move from the old shard and add up
      per (url, day); a day counts as accounted if either side does;
    * history moves; content features: the newer fetch wins; daily stats add up, and a
      reason's count is that of the row that came last."""
    moves = plan.moves
    first = Window.partitionBy("url", "shard_id").orderBy("__rank")
    if merge_columns:
        state = _collide(tables.state, moves, ["url", "shard_id"], _state_rules)
    else:
        stay = _staying(tables.state, moves)
        moved = _moving(tables.state, moves).withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__rank")
        state = stay.unionByName(moved.join(stay.select("url", "shard_id"), ["url", "shard_id"], "left_anti").select(*stay.columns))
    # counters carry no domain: they follow the URLs that belong to a target now
    pairs = moves.select(F.col("new_domain_id").alias("domain_id"), F.col("new_shard").alias("shard_id"), F.col("old_shard")).distinct()
    # (staged, and so are their counters: what moves is small beside the tables, and is used several times)
    urls = cut_lineage(state.join(pairs, ["domain_id", "shard_id"]).select("url", F.col("shard_id").alias("__to"), F.col("old_shard").alias("shard_id")).where("__to <> shard_id"))
    going = tables.counters.join(urls, ["url", "shard_id"])
    rest = tables.counters.join(urls.select("url", "shard_id"), ["url", "shard_id"], "left_anti")
    arriving = cut_lineage(going.withColumn("shard_id", F.col("__to")).drop("__to"))
    key = ["url", "event_date", "shard_id"]
    met = rest.join(arriving.select(*key).distinct(), key, "left_semi")
    added = arriving.unionByName(met).groupBy(*key).agg(*[F.sum(c).cast("int").alias(c) for c in COUNTERS], F.bool_or("accounted").alias("accounted"))
    counters = rest.join(arriving.select(*key).distinct(), key, "left_anti").unionByName(added.select(*rest.columns))
    out = Tables(state, counters, plan.registry)
    if tables.history is not None:
        out.history = _staying(tables.history, moves).unionByName(_moving(tables.history, moves).drop("__rank"))
    if tables.features is not None:
        out.features = _merge_features(tables.features, moves)
    if tables.domain_stats is not None:
        out.domain_stats = _merge_stats(tables.domain_stats, moves)
    return out


def _merge_features(features: DataFrame, moves: DataFrame) -> DataFrame:
    """The first row stays unless a moved one was fetched later (a row without a time never wins
    over another, nor loses to one)."""
    columns = features.columns
    moved, stay = _moving(features, moves), _staying(features, moves)
    keys = ["url", "shard_id"]
    met = stay.join(moved.select(*keys).distinct(), keys, "left_semi").withColumn("__rank", F.lit(""))
    rest = [c for c in columns if c not in keys]
    rows = moved.unionByName(met).withColumn("__row", F.struct(*rest))
    newest = F.min(F.when(F.col("fetched_at").isNotNull(), F.struct((-F.unix_micros("fetched_at")).alias("t"), "__rank", "__row")))
    one = rows.groupBy(*keys).agg(F.min(F.struct("__rank", "fetched_at", "__row")).alias("old"), newest.alias("new"))
    later = F.col("new.__row.fetched_at") > F.col("old.fetched_at")
    one = one.withColumn("__pick", F.when(later, F.col("new.__row")).otherwise(F.col("old.__row")))
    return stay.join(moved.select(*keys).distinct(), keys, "left_anti").unionByName(one.select(*keys, *[F.col(f"__pick.{c}").alias(c) for c in rest]).select(*columns))


def _merge_stats(stats: DataFrame, moves: DataFrame) -> DataFrame:
    m = moves.select("domain_id", "new_domain_id", "new_shard", F.col("domain").alias("__rank"))
    moved = (stats.join(m, "domain_id").withColumn("domain_id", F.col("new_domain_id")).withColumn("shard_id", F.col("new_shard"))
             .drop("new_domain_id", "new_shard"))
    stay = stats.join(moves.select("domain_id"), "domain_id", "left_anti")
    keys = ["domain_id", "event_date"]
    met = stay.join(moved.select(*keys).distinct(), keys, "left_semi").withColumn("__rank", F.lit(""))
    rows = moved.unionByName(met)
    reasons = (rows.select(*keys, "__rank", F.explode("fail_reasons").alias("reason", "n")).groupBy(*keys, "reason")
               .agg(F.max_by("n", "__rank").alias("n")).groupBy(*keys)
               .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("fail_reasons")))
    one = rows.groupBy(*keys).agg(_first("shard_id"), *[F.sum(c).cast("long").alias(c) for c in COUNTERS]).join(reasons, keys, "left")
    return stay.join(moved.select(*keys).distinct(), keys, "left_anti").unionByName(one.select(*stats.columns))


def report(tables: Tables, plan: Moves) -> DataFrame:
    """RK-7 / AG-13 (dry run): rows per table of every domain that would move."""
    moves = plan.moves
    own = moves.select("domain_id", "domain", F.col("old_shard").alias("shard_id"))
    current = tables.state.join(own, ["domain_id", "shard_id"])
    parts = [("url_state", current), ("url_event_counter", tables.counters.join(current.select("url", "shard_id", "domain"), ["url", "shard_id"]))]
    if tables.history is not None:
        parts.append(("url_state_history", tables.history.join(own, ["domain_id", "shard_id"])))
    if tables.features is not None:
        parts.append(("content_feature", tables.features.join(own, ["domain_id", "shard_id"])))
    if tables.domain_stats is not None:
        parts.append(("domain_stats_daily", tables.domain_stats.join(own.drop("shard_id"), "domain_id")))
    out = None
    for name, rows in parts:
        one = rows.groupBy("domain").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "domain", "rows")
        out = one if out is None else out.unionByName(one)
    return out

