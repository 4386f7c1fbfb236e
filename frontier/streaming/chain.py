"""ST-1: the whole ingest chain as one stream.

A micro-batch is an admitted bucket of crawl records. It is routed (registry get-or-create,
shards, link records), ingested (URL state, history, counters, domain back-off), its content
features are upserted, and its metrics go into the daily tables. Tables by URL take the batch's
changes only (:mod:`..sources.keyed`) and are compacted after some batches; every table is
written under the batch's version; the commit, one small document, comes last and names that version. Readers
take the tables at the committed version, so they never see half of a batch, and a batch that
is run again after a crash reads what it read before and replaces what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as SC
from ..functions import urls as U
from ..operators import golden as GD
from ..operators import ingest as IG
from ..operators import pages as PX
from ..operators import routing as RT
from ..operators import stats as STS
from ..session import cut_lineage
from ..sources import admission, buckets, files, store
from ..sources.keyed import Keyed
from .jobs import MAX_SHARDS, ROUTED_RECORD, batch_time

#: Tables by URL: schema and key.
KEYED = {
    "url_state": (SC.URL_STATE, ("url",)),
    "url_event_counter": (SC.URL_EVENT_COUNTER, ("url", "event_date")),
    "content_feature": (SC.CONTENT_FEATURE, ("url",)),
}
#: Tables by domain or day: schema and partition columns.
TABLES = {
    "domain_state": (SC.DOMAIN_STATE, ("shard_id",)),
    "domain_stats_daily": (SC.DOMAIN_STATS_DAILY, ("shard_id", "event_date")),
    "summary_daily": (SC.SUMMARY_DAILY, ("event_date",)),
}
#: Tables that a batch only adds to, a folder a batch.
APPENDED = ("url_state_history", "content_feature_history")
#: Batches whose deltas are kept before they are folded into the base.
COMPACT_EVERY = 16


def keyed(root: str, name: str) -> Keyed:
    return Keyed(f"{root.rstrip('/')}/{name}", *KEYED[name])


def committed_version(spark: SparkSession, root: str) -> int:
    """The version that readers take: that of the last whole batch, 0 before the first."""
    done = [int(n.removesuffix(".json")) for n, _ in files.names(spark, f"{root.rstrip('/')}/_commits") if n.endswith(".json") and not n.startswith("_")]
    return max(done, default=0)


def read_table(spark: SparkSession, root: str, name: str, version: int | None = None, only: list | None = None) -> DataFrame:
    """A table as of a committed version (the last one by default)."""
    version = committed_version(spark, root) if version is None else version
    if name in KEYED:
        return keyed(root, name).read(spark, version)
    schema, by = TABLES[name]
    return store.read_version(spark, f"{root.rstrip('/')}/{name}", version, schema, by, only)


def read_appended(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of all whole batches of a table that batches only add to."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}").where(F.col("batch") < committed_version(spark, root)).drop("batch")


def routed_batch(records: DataFrame, registry: DataFrame, num_shards: int, overrides: Mapping[str, int] | None, whitelist: DataFrame | None,
                 rules: U.SuffixRules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, all routed records, registry): results and link records in one schema, in one order."""
    routed, links, new_registry = RT.route_results(records, registry, ["seq"], whitelist, num_shards, overrides, rules=rules, ordered=True)
    place = lambda pos: F.struct("seq.source_file", "seq.block", "seq.line", "seq.place", pos.alias("pos"))
    routed = cut_lineage(routed.withColumn("seq", place(F.lit(-1))))
    links = links.withColumn("seq", place(F.col("pos"))).drop("pos")
    return routed, _with_order(routed).unionByName(_with_order(links)), new_registry


def _with_order(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in ROUTED_RECORD.fields], "seq")


def _features(results: DataFrame) -> DataFrame:
    rows = PX.basic_features(results, "seq")
    return rows.withColumn("fetched_at", IG.parse_optional_ts(F.col("fetched_at")))


def daily_rows(out: IG.IngestOutput, registry: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """AG-4 -> AG-5 / AG-6: a batch's metrics as rows of ``summary_daily`` and ``domain_stats_daily``."""
    total, per_domain, reasons = IG.batch_metrics(out.folded, out.link_results)
    date = F.lit(day).cast("date")
    as_map = F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("fail_reasons")
    summary = total.crossJoin(IG.global_reasons(reasons).agg(as_map)).withColumn("event_date", date)  # two one-row aggregates
    domains = (per_domain.where("domain_id IS NOT NULL").join(reasons.groupBy("domain_id").agg(as_map), "domain_id", "left")
               .join(registry.select("domain_id", "shard_id"), "domain_id").withColumn("event_date", date))
    return SC.conform(summary, SC.SUMMARY_DAILY), SC.conform(domains, SC.DOMAIN_STATS_DAILY)


def chain_micro_batch(spark: SparkSession, table_root: str, bucket: str, paths: list[str], batch_id: int, as_of: str, *, rules: U.SuffixRules,
                      num_shards: int = 256, overrides: Mapping[str, int] | None = None, whitelist: DataFrame | None = None) -> None:
    """One bucket through the chain: tables at version ``batch_id`` in, version ``batch_id + 1`` out, then the commit."""
    root, version, day = table_root.rstrip("/"), batch_id + 1, as_of[:10]
    if committed_version(spark, root) >= version:
        return   # run again after its commit
    found = cut_lineage(buckets.records_of(spark, paths, SC.CRAWL_RESULT)) if paths else None
    if found is not None:
        unusable = F.col("bad").isNotNull() | F.col("url").isNull()
        (found.where(unusable).select("source_file", F.coalesce("bad", F.to_json(F.struct("status", "fetched_at"))).alias("record"))
         .write.mode("overwrite").json(f"{root}/bad_records/batch={batch_id}"))
        records = found.where(~unusable).drop("source_file", "bad")
        registry = read_table(spark, root, "domain_state", batch_id)
        results, batch, registry = routed_batch(records, registry, num_shards, overrides, whitelist, rules)
        batch, registry = cut_lineage(batch), cut_lineage(SC.conform(registry, SC.DOMAIN_STATE, SC.DOMAIN_STATE_DEFAULTS))
        # shards of the domains (an old domain may have another one than its key)
        homes = _bounded(registry.join(batch.select("domain_id").distinct(), "domain_id", "left_semi").select("shard_id"))
        today = F.col("event_date") == F.lit(day).cast("date")
        # of the tables by URL only the batch's own rows are read, so all that comes out is changed
        own = {name: keyed(root, name).read(spark, batch_id, batch) for name in KEYED}
        out = IG.ingest_batch(own["url_state"], own["url_event_counter"].where(today), registry.where(F.col("shard_id").isin(homes)), batch, as_of)
        features, seen = GD.upsert_features(own["content_feature"], _features(results))
        summary, domains = daily_rows(out, registry, day)
        old = {name: read_table(spark, root, name, batch_id, only).where(today) for name, only in (("summary_daily", None), ("domain_stats_daily", homes))}
        for name, df in (("url_state", out.state), ("url_event_counter", out.counters), ("content_feature", features)):
            keyed(root, name).write(df, version)
        made = {"domain_state": out.domain_state,
                "summary_daily": STS.merge_daily(old["summary_daily"], summary, ["event_date"], STS.SUMMARY_FIELDS),
                "domain_stats_daily": STS.merge_daily(old["domain_stats_daily"], domains, ["domain_id", "event_date"], STS.DOMAIN_FIELDS)}
        for name, df in made.items():
            store.write_version(df, f"{root}/{name}", version, TABLES[name][1], "domain_id")
        for name, df in zip(APPENDED, (out.history, SC.conform(seen, SC.CONTENT_FEATURE)), strict=True):
            df.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
    files.put_json(spark, f"{root}/_commits/{version}.json", {"version": version, "bucket": bucket, "as_of": as_of})
    if version % COMPACT_EVERY == 0:
        for name in KEYED:
            keyed(root, name).compact(spark, version)


def _bounded(ids: DataFrame) -> list:
    found = [r[0] for r in ids.distinct().limit(MAX_SHARDS + 1).collect()]
    if len(found) > MAX_SHARDS:
        raise ValueError(f"a micro-batch names more than {MAX_SHARDS} shards")
    return [x for x in found if x is not None]


def start_chain(spark: SparkSession, source_root: str, table_root: str, checkpoint: str, *, rules: U.SuffixRules,
                clock: Callable[[], datetime] | None = None, interval_minutes: int = 10, admitted_at: datetime | None = None, **routing):
    """ST-1 / ST-2: admits the buckets under ``source_root`` that are ready (at ``admitted_at``,
    now by default) and runs the chain over all admissions that it hasn't run over."""
    root = table_root.rstrip("/")
    admission.admit(spark, source_root, f"{root}/_admissions", admitted_at or datetime.now(timezone.utc), interval_minutes)

    def fold(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        for r in batch.collect():   # one admission: names of files
            chain_micro_batch(own, root, r.bucket, list(r.files), batch_id, batch_time(own, root, batch_id, clock), rules=rules, **routing)

    return (admission.stream_admissions(spark, f"{root}/_admissions").writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
