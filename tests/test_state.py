"""Invariants of the keyed jobs: cutting a stream into batches changes nothing, replays
repeat themselves, counters agree with history, and moves can be undone."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from frontier import schema as SC
from frontier.functions import urls as U
from frontier.operators import ingest as IG
from frontier.operators import migrate as MG
from frontier.operators import running as RUN
from frontier.operators import score as SCR
from frontier.operators import select as SL
from frontier.session import ensure_checkpoint_dir
from frontier.sources import buckets, store
from frontier.streaming import jobs as JB
from frontier.streaming import logs as LG

AS_OF = "2024-02-01 00:00:00"
REASONS = ["HttpError 503", "TimeoutError", "DNSLookupError", "IgnoreRequest Forbidden by robots.txt"]


def _records(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        ok = rng.random() < 0.4
        d = rng.randint(1, 6)
        rows.append((k, f"https://h{d}.ex.com/{rng.randint(0, 12)}", d, d % 3, "ok" if ok else "fail", None if ok else rng.choice(REASONS),
                     datetime(2024, 1, 1) + timedelta(minutes=k), rng.choice("abc") if ok else None, f"t{rng.randint(0, 3)}" if ok else None))
    return rows


SCHEMA = "seq long, url string, domain_id long, shard_id int, status string, fail_reason string, fetched_at timestamp, content_hash string, title string"


def _domains(spark):
    rows = [(d, f"h{d}.ex.com", d % 3, 0.0, datetime(2024, 2, 2) if d == 2 else datetime(2024, 1, 2) if d == 3 else None, d % 3) for d in range(1, 7)]
    return spark.createDataFrame(rows, SC.DOMAIN_STATE)


def _image(df, *keys):
    return sorted(map(str, df.select(sorted(df.columns)).collect())) if not keys else sorted(str(r) for r in df.select(*keys).collect())


def test_batches_cut_anywhere_give_the_same(spark):
    rows = _records(160, 5)
    empty = [SC.empty(spark, SC.URL_STATE), SC.empty(spark, SC.URL_EVENT_COUNTER)]
    whole = IG.ingest_batch(*empty, _domains(spark), spark.createDataFrame(rows, SCHEMA), AS_OF)
    state, counters, domains, history = *empty, _domains(spark), 0
    for part in (rows[:37], rows[37:38], rows[38:]):
        out = IG.ingest_batch(state, counters, domains, spark.createDataFrame(part, SCHEMA), AS_OF)
        state, counters, domains = (spark.createDataFrame(x.collect(), x.schema) for x in (out.state, out.counters, out.domain_state))
        history += out.history.count()
    assert _image(state) == _image(whole.state) and _image(counters) == _image(whole.counters) and _image(domains) == _image(whole.domain_state)
    assert history == whole.history.count() == len(rows)
    sums = counters.agg(F.sum("num_fetch_ok"), F.sum("num_fetch_fail")).first()
    assert tuple(sums) == (sum(r[4] == "ok" for r in rows), sum(r[4] == "fail" for r in rows))


def test_domain_pause_follows_the_records(spark):
    """ok, fail, fail: the domain ends paused with one fail, however the batch is cut."""
    rows = [(0, "u1", 1, 1, "ok", None, datetime(2024, 1, 1), "a", None), (1, "u2", 1, 1, "fail", "TimeoutError", datetime(2024, 1, 1), None, None),
            (2, "u2", 1, 1, "fail", "TimeoutError", datetime(2024, 1, 1), None, None)]
    folded = IG.fold_results(SC.empty(spark, SC.URL_STATE), spark.createDataFrame(rows, SCHEMA), AS_OF)
    out = IG.domain_pause(_domains(spark), folded, AS_OF).collect()
    assert [(r.domain_id, r.domain_fail_count, r.crawl_paused_until) for r in out] == [(1, 1, datetime(2024, 2, 1, 1))]


def test_replayed_micro_batch_repeats_itself(spark, tmp_path):
    root = str(tmp_path / "tables")
    store.write_version(SC.conform(_domains(spark), SC.DOMAIN_STATE), f"{root}/domain_state", 0, order="domain_id")
    files = spark.createDataFrame(_records(60, 9), SCHEMA).withColumn("fetched_at", F.col("fetched_at").cast("string")).drop("seq")
    files.coalesce(2).write.json(str(tmp_path / "src"))
    batch = buckets.read_records(spark, str(tmp_path / "src"), JB.ROUTED_RECORD)
    images = []
    for _ in range(2):
        as_of = JB.batch_time(spark, root, 0)
        JB.ingest_micro_batch(spark, root, batch, 0, as_of)
        images.append([as_of] + [_image(store.read_version(spark, f"{root}/{t}", 1, s, by)) for t, s, by in (
            ("url_state", SC.URL_STATE, ("shard_id",)), ("url_event_counter", SC.URL_EVENT_COUNTER, ("shard_id", "event_date")), ("domain_state", SC.DOMAIN_STATE, ("shard_id",)))])
    assert images[0] == images[1] and len(images[0][1]) > 0
    assert store.read_version(spark, f"{root}/url_state", 0, SC.URL_STATE).count() == 0


def test_micro_batch_of_links_and_results_leaves_nothing_behind(spark, tmp_path):
    """A URL that is linked and fetched, one only linked, one only fetched, one only stored; the steps of the batch are gone after it."""
    root, shared = str(tmp_path / "tables"), Path(ensure_checkpoint_dir(spark))
    old = spark.createDataFrame([(f"u{k}", 7, 1, k, "old" if k else None) for k in range(3)], "url string, domain_id long, shard_id int, inlink_count_approx int, anchor_text string")
    store.write_version(SC.conform(old, SC.URL_STATE, SC.URL_STATE_DEFAULTS), f"{root}/url_state", 0)
    store.write_version(SC.conform(_domains(spark), SC.DOMAIN_STATE), f"{root}/domain_state", 0, order="domain_id")
    link = {"status": "new", "domain_id": 7, "shard_id": 1, "inlink_count_approx": 1, "anchor_text": "a"}
    rows = [{"url": u, **link, "discovered_from": f"p{k}"} for k, u in enumerate(["u0", "u1", "u3", "u3", "u5"])]
    rows += [{"url": u, "status": s, "domain_id": 7, "shard_id": 1, "content_hash": h} for u, s, h in (("u1", "ok", "x"), ("u3", "ok", "y"), ("u4", "fail", None), ("u1", "ok", "z"))]
    for k, part in enumerate((rows[:3], rows[3:])):
        (tmp_path / "src" / "20240101" / "0010").mkdir(parents=True, exist_ok=True)
        (tmp_path / "src" / "20240101" / "0010" / f"{k}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in part))
    before = sorted(p.name for p in shared.iterdir())
    JB.ingest_micro_batch(spark, root, buckets.read_records(spark, str(tmp_path / "src"), JB.ROUTED_RECORD), 0, AS_OF)
    assert sorted(p.name for p in shared.iterdir()) == before
    got = store.read_version(spark, f"{root}/url_state", 1, SC.URL_STATE).orderBy("url").collect()
    assert [(r.url, r.inlink_count_approx, r.num_fetch_ok_90d, r.num_fetch_fail_90d, r.num_content_update_90d, r.content_hash, r.anchor_text, r.discovered_from) for r in got] == [
        ("u0", 1, 0, 0, 0, None, "a", None), ("u1", 2, 2, 0, 2, "z", "old", None), ("u2", 2, 0, 0, 0, None, "old", None), ("u3", 2, 1, 0, 1, "y", "a", "p2"),
        ("u4", 0, 0, 1, 0, None, None, None), ("u5", 1, 0, 0, 0, None, "a", "p4")]
    assert sorted(r.url for r in spark.read.parquet(f"{root}/url_state_history").collect()) == ["u1", "u1", "u3", "u3", "u4", "u5"]


def test_only_touched_shards_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = SC.conform(spark.createDataFrame([(f"u{k}", k % 4) for k in range(20)], "url string, shard_id int"), SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    store.write_version(rows, root, 0)
    one = store.read_version(spark, root, 0, SC.URL_STATE, only=[2]).withColumn("title", F.lit("new"))
    store.write_version(one, root, 1)
    assert sorted(p.parent.name for p in (tmp_path / "t").glob("shard_id=*/v=1")) == ["shard_id=2"]
    now = store.read_version(spark, root, 1, SC.URL_STATE)
    assert now.count() == 20 and now.where("title = 'new'").count() == 5
    assert store.read_version(spark, root, 0, SC.URL_STATE).where("title = 'new'").count() == 0


def test_files_of_every_form(spark, tmp_path):
    (tmp_path / "20240101" / "0010").mkdir(parents=True)
    d = tmp_path / "20240101" / "0010"
    (d / "a.json").write_text('{\n "url": "u1",\n "shard_id": 1\n}')
    (d / "b.json").write_text('[{"url": "u2"}, {"url": "u3"}]')
    (d / "c.jsonl").write_text('{"url": "u4"}\nnot json\n\n{"url": "u5"}\n')
    (d / "d.json").write_text('{"url": "u6"}\n{"url": "u7"}\n')
    (d / "e.txt").write_text('{"url": "no"}')
    rows = buckets.read_records(spark, str(tmp_path), SC.ROUTED_RESULT).collect()
    assert sorted(r.url for r in rows if r.url) == ["u1", "u2", "u3", "u4", "u5", "u6", "u7"]
    assert [r.bad for r in rows if r.bad] == ["not json"] and {(r.bucket_date, r.bucket_time) for r in rows} == {("20240101", "0010")}
    ordered = sorted(rows, key=lambda r: r.seq)
    assert [r.url for r in ordered] == ["u1", "u2", "u3", "u4", None, "u5", "u6", "u7"]


def test_one_file_of_lines_is_many_tasks(spark, tmp_path):
    (tmp_path / "20240101" / "0010").mkdir(parents=True)
    (tmp_path / "20240101" / "0010" / "a.jsonl").write_text("".join(f'{{"url": "u{k}"}}' + ("\r\n" if k % 3 else "\n\n") for k in range(4000)))
    (tmp_path / "20240101" / "0010" / "b.jsonl").write_text('{"url": "last"}')
    (tmp_path / "20240101" / "0020").mkdir()
    (tmp_path / "20240101" / "0020" / "c.jsonl").write_text('{"url": "not yet"}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = buckets.read_buckets(spark, str(tmp_path), SC.ROUTED_RESULT, "2024-01-01 00:35:00", 10)
        assert rows.select(F.spark_partition_id()).distinct().count() > 3
        ordered = rows.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.url for r in ordered] == [f"u{k}" for k in range(4000)] + ["last"] and not any(r.bad for r in ordered)
    assert len({r.seq for r in ordered}) == len(ordered)


def test_outcomes_are_those_of_the_fold(spark):
    records, state = spark.createDataFrame(_records(160, 5), SCHEMA), SC.empty(spark, SC.URL_STATE)
    old = IG.final_images(IG.fold_results(state, records.where("seq % 2 = 0"), AS_OF))
    folded, outcomes = IG.fold_results(old, records, AS_OF), IG.record_outcomes(old, records, AS_OF)
    assert set(outcomes.columns) < set(folded.columns)
    assert _image(outcomes) == _image(folded.select(*outcomes.columns))


def test_delta_files_are_folded_ten_at_a_time(spark, tmp_path):
    """One version for each ten files; files that come later are folded into the same days."""
    (tmp_path / "deltas").mkdir()
    (tmp_path / "registry").mkdir()
    spark.createDataFrame([(1, 3)], "domain_id long, shard_id int").write.mode("overwrite").parquet(str(tmp_path / "registry"))

    def put(numbers):
        for k in numbers:
            doc = {"generated_at": f"2024-01-0{1 + k % 2}T00:00:00+00:00", "source": "x", "counters": {"num_fetch_ok": 1, "fail_reasons": {"r": k}},
                   "domains": {"1": {"num_fetch_ok": 1}}}
            (tmp_path / "deltas" / f"{k}.json").write_text(json.dumps(doc, indent=1))

    def run():
        query = JB.start_stats_fold(spark, str(tmp_path / "deltas"), str(tmp_path / "tables"), str(tmp_path / "ckpt"), str(tmp_path / "registry"), lambda: datetime(2024, 1, 3))
        query.awaitTermination()
        return query.lastProgress.batchId if query.lastProgress else None

    put(range(23))
    assert run() == 2
    put(range(23, 25))
    assert run() == 3
    for name, keys in (("summary_daily", ["event_date"]), ("domain_stats_daily", ["domain_id", "event_date"])):
        rows = store.read_version(spark, str(tmp_path / "tables" / name), 4, SC.SUMMARY_DAILY if len(keys) == 1 else SC.DOMAIN_STATS_DAILY, ("event_date",)).collect()
        assert {str(r.event_date): r.num_fetch_ok for r in rows} == {"2024-01-01": 13, "2024-01-02": 12}
        if len(keys) == 1:
            assert {str(r.event_date): r.fail_reasons["r"] for r in rows} == {"2024-01-01": sum(range(0, 25, 2)), "2024-01-02": sum(range(1, 25, 2))}


def test_claims_of_a_hot_shard(spark):
    rows = [(f"u{k:04}", 0 if k % 3 else k % 7, None if k % 11 == 0 else datetime(2024, 1, 1 + k % 9), k % 5 > 0, None) for k in range(3000)]
    state = spark.createDataFrame(rows, "url string, shard_id int, first_seen timestamp, should_crawl boolean, url_score_updated_at timestamp")
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    found = {(r.shard_id, r.url, r.claim_rank) for r in SL.claim_unscored(state, 1200).collect()}
    want = set()
    for shard in range(7):
        mine = sorted((r[2] is None, r[2] or datetime(1, 1, 1), r[0]) for r in rows if r[1] == shard and r[3])
        want |= {(shard, u, k + 1) for k, (_, _, u) in enumerate(mine[:1200])}
    assert found == want and spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000") == before


def test_split_then_unsplit_restores(spark):
    registry = SC.conform(spark.createDataFrame([(1, "a.com", 5), (2, "h.a.com", 9)], "domain_id long, domain string, shard_id int"), SC.DOMAIN_STATE, SC.DOMAIN_STATE_DEFAULTS)
    home = SC.conform(spark.createDataFrame([("u1", 1, 5), ("u2", 1, 5)], "url string, domain_id long, shard_id int"), SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    rules = U.SuffixRules(["com"])
    counters = SC.conform(spark.createDataFrame([("u1", 3, 5)], "url string, num_fetch_ok int, shard_id int").withColumn("event_date", F.lit("2024-01-01").cast("date")),
                          SC.URL_EVENT_COUNTER, SC.COUNTER_DEFAULTS)
    away = home.withColumn("domain_id", F.when(F.col("url") == "u1", 2).otherwise(1).cast("long")).withColumn("shard_id", F.when(F.col("url") == "u1", 9).otherwise(5))
    moved = counters.withColumn("shard_id", F.lit(9))
    whitelist = spark.createDataFrame([("other.a.com",)], "host string")
    plan = MG.plan_unsplit(registry, whitelist, overrides={"a.com": 5}, rules=rules)
    out = MG.migrate(MG.Tables(away, moved, registry), plan)
    assert _image(out.state) == _image(home) and _image(out.counters) == _image(counters)
    assert [(r.domain, r.domain_id, r.shard_id) for r in out.registry.collect()] == [("a.com", 1, 5)]
    report = {(r["table"], r.domain): r.rows for r in MG.report(MG.Tables(away, moved, registry), plan).collect()}
    assert report == {("url_state", "h.a.com"): 1, ("url_event_counter", "h.a.com"): 1}


def test_heads_carry_the_contract_names():
    heads = [SCR.LinearHead(n, [0.0] * 40) for n in ("url", "parent", "pathfinder", "refresh")]
    SCR.validate_heads(heads)


def test_quantiles_of_small_groups(spark):
    rows = [(datetime(2024, 1, 1), "request.end", 1, x) for x in (5, 1, 9)] + [(datetime(2024, 1, 1), "request.end", 2, 4)]
    df = spark.createDataFrame(rows, "ts timestamp, event string, worker_id int, latency_ms long")
    got = {r.worker_id: (r.p50, round(r.p95, 6), round(r.p99, 6)) for r in LG.latency_quantiles(df).collect()}
    assert got == {1: (5.0, 8.6, 8.92), 2: (4.0, 4.0, 4.0)}


def test_running_aggregates_of_a_hot_key(spark):
    """One key with half of the rows covers several blocks; results as in one pass."""
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 30)}", k, rng.randint(0, 5), rng.choice([None, "a", "b"])) for k in range(2000)]
    df = RUN.in_blocks(spark.createDataFrame(rows, "key string, seq long, n int, v string"), "key", "seq")
    assert df.where("key = 'hot'").select("__block").distinct().count() > 1
    got = RUN.run(df, "key", "seq", [RUN.Running("total", "sum", F.col("n")), RUN.Running("last", "last", F.col("v")), RUN.Running("prev", "last", F.col("v"), before=True),
                                     RUN.Running("first", "first", F.col("v"))]).collect()
    seen, last_of = {}, {}
    for key, seq, _, _ in rows:
        last_of[key] = seq
    want = {}
    for key, seq, n, v in rows:
        place, total, last, first = seen.get(key, (0, 0, None, v))
        want[seq] = (place + 1, total + n, v or last, last, first, last_of[key] == seq)
        seen[key] = (place + 1, total + n, v or last, first)
    assert {r.seq: (r["__rn"], r.total, r["last"], r.prev, r.first, r["__final"]) for r in got} == want
