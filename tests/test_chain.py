"""The streaming chain: bucket admission, commits, replays, late rows as data."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from frontier import schema as SC
from frontier.functions import urls as U
from frontier.sources import admission, keyed
from frontier.streaming import chain as CH
from frontier.streaming import logs as LG
from frontier.streaming import windows as WN

RULES = U.SuffixRules(["com", "org"])


def bucket(root, mark, name, records):
    folder = root / mark[:8] / mark[8:]
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def page(url, links=(), status="ok", reason=None, content="x"):
    return {"url": url, "domain": None, "fetched_at": "2024-01-01T00:00:00Z", "status": status, "fail_reason": reason, "content": content if status == "ok" else None,
            "outlinks": [{"url": u, "domain": None, "anchor": a} for u, a in links]}


def run(spark, tmp_path, at, name="t"):
    return CH.start_chain(spark, str(tmp_path / "src"), str(tmp_path / name), str(tmp_path / f"{name}-ckpt"), rules=RULES,
                          clock=lambda: datetime(2024, 2, 1), admitted_at=at)


def image(spark, tmp_path, name="t"):
    root = str(tmp_path / name)
    out = {t: sorted(map(str, CH.read_table(spark, root, t).select(*schema.fieldNames()).collect())) for t, (schema, _) in (CH.TABLES | CH.KEYED).items()}
    return out | {t: sorted(map(str, CH.read_appended(spark, root, t).collect())) for t in CH.APPENDED}


# admission

def test_buckets_are_admitted_in_order_and_when_ready(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "adm")
    for mark in ("202401010000", "202401010010", "202401010030"):
        bucket(src, mark, "a.jsonl", [page("http://a.com/")])
    (src / "notes").mkdir()
    (src / "20241399" / "0000").mkdir(parents=True)   # no such day
    at = lambda *m: datetime(2024, 1, 1, *m, tzinfo=timezone.utc)
    assert admission.admit(spark, str(src), out, at(0, 19)) == []
    assert admission.admit(spark, str(src), out, at(0, 20)) == ["202401010000"]
    bucket(src, "202401010000", "late.jsonl", [page("http://b.com/")])   # into an admitted bucket
    bucket(src, "202401010020", "a.jsonl", [page("http://c.com/")])
    # the third is ready only with the one before it
    assert admission.admit(spark, str(src), out, at(0, 39)) == ["202401010010"]
    assert admission.admit(spark, str(src), out, at(0, 50)) == ["202401010020", "202401010030"]
    bucket(src, "202401010005", "a.jsonl", [page("http://d.com/")])       # behind the mark
    assert admission.admit(spark, str(src), out, at(5, 0)) == []
    assert [(m, [f.rsplit("/", 1)[1] for f in fs]) for m, fs in admission.overtaken(spark, str(src), out)] == [
        ("202401010000", ["late.jsonl"]), ("202401010005", ["a.jsonl"])]
    assert admission.admitted(spark, out) == ["202401010000", "202401010010", "202401010020", "202401010030"]


def test_files_of_an_unready_bucket_stay_unread(spark, tmp_path):
    src = tmp_path / "src"
    bucket(src, "202401010000", "a.jsonl", [page("http://a.com/1")])
    bucket(src, "202401010010", "a.jsonl", [page("http://a.com/2")])
    urls = lambda: {r.url for r in CH.read_table(spark, str(tmp_path / "t"), "url_state").collect()}
    for _ in range(2):   # more triggers don't change that
        run(spark, tmp_path, datetime(2024, 1, 1, 0, 25)).awaitTermination()
        assert urls() == {"http://a.com/1"}
    run(spark, tmp_path, datetime(2024, 1, 1, 0, 30)).awaitTermination()
    assert urls() == {"http://a.com/1", "http://a.com/2"}


# the chain

def test_chain_follows_records(spark, tmp_path):
    src = tmp_path / "src"
    bucket(src, "202401010000", "a.jsonl", [
        page("http://www.a.com/1", [("http://b.org/x", "first"), ("http://a.com/1", "self"), ("", "none")]), page("http://b.org/y", status="fail", reason="HttpError 404"), {"status": "ok"}])
    (src / "20240101" / "0000" / "b.jsonl").write_text("not json\n")
    bucket(src, "202401010010", "a.jsonl", [page("http://b.org/x", content="longer", links=[("http://c.com/", "c")]), page("http://b.org/y", [("http://b.org/x", "again")]),
                                            page("http://b.org/y", content="yy")])
    run(spark, tmp_path, datetime(2024, 1, 1, 1)).awaitTermination()
    root = str(tmp_path / "t")
    assert CH.committed_version(spark, root) == 2
    state = {r.url: r for r in CH.read_table(spark, root, "url_state").collect()}
    assert set(state) == {"http://www.a.com/1", "http://a.com/1", "http://b.org/x", "http://b.org/y", "http://c.com/"}
    x, y = state["http://b.org/x"], state["http://b.org/y"]
    assert (x.inlink_count_approx, x.inlink_count_external, x.anchor_text, x.discovered_from, x.num_fetch_ok_90d) == (2, 1, "first", "http://www.a.com/1", 1)
    assert (y.num_fetch_ok_90d, y.num_fetch_fail_90d, y.num_content_update_90d) == (2, 1, 2)
    features = {r.url: (r.content_length, r.num_links) for r in CH.read_table(spark, root, "content_feature").collect()}
    assert features == {"http://www.a.com/1": (1, 2), "http://b.org/x": (6, 1), "http://b.org/y": (2, 0)}
    domains = {r.domain: r for r in CH.read_table(spark, root, "domain_state").collect()}
    assert set(domains) == {"a.com", "b.org", "c.com"} and sorted(d.domain_id for d in domains.values()) == [1, 2, 3] and domains["c.com"].domain_id == 3
    daily = {r.domain_id: (r.num_fetch_ok, r.num_fetch_fail, r.fail_reasons) for r in CH.read_table(spark, root, "domain_stats_daily").collect()}
    assert daily == {domains["a.com"].domain_id: (1, 0, {}), domains["b.org"].domain_id: (3, 1, {"HttpError 404": 1})}
    (day,) = CH.read_table(spark, root, "summary_daily").collect()
    assert (day.new_links, day.num_fetch_ok, day.num_fetch_fail, day.fail_reasons) == (5, 4, 1, {"HttpError 404": 1})
    assert CH.read_appended(spark, root, "content_feature_history").count() == 4
    assert sorted(r.record for r in spark.read.json(f"{root}/bad_records").collect())[-1] == "{\"status\":\"ok\"}"


@pytest.mark.parametrize("crash_at", [2, 7])
def test_a_crash_between_two_writes_leaves_the_last_commit(spark, tmp_path, monkeypatch, crash_at):
    src = tmp_path / "src"
    rng = random.Random(crash_at)
    for k, mark in enumerate(("202401010000", "202401010010")):
        bucket(src, mark, "a.jsonl", [page(f"http://h{rng.randint(0, 9)}.com/{rng.randint(0, 5)}", [(f"http://h{rng.randint(0, 30)}.org/", f"t{i}")],
                                           *(("fail", "HttpError 503") if rng.random() < 0.3 else ()), content=f"c{rng.randint(0, 3)}") for i in range(40)])
    run(spark, tmp_path, datetime(2024, 1, 1, 1), "whole").awaitTermination()
    run(spark, tmp_path, datetime(2024, 1, 1, 0, 25)).awaitTermination()
    before, plain, count = image(spark, tmp_path), CH.Keyed.write, [0]

    def failing(*args, **kwargs):
        count[0] += 1
        if count[0] == crash_at:
            raise OSError("lost")
        return plain(*args, **kwargs)

    if crash_at <= len(CH.KEYED):
        monkeypatch.setattr(CH.Keyed, "write", failing)
    else:
        def unfinished(session, path, *args):
            if "/_commits/" in path:
                raise OSError("lost")
            return put(session, path, *args)

        put = CH.files.put_json
        monkeypatch.setattr(CH.files, "put_json", unfinished)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, datetime(2024, 1, 1, 1)).awaitTermination()
    assert image(spark, tmp_path) == before   # no half of the second batch
    monkeypatch.undo()
    run(spark, tmp_path, datetime(2024, 1, 1, 1)).awaitTermination()
    assert image(spark, tmp_path) == image(spark, tmp_path, "whole") != before


def test_writes_follow_the_batch(spark, tmp_path):
    """Small changes of a large table: bytes written and rows read follow the change; compaction keeps every version."""
    schema = SC.CONTENT_FEATURE
    table = keyed.Keyed(str(tmp_path / "t"), schema, ("url",), 8)
    rows = lambda ids, n: SC.conform(spark.createDataFrame([(f"http://h{i % 50}.com/{i}", i % 4, n) for i in ids], "url string, shard_id int, num_links int"), schema)
    size = lambda part: sum(f.stat().st_size for f in (tmp_path / "t" / part).rglob("*.parquet"))
    got = lambda v, keys=None: sorted((r.url, r.num_links) for r in table.read(spark, v, keys).collect())
    want = {}

    def put(version, ids):
        table.write(rows(ids, version), version)
        want[version] = (want.get(version - 1) or {}) | {f"http://h{i % 50}.com/{i}": version for i in ids}

    put(1, range(20000))
    table.compact(spark, 1)
    for v in range(2, 6):
        put(v, range(v * 3, v * 3 + 40))
        assert size(f"delta/v={v}") < size("delta/v=1") / 20
    assert all(got(v) == sorted(want[v].items()) for v in (1, 3, 5))
    keys = rows([7, 19, 500, 10**6], 0)
    names = {r.url for r in keys.collect()}
    asked = sorted((u, n) for u, n in want[5].items() if u in names)
    assert got(5, keys) == asked and len(asked) == 3
    base = len(list((tmp_path / "t" / "base").rglob("v=1")))
    table.compact(spark, 4)
    touched = len(list((tmp_path / "t" / "base").rglob("v=4")))
    assert 0 < touched <= base
    assert all(got(v) == sorted(want[v].items()) for v in (1, 3, 4, 5)) and got(5, keys) == asked
    table.write(rows(range(5), 9), 5)   # version 5 again
    assert got(4) == sorted(want[4].items()) and got(5) == sorted((want[4] | {f"http://h{i}.com/{i}": 9 for i in range(5)}).items())


def test_empty_buckets_are_committed(spark, tmp_path):
    (tmp_path / "src" / "20240101" / "0000").mkdir(parents=True)
    run(spark, tmp_path, datetime(2024, 1, 1, 1)).awaitTermination()
    assert CH.committed_version(spark, str(tmp_path / "t")) == 1
    assert CH.read_table(spark, str(tmp_path / "t"), "url_state").count() == 0


# late rows

def test_late_rows_over_many_batches(spark, tmp_path):
    """More micro-batches than a progress log keeps; every row is in a final window, an open one or late."""
    rng = random.Random(5)
    base, batches = datetime(2024, 1, 1, tzinfo=timezone.utc), []
    for k in range(110):
        batches.append([(base + timedelta(minutes=10 * k + rng.uniform(-90 if rng.random() < 0.2 else 0, 10)), rng.randint(1, 2)) for _ in range(3)])
    out, seen, late, counts, final = str(tmp_path / "out"), None, Counter(), Counter(), Counter()
    floor = lambda t: t - timedelta(minutes=t.minute % 10, seconds=t.second, microseconds=t.microsecond)
    for rows in batches:
        mark = seen and seen - timedelta(minutes=20)
        for t, w in rows:
            if mark and floor(t) + timedelta(minutes=10) <= mark:
                late[floor(t), w] += 1
            else:
                counts[floor(t), w] += 1
        seen = max([x for x in (seen, *(t for t, _ in rows)) if x])
        for key in [x for x in counts if x[0] + timedelta(minutes=10) <= seen - timedelta(minutes=20)]:
            final[key] += counts.pop(key)
    assert late and final and counts
    frame = spark.createDataFrame([(k, t, w) for k, rows in enumerate(batches) for t, w in rows], "k int, ts timestamp, worker_id int").cache()
    for k in range(len(batches)):
        WN.window_micro_batch(spark, out, frame.where(F.col("k") == k).drop("k"), k, "10 minutes", timedelta(minutes=20), "worker_id")
        if k in (3, 50):   # again, after its commit
            WN.window_micro_batch(spark, out, frame.where(F.col("k") == k).drop("k"), k, "10 minutes", timedelta(minutes=20), "worker_id")
    rows = lambda part, n: Counter({(r.window_start.replace(tzinfo=timezone.utc) if r.window_start.tzinfo is None else r.window_start, r.worker_id): r.m for r in
                                    WN.read_windows(spark, out, part).groupBy("window_start", "worker_id").agg(n.alias("m")).collect()})
    shifted = lambda c: sorted((k[0].timestamp(), k[1], n) for k, n in c.items())
    assert shifted(rows("final", F.sum("n"))) == shifted(final)
    assert shifted(rows("open", F.sum("n"))) == shifted(counts)
    assert shifted(rows("late", F.count("*"))) == shifted(late)


def test_pairs_of_streams_without_an_end(spark):
    starts = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 1))], "request_id long, ts timestamp")
    ends = spark.createDataFrame([(1, datetime(2024, 1, 1, 0, 0, 2), 500), (2, datetime(2024, 1, 1, 0, 20), 1)], "request_id long, ts timestamp, download_latency_ms long")
    got = {r.request_id: (r.total_ms, r.pre_response_ms) for r in LG.stream_request_latency(starts, ends).collect()}
    assert got == {1: (2000, 1500), 2: (None, None)}
