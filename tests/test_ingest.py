"""UM-1: the window fold equals a plain row-by-row application of the upsert
rules on random batches with repeated URLs (SURVEY §5 (d))."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from frontier import schema as SC
from frontier.operators import ingest as IG

AS_OF = "2024-02-01 00:00:00"
REASONS = [None, "HttpError 503", "TimeoutError", "IgnoreRequest Forbidden by robots.txt", "DNSLookupError"]


def py_fold(old, batch):
    state = {u: dict(r) for u, r in old.items()}
    out = []
    for rec in sorted(batch, key=lambda r: r["seq"]):
        u = rec["url"]
        ok = rec["status"] == "ok"
        rb = 2 if (rec["fail_reason"] or "").startswith("IgnoreRequest Forbidden") else (
            1 if ok or (rec["fail_reason"] or "").startswith("HttpError ") else 0)
        cur = state.get(u)
        h = rec["content_hash"]
        if cur is None:
            upd = ok and h is not None
            cur = {"ok": int(ok), "fail": int(not ok), "upd": int(upd), "cf": int(not ok), "hash": h, "rb": rb,
                   "title": rec["title"] if ok else None, "lfo": rec["fetched_at"] if ok else None, "new": True}
        else:
            upd = ok and h is not None and cur["hash"] != h
            cur = dict(cur, new=False)
            cur["ok"] += int(ok)
            cur["fail"] += int(not ok)
            cur["upd"] += int(upd)
            cur["cf"] = 0 if ok else cur["cf"] + 1
            if upd:
                cur["hash"] = h
            if rb != 0:
                cur["rb"] = rb
            if ok and rec["title"] is not None:
                cur["title"] = rec["title"]
            if ok:
                cur["lfo"] = rec["fetched_at"]
        state[u] = cur
        out.append((rec["seq"], cur["ok"], cur["fail"], cur["upd"], cur["cf"], cur["hash"], cur["rb"], cur["title"],
                    cur["lfo"], cur["new"], upd))
    return out


def test_fold_matches_row_by_row(spark):
    rng = random.Random(7)
    urls = [f"https://h{i % 3}.ex.com/{i}" for i in range(12)]
    t0 = datetime(2024, 1, 1)
    old = {}
    for u in urls[:6]:
        old[u] = {"ok": rng.randint(0, 3), "fail": rng.randint(0, 3), "upd": rng.randint(0, 2), "cf": rng.randint(0, 2),
                  "hash": rng.choice([None, "a", "b"]), "rb": rng.randint(0, 2), "title": rng.choice([None, "t"]),
                  "lfo": None, "new": False}
    batch = []
    for seq in range(300):
        ok = rng.random() < 0.6
        batch.append({"seq": seq, "url": rng.choice(urls), "domain_id": 1, "status": "ok" if ok else "fail",
                      "fail_reason": None if ok else rng.choice(REASONS[1:]),
                      "content_hash": rng.choice([None, "a", "b", "c"]) if ok else None,
                      "title": rng.choice([None, "x", "y"]), "fetched_at": t0 + timedelta(minutes=seq)})
    old_df = SC.conform(spark.createDataFrame(
        [(u, 1, r["ok"], r["fail"], r["upd"], r["cf"], r["hash"], r["rb"], r["title"]) for u, r in old.items()],
        "url string, domain_id long, num_fetch_ok_90d int, num_fetch_fail_90d int, num_content_update_90d int, "
        "num_consecutive_fail int, content_hash string, robots_bits short, title string"), SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    bdf = spark.createDataFrame(batch, "seq long, url string, domain_id long, status string, fail_reason string, "
                                       "content_hash string, title string, fetched_at timestamp")
    got = IG.fold_results(old_df, bdf, AS_OF).select(
        "seq", "num_fetch_ok_90d", "num_fetch_fail_90d", "num_content_update_90d", "num_consecutive_fail",
        "content_hash", "robots_bits", "title", "last_fetch_ok", "new_link", "is_upd").orderBy("seq").collect()
    exp = py_fold(old, batch)
    assert [tuple(r) for r in got] == exp


def test_aggregate_links_and_upsert(spark):
    links = spark.createDataFrame(
        [("u1", 1, "", 1, 0), ("u1", 2, "a2", 1, 1), ("u1", 3, "a3", 1, 1), ("u2", 4, None, None, None), ("", 5, "z", 1, 0)],
        "url string, seq long, anchor_text string, inlink_count_approx int, inlink_count_external int") \
        .withColumn("domain_id", F.lit(7).cast("long")).withColumn("discovered_from", F.concat(F.lit("p"), F.col("seq")))
    agg = {r.url: r for r in IG.aggregate_links(links).collect()}
    assert set(agg) == {"u1", "u2"}
    assert (agg["u1"].inlink_count_approx, agg["u1"].inlink_count_external, agg["u1"].anchor_text,
            agg["u1"].discovered_from) == (3, 2, "a2", "p1")
    assert (agg["u2"].inlink_count_approx, agg["u2"].inlink_count_external, agg["u2"].anchor_text) == (1, 0, None)
    old = SC.conform(spark.createDataFrame([("u1", 5, 1, None)], "url string, inlink_count_approx int, "
                                           "inlink_count_external int, anchor_text string").withColumn("domain_id", F.lit(1)),
                     SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    changed, hist, res = IG.upsert_links(old, IG.aggregate_links(links), AS_OF)
    ch = {r.url: r for r in changed.collect()}
    assert (ch["u1"].inlink_count_approx, ch["u1"].inlink_count_external, ch["u1"].anchor_text, ch["u1"].domain_id) == (8, 3, "a2", 1)
    assert ch["u2"].domain_id == 7 and ch["u2"].inlink_count_approx == 1
    assert [r.url for r in hist.collect()] == ["u2"]


def test_merge_counters_adds(spark):
    c = spark.createDataFrame([("u", "2024-02-01", 2, 1, 0, 0, False, 3)],
                              "url string, event_date string, num_scheduled int, num_fetch_ok int, num_fetch_fail int, "
                              "num_content_update int, accounted boolean, shard_id int").withColumn("event_date", F.to_date("event_date"))
    d = spark.createDataFrame([("u", 2, 1, 1), ("v", 1, 0, 0)], "url string, num_fetch_ok int, num_fetch_fail int, "
                              "num_content_update int").withColumn("event_date", F.to_date(F.lit("2024-02-01"))) \
        .withColumn("shard_id", F.lit(3))
    m = {r.url: r for r in IG.merge_counters(c, d).collect()}
    assert (m["u"].num_fetch_ok, m["u"].num_fetch_fail, m["u"].num_scheduled, m["u"].accounted) == (3, 1, 2, False)
    assert (m["v"].num_fetch_ok, m["v"].accounted, m["v"].num_scheduled) == (1, True, 0)
