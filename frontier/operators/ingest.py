"""Ingest: keyed state transitions of the URL frontier.

* :func:`aggregate_links`  UM-6  link pre-aggregation (map-side combine)
* :func:`upsert_links`     UM-7  insert new URLs / add inlink counters
* :func:`fold_results`     UM-1..UM-4  fetch-result upsert as one ordered fold
* :func:`counter_delta`, :func:`merge_counters`  UM-5
* :func:`domain_pause`     UM-9  domain back-off / reset
* :func:`batch_metrics`    AG-4
* :func:`ingest_batch`     UM-8  links, then results, in one job

Design: repeated fetches of one URL in a batch are successive upserts; the
fold reproduces them exactly (ordered by a strict ``seq``) with running
aggregates.  These run over blocks of the batch sorted by (url, seq), with
carries between blocks (:mod:`.running`), so a URL that holds a third of a
batch is spread over many tasks.  The batch is joined to the current state on
``url`` once, and the link path pre-aggregates before any shuffle.  No output
row is dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as SC
from ..session import cut_lineage
from . import running as RUN

# Robots classification.
ROBOTS_UNKNOWN, ROBOTS_ALLOWED, ROBOTS_DISALLOWED = 0, 1, 2
ROBOTS_FAIL_PREFIX = "IgnoreRequest Forbidden by robots.txt"

# Fail reasons that pause a whole domain, and the base pause
# (minutes); any "HttpError 5xx" pauses for 30 minutes.
DOMAIN_PAUSE_BASE_MINUTES = {
    "IgnoreRequest Forbidden by robots.txt": 24 * 60,
    "ConnectionRefusedError": 12 * 60,
    "HttpError 410": 24 * 60,
    "NonHTML content-type": 6 * 60,
    "HttpError 403": 6 * 60,
    "HttpError 400": 6 * 60,
    "HttpError 429": 60,
    "TimeoutError": 60,
    "ResponseNeverReceived": 60,
}
HTTP_5XX_PAUSE_MINUTES = 30
MAX_PAUSE_EXPONENT = 6
MAX_URL_LEN = 2500


def pause_base_minutes(reason) -> Column:
    """PF-8: fail reason -> base pause in minutes (NULL = no pause)."""
    r = F.col(reason) if isinstance(reason, str) else reason
    m = F.create_map(*[x for k, v in DOMAIN_PAUSE_BASE_MINUTES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, r),
                      F.when(r.startswith("HttpError 5"), F.lit(HTTP_5XX_PAUSE_MINUTES)))


def robots_bits(is_ok: Column, fail_reason: Column) -> Column:
    """PF-7: 2 = disallowed by robots, 1 = allowed, 0 = unknown."""
    fr = F.coalesce(fail_reason, F.lit(""))
    return (F.when(fr.startswith(ROBOTS_FAIL_PREFIX), F.lit(ROBOTS_DISALLOWED))
            .when(is_ok | (fr == "NonHTML content-type") | fr.startswith("HttpError "), F.lit(ROBOTS_ALLOWED))
            .otherwise(F.lit(ROBOTS_UNKNOWN))).cast("short")


def parse_optional_ts(c: Column) -> Column:
    """PF-9: ISO-8601 string -> timestamp, NULL when empty or malformed
    (timestamps pass through)."""
    return F.try_to_timestamp(F.nullif(F.trim(c.cast("string")), F.lit("")))


def _ts(df: DataFrame, col: str) -> Column:
    t = dict(df.dtypes).get(col)
    if t is None:
        return F.lit(None).cast("timestamp")
    if t == "string":
        return parse_optional_ts(F.col(col))
    return F.col(col).cast("timestamp")


def decode_results(results: DataFrame, as_of) -> DataFrame:
    """PF-6/PF-7: derived columns of fetch results: is_ok, inc_ok, inc_fail,
    fetched_at (default ``as_of``), page metadata nulled on failure,
    robots_bits.  Records with URLs over 2500 characters are dropped (PF-2)."""
    cols = set(results.columns)

    def opt(name, typ):
        return F.col(name).cast(typ) if name in cols else F.lit(None).cast(typ)

    is_ok = F.col("status") == "ok"
    out = results.filter(F.col("url").isNotNull() & (F.length("url") <= MAX_URL_LEN)).select(
        "url", "seq", F.col("domain_id").cast("long").alias("domain_id"),
        opt("shard_id", "int").alias("shard_id"),
        F.coalesce(is_ok, F.lit(False)).alias("is_ok"),
        F.coalesce(_ts(results, "fetched_at"), F.lit(as_of).cast("timestamp")).alias("fetched_at"),
        (_ts(results, "last_modified") if "last_modified" in cols else F.lit(None).cast("timestamp")).alias("last_modified"),
        opt("fail_reason", "string").alias("fail_reason"),
        opt("content_hash", "string").alias("content_hash"),
        F.when(is_ok, opt("title", "string")).alias("title"),
        F.when(is_ok, opt("hreflang_count", "int")).alias("hreflang_count"),
        F.when(is_ok, opt("has_json_ld", "boolean")).alias("has_json_ld"),
        opt("etag", "string").alias("etag"), opt("cache_control", "string").alias("cache_control"),
        opt("is_redirect", "boolean").alias("is_redirect"),
        opt("redirect_hop_count", "short").alias("redirect_hop_count"),
    )
    return (out.withColumn("inc_ok", F.col("is_ok").cast("int"))
               .withColumn("inc_fail", 1 - F.col("inc_ok"))
               .withColumn("robots_bits", robots_bits(F.col("is_ok"), F.col("fail_reason"))))


_FOLD_COALESCE = ("title", "hreflang_count", "has_json_ld", "last_modified", "etag", "cache_control",
                  "is_redirect", "redirect_hop_count")


def _decided(state: DataFrame, decoded: DataFrame, more: list[RUN.Running], keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """Decoded records beside the URL's old row (``o_`` columns) with ``is_upd``, ``__domain`` (of
    the URL's first record), ``__rn`` and ``more`` running aggregates."""
    is_ok = F.col("is_ok")
    old = state.select("url", *[F.col(c).alias("o_" + c) for c in SC.URL_STATE.fieldNames() if c != "url"], F.lit(True).alias("o_exists"))
    j = RUN.run(RUN.in_blocks(decoded, "url", "seq", keep), "url", "seq", [
        RUN.Running("__prev", "last", F.when(is_ok, F.col("content_hash")), before=True), RUN.Running("__domain", "first", F.col("domain_id")), *more])
    h = F.col("content_hash")
    return j.join(old, "url", "left").withColumn("is_upd", is_ok & h.isNotNull() & ~h.eqNullSafe(F.coalesce("__prev", "o_content_hash")))


def record_outcomes(state: DataFrame, results: DataFrame, as_of) -> DataFrame:
    """Per batch record what :func:`batch_metrics` and :func:`domain_pause` count (domain_id, seq, is_ok,
    is_upd, new_link, record_fail_reason, inc_ok, inc_fail, inc_upd), as :func:`fold_results` gives it
    but without the post-images and their second pass."""
    few = decode_results(results, as_of).select("url", "seq", "domain_id", "is_ok", "content_hash", "fail_reason", "inc_ok", "inc_fail")
    has_old = F.coalesce(F.col("o_exists"), F.lit(False))
    return _decided(state, few, []).select(
        F.when(has_old, F.col("o_domain_id")).otherwise(F.col("__domain")).cast("long").alias("domain_id"), "seq", "is_ok", "is_upd",
        F.col("fail_reason").alias("record_fail_reason"), (~has_old & (F.col("__rn") == 1)).alias("new_link"),
        "inc_ok", "inc_fail", F.col("is_upd").cast("int").alias("inc_upd"))


def fold_results(state: DataFrame, results: DataFrame, as_of, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """UM-1..UM-4: fold a batch of fetch results into URL state (``keep`` stores a step).

    Returns one row per batch record: the post-image of the URL after that
    record (all url_state columns), plus ``seq``, ``is_ok``, ``is_upd``,
    ``new_link`` (row inserted the URL), ``is_last`` (final image of the URL
    in this batch) and ``fail_reason`` of the record.
    """
    o = lambda c: F.col("o_" + c)
    has_old = F.coalesce(F.col("o_exists"), F.lit(False))
    is_ok, when = F.col("is_ok"), F.when
    # first pass: what doesn't depend on updates; second pass: updates, which need the hash before each record
    j = _decided(state, decode_results(results, as_of), [
        RUN.Running("__ok", "sum", F.col("inc_ok")),
        RUN.Running("__fail", "sum", F.col("inc_fail")), RUN.Running("__ok_at", "last", when(is_ok, F.col("fetched_at"))),
        RUN.Running("__hash", "first", F.col("content_hash")),
        RUN.Running("__robots", "last", when(F.col("robots_bits") != 0, F.col("robots_bits"))),
        *[RUN.Running(f"__l_{c}", "last", F.col(c)) for c in _FOLD_COALESCE]], keep)
    j = keep(j.withColumn("__inc_upd", F.col("is_upd").cast("int")).withColumnRenamed("__rn", "__place").withColumnRenamed("__final", "__last"))
    j = RUN.run(j, "url", "seq", [
        RUN.Running("__upd", "sum", F.col("__inc_upd")), RUN.Running("__upd_at", "last", when(F.col("is_upd"), F.col("fetched_at"))),
        RUN.Running("__upd_hash", "last", when(F.col("is_upd"), F.col("content_hash"))),
        RUN.Running("__ok_place", "last", when(is_ok, F.col("__place")))])
    cur = {
        "domain_id": when(has_old, o("domain_id")).otherwise(F.col("__domain")),
        "first_seen": when(has_old, o("first_seen")).otherwise(F.lit(as_of).cast("timestamp")),
        "last_fetch_ok": F.coalesce(F.col("__ok_at"), o("last_fetch_ok")),
        "last_content_update": F.coalesce(F.col("__upd_at"), o("last_content_update")),
        "num_fetch_ok_90d": (F.coalesce(o("num_fetch_ok_90d"), F.lit(0)) + F.col("__ok")).cast("int"),
        "num_fetch_fail_90d": (F.coalesce(o("num_fetch_fail_90d"), F.lit(0)) + F.col("__fail")).cast("int"),
        "num_content_update_90d": (F.coalesce(o("num_content_update_90d"), F.lit(0)) + F.col("__upd")).cast("int"),
        "num_consecutive_fail": when(F.col("__ok_place").isNull(), F.coalesce(o("num_consecutive_fail"), F.lit(0)) + F.col("__place"))
                                .otherwise(F.col("__place") - F.col("__ok_place")).cast("int"),
        "last_fail_reason": when(~is_ok, F.col("fail_reason")),
        # an insert stores any hash
        "content_hash": F.coalesce(F.col("__upd_hash"), when(has_old, o("content_hash")).otherwise(F.col("__hash"))),
        "should_crawl": F.lit(False),
        "robots_bits": F.coalesce(F.col("__robots"), o("robots_bits"), F.lit(0)).cast("short"),
    }
    for c in _FOLD_COALESCE:
        cur[c] = F.coalesce(F.col(f"__l_{c}"), o(c))
    defaults = SC.URL_STATE_DEFAULTS
    cols = []
    for f in SC.URL_STATE.fields:
        if f.name == "url":
            cols.append(F.col("url"))
        elif f.name == "shard_id":
            cols.append(F.coalesce(F.col("shard_id"), o("shard_id")).cast("int").alias("shard_id"))
        elif f.name in cur:
            cols.append(cur[f.name].cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.when(has_old, o(f.name)).otherwise(F.lit(defaults[f.name])).cast(f.dataType).alias(f.name))
        else:
            cols.append(o(f.name).cast(f.dataType).alias(f.name))
    return j.select(*cols, "seq", "is_ok", "is_upd", F.col("fail_reason").alias("record_fail_reason"),
                    (~has_old & (F.col("__place") == 1)).alias("new_link"),
                    F.col("__last").alias("is_last"),
                    F.col("inc_ok"), F.col("inc_fail"), F.col("__inc_upd").alias("inc_upd"))


def history_rows(folded: DataFrame, as_of) -> DataFrame:
    """UM-4: every post-image of the fold, stamped with ``snapshot_at``."""
    return folded.select(*SC.URL_STATE.fieldNames(), F.lit(as_of).cast("timestamp").alias("snapshot_at"))


def merge_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """Replace/insert ``changed`` rows (one per url, url_state columns) in
    ``state``: a single full outer join on ``url``, changed side wins."""
    names = SC.URL_STATE.fieldNames()
    new = changed.select(*[F.col(c).alias("n_" + c) if c != "url" else F.col("url") for c in names],
                         F.lit(True).alias("__n"))
    j = state.select(*names).join(new, "url", "full_outer")
    return j.select("url", *[F.when(F.col("__n").isNotNull(), F.col("n_" + c)).otherwise(F.col(c)).alias(c)
                             for c in names if c != "url"])


def final_images(folded: DataFrame) -> DataFrame:
    return folded.filter("is_last").select(*SC.URL_STATE.fieldNames())


# --------------------------------------------------------------------------
# Links (UM-6, UM-7)
# --------------------------------------------------------------------------

def aggregate_links(links: DataFrame) -> DataFrame:
    """UM-6: collapse discovery records by URL: sum inlink counters (default
    1 / 0), keep the first record (by ``seq``) and the first non-empty anchor.
    Records without a URL are dropped.  All aggregates are partial-
    aggregatable, so a hot URL is pre-combined in every map task."""
    keep = [c for c in links.columns if c not in ("url", "inlink_count_approx", "inlink_count_external",
                                                  "anchor_text", "seq")]
    l2 = links.filter(F.col("url").isNotNull() & (F.col("url") != ""))
    anchor = F.col("anchor_text") if "anchor_text" in links.columns else F.lit(None).cast("string")
    approx = F.col("inlink_count_approx") if "inlink_count_approx" in links.columns else F.lit(None)
    ext = F.col("inlink_count_external") if "inlink_count_external" in links.columns else F.lit(None)
    agg = l2.groupBy("url").agg(
        F.min(F.struct(F.col("seq"), *[F.col(c) for c in keep])).alias("__first"),
        F.sum(F.coalesce(approx.cast("long"), F.lit(1))).cast("int").alias("inlink_count_approx"),
        F.sum(F.coalesce(ext.cast("long"), F.lit(0))).cast("int").alias("inlink_count_external"),
        F.min(F.when(F.coalesce(anchor, F.lit("")) != "", F.struct(F.col("seq"), anchor.alias("a"))))["a"]
         .alias("__anchor"),
    )
    return agg.select("url", "__first.seq", *[F.col("__first." + c).alias(c) for c in keep],
                      "inlink_count_approx", "inlink_count_external",
                      F.col("__anchor").alias("anchor_text"))


def upsert_links(state: DataFrame, links_agg: DataFrame, as_of, scores: DataFrame | None = None):
    """UM-7: insert unseen URLs (with domain score, provenance, inline score
    if given); for existing URLs add inlink counters and fill the anchor only
    where it is NULL.  Returns ``(changed_rows, inserted_history, results)``:
    ``results`` is the changed rows with ``inserted``, one per aggregated link."""
    lk = links_agg
    if scores is not None:
        lk = lk.join(scores.select("url", F.col("url_score").alias("__score"),
                                   F.col("url_score_updated_at").alias("__scored_at")), "url", "left")
    else:
        lk = lk.withColumn("__score", F.lit(None).cast("double")).withColumn("__scored_at", F.lit(None).cast("timestamp"))
    names = SC.URL_STATE.fieldNames()
    old = state.select(*[F.col(c).alias("o_" + c) if c != "url" else F.col("url") for c in names],
                       F.lit(True).alias("__o"))
    j = lk.join(old, "url", "left")
    ins = F.col("__o").isNull()
    cols = set(lk.columns)

    def link(c, typ, default=None):
        v = F.col(c).cast(typ) if c in cols else F.lit(None).cast(typ)
        return F.coalesce(v, F.lit(default).cast(typ)) if default is not None else v

    anchor_new = F.nullif(link("anchor_text", "string"), F.lit(""))
    new_row = {
        "domain_id": link("domain_id", "long"), "first_seen": F.lit(as_of).cast("timestamp"),
        "domain_score": link("domain_score", "double", 0.0),
        "url_score": F.coalesce(F.col("__score"), F.lit(0.0)), "url_score_updated_at": F.col("__scored_at"),
        "discovered_from": link("discovered_from", "string"),
        "discovery_source_type": link("discovery_source_type", "short", 0),
        "parent_page_score": link("parent_page_score", "double"),
        "inlink_count_approx": link("inlink_count_approx", "int", 0),
        "inlink_count_external": link("inlink_count_external", "int", 0),
        "anchor_text": anchor_new, "shard_id": link("shard_id", "int"),
    }
    upd = {
        "inlink_count_approx": F.col("o_inlink_count_approx") + link("inlink_count_approx", "int", 0),
        "inlink_count_external": F.col("o_inlink_count_external") + link("inlink_count_external", "int", 0),
        "anchor_text": F.coalesce(F.col("o_anchor_text"), anchor_new),
    }
    out = []
    for f in SC.URL_STATE.fields:
        c = f.name
        if c == "url":
            out.append(F.col("url"))
            continue
        ins_v = new_row.get(c, F.lit(SC.URL_STATE_DEFAULTS.get(c)))
        upd_v = upd.get(c, F.col("o_" + c))
        out.append(F.when(ins, ins_v).otherwise(upd_v).cast(f.dataType).alias(c))
    changed = j.select(*out, ins.alias("inserted"))
    hist = changed.filter("inserted").drop("inserted").withColumn("snapshot_at", F.lit(as_of).cast("timestamp"))
    return changed.drop("inserted"), hist, changed


# --------------------------------------------------------------------------
# Counters (UM-5) and domain pause (UM-9)
# --------------------------------------------------------------------------

def counter_delta(folded: DataFrame, as_of) -> DataFrame:
    """UM-5: per-URL daily counter increments of a batch (ingest date)."""
    return (folded.groupBy("url").agg(
        F.sum("inc_ok").cast("int").alias("num_fetch_ok"),
        F.sum("inc_fail").cast("int").alias("num_fetch_fail"),
        F.sum("inc_upd").cast("int").alias("num_content_update"),
        F.first("shard_id").alias("shard_id"))
        .withColumn("event_date", F.to_date(F.lit(as_of).cast("timestamp"))))


def merge_counters(counters: DataFrame, delta: DataFrame, add: tuple[str, ...] = (
        "num_fetch_ok", "num_fetch_fail", "num_content_update")) -> DataFrame:
    """UM-5 merge: add increments on (url, event_date); new rows get
    ``accounted = true`` and zero for the other counters."""
    d = delta.select("url", "event_date", *[F.col(c).alias("d_" + c) for c in add],
                     *([F.col("shard_id").alias("d_shard_id")] if "shard_id" in delta.columns else []),
                     F.lit(True).alias("__d"))
    j = counters.join(d, ["url", "event_date"], "full_outer")
    out = []
    for f in SC.URL_EVENT_COUNTER.fields:
        c = f.name
        if c in ("url", "event_date"):
            out.append(F.col(c))
        elif c in add:
            out.append((F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col("d_" + c), F.lit(0))).cast("int").alias(c))
        elif c == "accounted":
            out.append(F.coalesce(F.col(c), F.lit(True)).alias(c))
        elif c == "shard_id":
            out.append(F.coalesce(F.col(c), F.col("d_shard_id") if "shard_id" in delta.columns else F.lit(None))
                       .cast("int").alias(c))
        else:
            out.append(F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c))
    return j.select(*out)


def domain_pause(domain_state: DataFrame, folded: DataFrame, as_of) -> DataFrame:
    """UM-9: back-off of domains, record by record in ``seq`` order: a fail with a
    pausing reason, of a domain that isn't paused, gives count + 1 and
    ``paused_until = as_of + base * 2^least(old_count, 6)``; an ok result of a
    domain with a count over 0 gives count 0 and no pause.

    The order makes the result independent of how records are cut into batches
    (given one ``as_of``).  No record-wise loop is needed: after the last ok
    record only the first pausing fail behind it counts, and without an ok record
    only the first pausing fail.  Returns the changed domain rows."""
    f = folded.select("domain_id", "seq", "is_ok", pause_base_minutes(F.col("record_fail_reason")).alias("base"))
    fail = ~F.col("is_ok") & F.col("base").isNotNull()
    seen = f.groupBy("domain_id").agg(
        F.max(F.when(F.col("is_ok"), F.col("seq"))).alias("last_ok"),
        F.min(F.when(fail, F.struct("seq", "base"))).alias("first_fail"))
    behind = (f.where(fail).join(seen.where("last_ok IS NOT NULL").select("domain_id", "last_ok"), "domain_id")
              .where("seq > last_ok").groupBy("domain_id").agg(F.min(F.struct("seq", "base")).alias("behind")))
    j = domain_state.join(seen, "domain_id").join(behind, "domain_id", "left")
    now = F.lit(as_of).cast("timestamp")
    count = F.coalesce(F.col("domain_fail_count"), F.lit(0))
    paused = F.coalesce(F.col("crawl_paused_until") >= now, F.lit(False))
    any_ok = F.col("last_ok").isNotNull()
    # the state that an ok record resets: a count from before, or from a fail before it
    reset = any_ok & ((count > 0) | (~paused & F.coalesce(F.col("first_fail.seq") < F.col("last_ok"), F.lit(False))))
    base = F.when(any_ok, F.col("behind.base")).otherwise(F.col("first_fail.base"))
    pause = base.isNotNull() & (reset | ~paused)
    old = F.when(reset, F.lit(0)).otherwise(count)
    until = now + F.make_dt_interval(mins=base) * F.pow(F.lit(2), F.least(old, F.lit(MAX_PAUSE_EXPONENT))).cast("int")
    out = j.select(
        "domain_id", "domain", "shard_id", "domain_score",
        F.when(pause, until).when(reset, F.lit(None).cast("timestamp")).otherwise(F.col("crawl_paused_until")).alias("crawl_paused_until"),
        F.when(pause, old + 1).otherwise(old).cast("int").alias("domain_fail_count"),
        (~F.col("crawl_paused_until").eqNullSafe(F.when(pause, until).when(reset, F.lit(None).cast("timestamp")).otherwise(F.col("crawl_paused_until")))
         | (count != F.when(pause, old + 1).otherwise(old))).alias("__changed"))
    return out.where("__changed").drop("__changed")


def merge_domains(domain_state: DataFrame, changed: DataFrame) -> DataFrame:
    """Apply changed domain rows (changed side wins), one join on domain_id."""
    names = [f.name for f in SC.DOMAIN_STATE.fields]
    new = changed.select("domain_id", *[F.col(c).alias("n_" + c) for c in names if c != "domain_id"],
                         F.lit(True).alias("__n"))
    j = domain_state.select(*names).join(new, "domain_id", "full_outer")
    return j.select("domain_id", *[F.when(F.col("__n").isNotNull(), F.col("n_" + c)).otherwise(F.col(c)).alias(c)
                                   for c in names if c != "domain_id"])


# --------------------------------------------------------------------------
# Batch metrics (AG-4) and the whole batch (UM-8)
# --------------------------------------------------------------------------

def batch_metrics(folded: DataFrame, link_results: DataFrame | None = None):
    """AG-4: ``(global, per_domain, reasons)`` metric DataFrames of a batch:
    new_links, num_fetch_ok, num_fetch_fail, num_content_update, and fail
    reason counts (global and per domain)."""
    new_from_links = (link_results.agg(F.count_if("inserted").alias("n")) if link_results is not None
                      else None)
    g = folded.agg(F.count_if("new_link").alias("new_links_results"),
                   F.sum("inc_ok").cast("long").alias("num_fetch_ok"),
                   F.sum("inc_fail").cast("long").alias("num_fetch_fail"),
                   F.sum("inc_upd").cast("long").alias("num_content_update"))
    if new_from_links is not None:
        g = g.crossJoin(new_from_links)  # two one-row aggregates
        g = g.select((F.col("new_links_results") + F.col("n")).cast("long").alias("new_links"),
                     "num_fetch_ok", "num_fetch_fail", "num_content_update")
    else:
        g = g.select(F.col("new_links_results").cast("long").alias("new_links"),
                     "num_fetch_ok", "num_fetch_fail", "num_content_update")
    per_domain = folded.groupBy("domain_id").agg(
        F.sum("inc_ok").cast("long").alias("num_fetch_ok"),
        F.sum("inc_fail").cast("long").alias("num_fetch_fail"),
        F.sum("inc_upd").cast("long").alias("num_content_update"))
    reasons = (folded.filter(F.col("record_fail_reason").isNotNull() & (F.col("record_fail_reason") != ""))
               .groupBy("domain_id", F.col("record_fail_reason").alias("reason"))
               .agg(F.count(F.lit(1)).alias("n")))
    return g, per_domain, reasons


def global_reasons(reasons: DataFrame) -> DataFrame:
    """AG-4: fail-reason counts of the batch, over all domains."""
    return reasons.groupBy("reason").agg(F.sum("n").alias("n"))


@dataclass
class IngestOutput:
    state: DataFrame          # new url_state (all rows)
    history: DataFrame        # appended history rows
    counters: DataFrame       # new url_event_counter
    domain_state: DataFrame   # new domain_state
    folded: DataFrame         # per-record post-images (results)
    link_results: DataFrame   # url, inserted


def ingest_batch(state: DataFrame, counters: DataFrame, domain_state: DataFrame, batch: DataFrame,
                 as_of, scores: DataFrame | None = None, keep: Callable[[DataFrame], DataFrame] = cut_lineage,
                 brief: Callable[[DataFrame], DataFrame] = cut_lineage) -> IngestOutput:
    """UM-8: one ingest batch: oversize URLs dropped, ``new`` link records
    aggregated and upserted first, then fetch results folded on top of the
    updated state; history, counters and domain pause follow.

    What several steps read is stored by ``keep`` (a reliable checkpoint by
    default): the upserted links, the link-updated state of the URLs that have
    results, and the fold over them. All other rows of the state are merged once.
    What ``brief`` stores, and ``batch``, aren't read any more after the return."""
    b = batch.filter(F.col("url").isNotNull() & (F.length("url") <= MAX_URL_LEN))
    of_links = {"seq", *SC.ROUTED_LINK.fieldNames()}   # no other columns are carried through the aggregation
    links = b.filter(F.col("status") == "new").select(*[c for c in b.columns if c in of_links])
    results = b.filter(F.coalesce(F.col("status"), F.lit("")) != "new")
    link_results = keep(upsert_links(state, aggregate_links(links), as_of, scores)[2])
    changed_links = link_results.drop("inserted")
    link_hist = link_results.filter("inserted").drop("inserted").withColumn("snapshot_at", F.lit(as_of).cast("timestamp"))
    urls = keep(results.select("url").distinct())
    near = keep(merge_state(state.join(urls, "url", "left_semi"), changed_links.join(urls, "url", "left_semi")))
    others = merge_state(state.join(urls, "url", "left_anti"), changed_links.join(urls, "url", "left_anti"))
    folded = keep(fold_results(near, results, as_of, brief))
    state2 = others.unionByName(merge_state(near, final_images(folded)))
    hist = link_hist.unionByName(history_rows(folded, as_of))
    new_counters = merge_counters(counters, counter_delta(folded, as_of))
    new_domains = merge_domains(domain_state, domain_pause(domain_state, folded, as_of))
    return IngestOutput(state2, hist, new_counters, new_domains, folded, link_results)
