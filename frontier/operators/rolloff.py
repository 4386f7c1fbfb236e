"""90-day counter rolloff."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as SC

_COUNTS = (("num_scheduled", "num_scheduled_90d"), ("num_fetch_ok", "num_fetch_ok_90d"),
           ("num_fetch_fail", "num_fetch_fail_90d"), ("num_content_update", "num_content_update_90d"))


@dataclass
class RolloffOutput:
    changed: DataFrame    # url_state rows with counters reduced
    history: DataFrame    # snapshots of the changed rows
    counters: DataFrame   # url_event_counter with rolled rows marked accounted = false
    totals: DataFrame     # one row: picked, processed, missing, history, marked


def rolloff(state: DataFrame, counters: DataFrame, cutoff, as_of, limit: int | None = None) -> RolloffOutput:
    """RK-1: counter rows still to be rolled off (``accounted``) dated on or
    before ``cutoff`` are summed per URL (AG-3) and subtracted from the
    URL's 90-day counters, floored at 0; every changed URL gets a history
    row; all picked rows - also those whose URL is missing from the state
    (RJ-11) - are marked ``accounted = false``, so a second run is a no-op.
    ``limit`` optionally takes only the first rows by ``(event_date, url)``
    (WT-8); by default the whole eligible set is processed."""
    cut = F.to_date(F.lit(cutoff))
    picked = counters.filter(F.col("accounted") & (F.col("event_date") <= cut))
    if limit:
        picked = picked.orderBy("event_date", "url").limit(limit)
    keys = state.select("url", F.lit(True).alias("__cur"))
    tagged = picked.join(keys, "url", "left")
    processable = tagged.filter(F.col("__cur").isNotNull())
    by_url = processable.groupBy("url").agg(*[F.sum(c).alias("d_" + c) for c, _ in _COUNTS])
    target = {state_col: c for c, state_col in _COUNTS}
    changed = state.join(by_url, "url", "inner").select(*[
        F.greatest(F.lit(0), F.coalesce(F.col(col), F.lit(0)) - F.col("d_" + target[col])).cast("int").alias(col)
        if col in target else F.col(col) for col in SC.URL_STATE.fieldNames()])
    history = changed.withColumn("snapshot_at", F.lit(as_of).cast("timestamp"))
    if limit:
        keys = picked.select("url", "event_date").withColumn("__m", F.lit(True))
        new_counters = counters.join(keys, ["url", "event_date"], "left").withColumn(
            "accounted", F.col("accounted") & F.col("__m").isNull()).drop("__m")
    else:  # the picked rows are those of the predicate: no join
        new_counters = counters.withColumn("accounted", F.when(F.col("event_date") <= cut, False).otherwise(F.col("accounted")))
    here = F.col("__cur").isNotNull()
    totals = tagged.agg(F.count("*").alias("picked"), F.count_if(here).alias("processed"), F.count_if(~here).alias("missing"),
                        F.countDistinct(F.when(here, F.col("url"))).alias("history"), F.count("*").alias("marked"))
    return RolloffOutput(changed, history, new_counters, totals)
