"""ST-2 / ST-3: windowed counts whose late rows are data.

The engine's own windowed aggregation (:func:`.jobs.windowed_log_counts`) drops rows behind the
watermark and keeps a number of groups in its progress reports. This job keeps the rows: each
micro-batch splits them off by the watermark it starts with, adds the others to the open windows,
and writes the windows that its own rows make final. Open windows are a small versioned table (as
many as the watermark leaves open, times the keys), the watermark is written with the batch, last,
so a batch that is run again does the same. Rows in = rows of final windows + of open ones + late.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources import files, store


def _mark(spark: SparkSession, root: str, version: int) -> datetime | None:
    if not version:
        return None
    at = files.get_json(spark, f"{root}/_marks/{version}.json")["latest"]
    return None if at is None else datetime.fromisoformat(at)


def window_micro_batch(spark: SparkSession, out_root: str, rows: DataFrame, batch_id: int, width: str, late: timedelta, by: str) -> None:
    """One micro-batch: open windows ``open/v=<batch_id>`` in; ``late/batch=``, ``final/batch=`` and the next open ones out."""
    root, version = out_root.rstrip("/"), batch_id + 1
    if store.exists(spark, f"{root}/_marks/{version}.json"):
        return
    rows = cut_lineage(rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("w", F.window("ts", width)))
    before = _mark(spark, root, batch_id)
    newest = rows.agg(F.max("ts").cast("double")).first()[0]
    latest = max(x for x in (before, newest and datetime.fromtimestamp(newest, timezone.utc)) if x) if before or newest else None
    behind = lambda end, at: F.coalesce(end <= F.lit(at.isoformat()).cast("timestamp"), F.lit(False)) if at else F.lit(False)
    is_late = behind(F.col("w.end"), before and before - late)
    rows.where(is_late).withColumn("window_start", F.col("w.start")).drop("w").write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
    counts = rows.where(~is_late).groupBy(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by).agg(F.count("*").alias("n"))
    if batch_id:
        counts = counts.unionByName(spark.read.schema(counts.schema).parquet(f"{root}/open/v={batch_id}"))
    counts = cut_lineage(counts.groupBy("window_start", "window_end", by).agg(F.sum("n").alias("n")))
    done = behind(F.col("window_end"), latest and latest - late)
    counts.where(done).write.mode("overwrite").parquet(f"{root}/final/batch={batch_id}")
    counts.where(~done).write.mode("overwrite").parquet(f"{root}/open/v={version}")
    files.put_json(spark, f"{root}/_marks/{version}.json", {"latest": latest and latest.isoformat()})


def start_windows(rows: DataFrame, out_root: str, checkpoint: str, width: str = "10 minutes", late: timedelta = timedelta(minutes=20), by: str = "worker_id"):
    """Windowed counts of a stream (with ``ts``) under ``out_root``: ``final``, ``late`` and ``open`` (see :func:`read_windows`)."""
    return (rows.writeStream.foreachBatch(lambda b, i: window_micro_batch(b.sparkSession, out_root, b, i, width, late, by))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_windows(spark: SparkSession, out_root: str, part: str) -> DataFrame:
    """The ``final`` windows, the ``late`` rows or the ``open`` windows of all whole batches."""
    root = out_root.rstrip("/")
    marks = [int(n.removesuffix(".json")) for n, _ in files.names(spark, f"{root}/_marks") if not n.startswith("_")]
    if part == "open":
        return spark.read.parquet(f"{root}/open/v={max(marks)}")
    return spark.read.parquet(f"{root}/{part}").where(F.col("batch") < max(marks)).drop("batch")
