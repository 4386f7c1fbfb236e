"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: HotSpot doesn't compile methods above this bytecode size: plans with such methods (scoring has
#: 40 features in a row) run without whole-stage code, operator by operator, which is compiled.
HUGE_METHOD_LIMIT = "8000"


def configure(spark: SparkSession) -> None:
    """What every query sets in the session that it is given."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "frontier") -> SparkSession:
    """Session for tests and the bench.  On a cluster use the cluster's own
    session; every operator only needs UTC time and AQE."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD_LIMIT)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FRONTIER_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/object store) folder there.  Where it is
    unset, a local master (tests, the bench) gets a folder of its own; on a
    cluster that would be a folder that executors don't share, so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="frontier-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df):
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per context), so that jobs
    with Python functions run wherever the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_frontier_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="frontier-code-"), "frontier.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    sc.addPyFile(path)
    sc._frontier_shipped = True
