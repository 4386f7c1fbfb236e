"""Keyed tables whose writes follow the changes (SS-7, UM-8).

A version writes only the rows that it changed, to ``delta/v=<version>``, sorted by shard, hash
bucket and key in a few files, so that a batch costs its URLs and not the shards that they lie
in. Compaction folds the deltas into the base, which is partitioned by shard and hash bucket of
the key, for the buckets that the deltas touch, and is known to readers by a document that is
written last. A read takes, for each key, its row of the newest delta up to the asked version, or
else that of the base; with ``keys`` it opens only the buckets that these keys lie in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from . import files, store

#: Hash buckets of a shard, and most (shard, bucket) pairs that a read names (beyond, it opens all).
BUCKETS, MAX_PAIRS = 64, 1 << 16
#: Rows of a delta file.
DELTA_ROWS = 1 << 20


@dataclass(frozen=True)
class Keyed:
    """A table under ``path``: rows of ``schema`` (with ``shard_id``), one for each value of ``key``;
    the first key column gives the bucket."""

    path: str
    schema: StructType
    key: tuple[str, ...] = ("url",)
    buckets: int = BUCKETS

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key[0])), F.lit(self.buckets)).cast("int")

    def _stored(self) -> StructType:
        return StructType([*self.schema.fields]).add("bucket", IntegerType())

    def versions(self, spark: SparkSession, what: str) -> list[int]:
        if what == "delta":
            return sorted(int(n[2:]) for n, folder in files.names(spark, f"{self.path}/delta") if folder and n.startswith("v="))
        return sorted(int(n.removesuffix(".json")) for n, _ in files.names(spark, f"{self.path}/_compactions") if n.endswith(".json") and not n.startswith("_"))

    def write(self, changed: DataFrame, version: int) -> None:
        """The changed rows as ``version``; writing it again replaces it."""
        rows = changed.select(*self.schema.fieldNames()).withColumn("bucket", self._bucket())
        order = ["shard_id", "bucket", *self.key]
        rows = rows.repartitionByRange(max(1, -(-rows.count() // DELTA_ROWS)), *order).sortWithinPartitions(*order)
        rows.write.mode("overwrite").parquet(f"{self.path}/delta/v={version}")

    def read(self, spark: SparkSession, version: int, keys: DataFrame | None = None) -> DataFrame:
        """The table as of ``version``; with ``keys`` (``shard_id`` and the first key column) the rows of these."""
        names, first = self.schema.fieldNames(), self.key[0]
        base_at = max([c for c in self.versions(spark, "base") if c <= version], default=-1)
        newer = [v for v in self.versions(spark, "delta") if base_at < v <= version]
        pairs = None
        if keys is not None:
            keys = keys.select("shard_id", first).distinct()
            found = keys.select(F.concat_ws(":", "shard_id", self._bucket()).alias("p")).distinct().limit(MAX_PAIRS + 1).collect()
            pairs = [r.p for r in found] if len(found) <= MAX_PAIRS else None

        def asked(df: DataFrame) -> DataFrame:
            if pairs is not None:   # partition columns in the base, row groups of sorted files in a delta
                shards = sorted({int(p.partition(":")[0]) for p in pairs if not p.startswith(":")})
                df = df.where(F.col("shard_id").isin(shards) & F.concat_ws(":", "shard_id", "bucket").isin(pairs)) if pairs else df.where("false")
            return df if keys is None else df.join(keys.select(F.col("shard_id").alias("__s"), F.col(first).alias("__k")),
                                                   (F.col("shard_id") == F.col("__s")) & (F.col(first) == F.col("__k")), "left_semi")

        base = store.read_version(spark, f"{self.path}/base", base_at, self._stored(), ("shard_id", "bucket")) if base_at >= 0 else spark.createDataFrame([], self._stored())
        base = asked(base).select(*names)
        if not newer:
            return base
        deltas = asked(spark.read.schema(StructType([*self._stored().fields]).add("v", IntegerType())).option("basePath", f"{self.path}/delta")
                       .parquet(*[f"{self.path}/delta/v={v}" for v in newer]))
        latest = (deltas.withColumn("__r", F.row_number().over(Window.partitionBy(*self.key).orderBy(F.desc("v")))).where("__r = 1").select(*names))
        if base_at < 0:
            return latest
        return base.join(latest.select(*self.key), list(self.key), "left_anti").select(*names).unionByName(latest)

    def compact(self, spark: SparkSession, version: int) -> None:
        """Folds the deltas up to ``version`` into the base, in the buckets that they touch."""
        base_at = max([c for c in self.versions(spark, "base") if c <= version], default=-1)
        newer = [v for v in self.versions(spark, "delta") if base_at < v <= version]
        if newer:
            touched = spark.read.schema(self._stored()).parquet(*[f"{self.path}/delta/v={v}" for v in newer]).select("shard_id", "bucket").distinct()
            rows = self.read(spark, version).withColumn("bucket", self._bucket())
            if base_at >= 0:
                rows = rows.join(F.broadcast(touched), ["shard_id", "bucket"], "left_semi")
            store.write_version(rows, f"{self.path}/base", version, ("shard_id", "bucket"), self.key[0])
        files.put_json(spark, f"{self.path}/_compactions/{version}.json", {"deltas": newer})
