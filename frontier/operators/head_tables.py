"""Scoring heads as tables: vocabulary, IDF, weights and scalers are DataFrames.

A head exported from anywhere (its gram weights, the scaler of the 40 numbers, its intercept) is
applied by summing over the character n-grams of the URLs; all heads share the vectoriser, so the
grams are found once (:mod:`.grams`). The vocabulary is broadcast while it has at most
``MAX_BROADCAST_GRAMS`` grams, and then the rows aren't shuffled. A larger one is joined: URLs are
dealt out once, by URL, and give a row for each of their grams."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .grams import GramTree, gram_counts, texts_of, url_grams
from .score import HEAD_NAMES

MAX_BROADCAST_GRAMS = 1 << 20


@dataclass
class HeadTables:
    """``grams``: gram, idf. ``weights``: head, gram, weight. ``heads``: head, intercept and, for the
    numbers in their order, ``means``, ``scales`` and ``number_weights`` (arrays, or null)."""

    grams: DataFrame
    weights: DataFrame
    heads: DataFrame
    sizes: tuple[int, ...] = (3, 4, 5)
    unit: bool = True

    def score(self, urls: DataFrame, features: str | None = "features", out: str = "url_score") -> DataFrame:
        """``urls`` (``url`` and, if heads use them, the numbers) with the largest probability of
        the heads. A URL without a known gram has its numbers and the intercepts alone; repeated
        URLs are worked out once."""
        heads = sorted(self.heads.collect(), key=lambda r: r["head"])   # a handful of rows of 40 numbers
        unknown = sorted({r["head"] for r in heads} - set(HEAD_NAMES))
        if unknown or not heads:
            raise ValueError(f"unknown heads {unknown}" if unknown else "no scoring heads")
        ship_package(urls.sparkSession)
        of = lambda r: f"__w_{r['head']}"
        weights = self.weights.groupBy("gram").agg(*[F.sum(F.when(F.col("head") == r["head"], F.col("weight"))).alias(of(r)) for r in heads])
        weight = lambda r: F.coalesce(F.col(of(r)), F.lit(0.0))
        vocabulary = (self.grams.where("gram IS NOT NULL AND idf IS NOT NULL").join(weights, "gram", "left").groupBy(F.col("gram").alias("__gram"))
                      .agg(F.sum(F.col("idf") * F.col("idf")).alias("__square"), *[F.sum(F.col("idf") * weight(r)).alias(of(r)) for r in heads]))
        if self.grams.count() <= MAX_BROADCAST_GRAMS:
            rows = urls.withColumn("__sums", _sums(vocabulary, self.sizes)(F.lower("url")))
            rows = rows.select(*urls.columns, F.col("__sums")[0].alias("__norm"), *[F.col("__sums")[k].alias(of(r)) for k, r in enumerate(heads, 1)])
        else:
            sizes = self.sizes
            counts = (urls.select(F.col("url").alias("__url")).distinct().repartition("__url").select("__url", F.lower("__url").alias("__low"))
                      .mapInArrow(lambda batches: url_grams(batches, sizes), "__url string, __gram string, __tf bigint"))
            sums = counts.join(vocabulary, "__gram").groupBy("__url").agg(
                F.sqrt(F.sum(F.col("__tf") * F.col("__tf") * F.col("__square"))).alias("__norm"), *[F.sum(F.col("__tf") * F.col(of(r))).alias(of(r)) for r in heads])
            rows = urls.join(sums, urls["url"] == sums["__url"], "left").drop("__url")
        best = []
        for r in heads:
            z = F.coalesce(F.col(of(r)) / (F.col("__norm") if self.unit else F.lit(1.0)), F.lit(0.0)) + F.lit(float(r["intercept"]))
            if r["number_weights"] is not None:
                for k, (mean, scale, weight) in enumerate(zip(r["means"], r["scales"], r["number_weights"], strict=True)):
                    z = z + (F.col(features)[k] - mean) / (scale or 1.0) * weight
            best.append(1 / (1 + F.exp(-z)))
        return rows.select(*urls.columns, (F.greatest(*best) if len(best) > 1 else best[0]).alias(out))


def _sums(vocabulary: DataFrame, sizes: tuple[int, ...]):
    """Column function of lower-cased URLs: the norm and the sum of each head; null without a known gram."""
    table = vocabulary.toArrow()   # at most MAX_BROADCAST_GRAMS rows
    numbers = np.column_stack([table.column(k).to_numpy().astype(float) for k in range(1, table.num_columns)])
    shared = vocabulary.sparkSession.sparkContext.broadcast((GramTree(table.column(0).to_pylist()), numbers))

    @F.arrow_udf("array<double>")
    def sums(low: pa.Array) -> pa.Array:
        tree, of = shared.value
        parts = []
        for n, text in texts_of(low):
            row, known, tf = tree.counts(text, sizes)
            total = [np.bincount(row, tf * tf * of[known, 0], n), *(np.bincount(row, tf * of[known, k], n) for k in range(1, of.shape[1]))]
            total[0] = np.sqrt(total[0])
            missing = np.bincount(row, minlength=n) == 0
            ends = np.concatenate([[0], np.cumsum(np.where(missing, 0, of.shape[1]))]).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(ends, np.column_stack(total)[~missing].ravel(), mask=pa.array(missing)))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))

    return sums


def learn_by_counts(rows: DataFrame, labels: Mapping[str, str], sizes: tuple[int, ...] = (3, 4, 5), least: int = 1) -> HeadTables:
    """Head tables from ``rows`` (``url`` and a 0/1 label column for each head in ``labels``; one row
    for each URL) by counting: a gram's weight is the log ratio of the shares of the head's positive
    and negative URLs that have it, with one added to either side (naive Bayes). Grams of
    fewer than ``least`` URLs are left out."""
    of = {h: F.col(c) == 1 for h, c in labels.items()}
    n = rows.agg(F.count("*").alias("n"), *[F.count_if(p).alias(h) for h, p in of.items()]).first().asDict()
    spark = rows.sparkSession
    ship_package(spark)
    names = [f"__n_{h}" for h in of]
    have = (rows.select(F.lower("url").alias("__low"), *[F.coalesce(p, F.lit(False)).alias(f"__y_{h}") for h, p in of.items()])
            .mapInArrow(lambda batches: gram_counts(batches, sizes, names), f"gram string, df bigint, {', '.join(f'{c} bigint' for c in names)}")
            .groupBy("gram").agg(F.sum("df").alias("df"), *[F.sum(c).alias(c) for c in names]).where(F.col("df") >= least))
    grams = have.select("gram", (F.log((1.0 + n["n"]) / (1 + F.col("df"))) + 1).alias("idf"))
    has = lambda h: F.col(f"__n_{h}")
    ratio = lambda h: F.log((has(h) + 1) / (n[h] + 2.0)) - F.log((F.col("df") - has(h) + 1) / (n["n"] - n[h] + 2.0))
    weights = have.select("gram", F.explode(F.array(*[F.struct(F.lit(h).alias("head"), ratio(h).alias("weight")) for h in of])).alias("w")).select("w.head", "gram", "w.weight")
    heads = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(h).alias("head"), F.log(F.lit((n[h] + 1.0) / (n["n"] - n[h] + 1.0))).alias("intercept")) for h in of])).alias("h")).select(
        "h.*", *[F.lit(None).cast("array<double>").alias(c) for c in ("means", "scales", "number_weights")])
    return HeadTables(grams, weights, heads, sizes)
