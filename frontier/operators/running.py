"""Running aggregates per key, in the order of a column, that don't depend on any key being
small: the rows are dealt by range of (key, order), so a key with a third of them covers
several blocks; every block runs on its own, and what comes before it in the same key is
carried over from the summaries of earlier blocks. Only keys that cover more than one block
have summaries, two a block at most."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``sum`` (nulls count nothing), ``last`` (last value that isn't
    null) or ``first`` (value of the first row, null or not), up to the row or, with
    ``before``, up to the row before it."""

    name: str
    kind: str
    value: Column
    before: bool = False


def in_blocks(df: DataFrame, key: str, order: str, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """``df`` with ``__block``: ranges of (key, order), in that order. The rows are written (by
    ``keep``), as the blocks must stay what they are while they are read more than once."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return keep(df.repartitionByRange(parts, key, order).withColumn("__block", F.spark_partition_id()))


def run(df: DataFrame, key: str, order: str, aggregates: list[Running]) -> DataFrame:
    """``df`` (from :func:`in_blocks`) with a column for every aggregate, ``__rn`` (place of the
    row in its key, from 1) and ``__final`` (whether it is the last)."""
    aggregates = [Running("__rn", "sum", F.lit(1)), *aggregates]
    inside = Window.partitionBy("__block", key).orderBy(order)
    edges = df.groupBy(key).agg(F.min("__block").alias("__lo"), F.max("__block").alias("__hi")).where("__lo < __hi")
    wide = df.join(edges, key)
    summary = []
    for a in aggregates:
        if a.kind == "sum":
            summary.append(F.sum(a.value).alias(f"s_{a.name}"))
        else:
            pick, rows = (F.max, a.value.isNotNull()) if a.kind == "last" else (F.min, F.lit(True))
            summary.append(pick(F.when(rows, F.struct(F.col(order).alias("o"), a.value.alias("v"))))["v"].alias(f"s_{a.name}"))
    blocks = wide.groupBy(key, "__block", "__hi").agg(*summary)
    earlier = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = {"sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True), "first": F.first}
    carry = blocks.select(F.col(key).alias("__key"), F.col("__block").alias("__b"), F.col("__hi"), F.count("*").over(earlier).alias("__earlier"),
                          *[carried[a.kind](f"s_{a.name}").over(earlier).alias(f"c_{a.name}") for a in aggregates])
    rows = df.join(carry, (F.col(key) == F.col("__key")) & (F.col("__block") == F.col("__b")), "left")
    out = []
    for a in aggregates:
        frame = inside.rowsBetween(Window.unboundedPreceding, -1 if a.before else Window.currentRow)
        own = carried[a.kind](a.value).over(frame)
        if a.kind == "sum":
            out.append((F.coalesce(own, F.lit(0)) + F.coalesce(F.col(f"c_{a.name}"), F.lit(0))).alias(a.name))
        elif a.kind == "last":
            out.append(F.coalesce(own, F.col(f"c_{a.name}")).alias(a.name))
        else:
            out.append(F.when(F.coalesce(F.col("__earlier"), F.lit(0)) > 0, F.col(f"c_{a.name}")).otherwise(own).alias(a.name))
    final = F.lead(F.lit(1)).over(inside).isNull() & (F.col("__block") == F.coalesce("__hi", "__block"))
    return rows.select(*df.columns, *out, final.alias("__final"))
