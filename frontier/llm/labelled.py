"""Bounded, deterministic samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str, parts: int, part: int):
    """Whether crc32 of the id as text, modulo ``parts``, is ``part``; a null id never is."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def smallest(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """The ``bound`` rows with the smallest hash of ``key`` (a column without repeats). Rows that
    can't be among them are left out by their hash before any ordering, so that what meets in
    one task follows the bound and not the table."""
    n = rows.count()
    if n > 4 * bound:
        low = rows.where(F.xxhash64(key) < -(1 << 63) + (1 << 64) * 2 * bound // n)
        if low.count() >= bound:
            rows = low
    return rows.orderBy(F.xxhash64(key), key).limit(bound)


def sample(labels: DataFrame, id_col: str, label_col: str, bound: int, where=None) -> DataFrame:
    """(id, label) of at most ``bound`` labelled rows, those with the smallest hash of their
    id. Rows without id or label don't count; repeated ids take their largest label."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    if where is not None:
        rows = rows.where(where)
    return smallest(rows.groupBy("id").agg(F.max("label").alias("label")), "id", bound)


def one_text(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(id, label, text) of the sampled rows ``chosen`` (id, label), one for each id that is in
    ``docs`` (id, text): of several texts, that with the smallest hash. A sampled id may hold any
    share of ``docs``; its rows are reduced in every task before they meet."""
    texts = docs.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("t"))
    return texts.select("id", "label", "t.text")
