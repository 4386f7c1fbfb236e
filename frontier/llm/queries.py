"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, htmltext, linededup, minhash, ngrams, quality, rules, sharding, toxicity, trie, warc, whitening
from .labelled import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Production parameters.
SHARDS = [f"shard-{i:03d}" for i in range(128)]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document, by doc_id, over 128 shards."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


@register("op4_decontamination", decontaminate.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in every document."""
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@register("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document and back, as digests."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


@register("op10_minhash", minhash.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents: five-word shingles, similarity 0.75."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op9_line_dedup", linededup.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of lines with 50 words or more that repeat earlier text, deleted."""
    return linededup.report(table(spark, sf_dir, "documents"))


@register("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the learned decision list for every document."""
    docs = table(spark, sf_dir, "documents")
    learned = rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return rules.apply_rules(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows with crc32(doc_id) mod 5 = 0 are never learned from."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), where=~held_out("id", 5, 0))
    return quality.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows with crc32(doc_id) mod 3 = 1 are never learned from."""
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), where=~held_out("id", 3, 1))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


@register("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.fit(pages))


@register("op1_warc")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, taken as a crawler's response records."""
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


@register("op11_prefix_trie", trie.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations, with leaves and savings of their subtrees."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@register("op12_lm_scores")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document; rows with crc32(doc_id) mod 5 = 1 are never learned from."""
    found = ngrams.score(table(spark, sf_dir, "documents"), learn=~held_out("doc_id", 5, 1))
    return found.select("doc_id", held_out("doc_id", 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the 32 leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
