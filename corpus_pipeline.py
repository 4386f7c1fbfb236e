"""Corpus pipeline: stages over the documents table, each on what the one before kept.

``STAGES`` lists (name, function) pairs. Each function takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of the documents table."""

from __future__ import annotations

from frontier.llm import bpe, decontaminate, linededup, minhash, toxicity
from frontier.llm.labelled import held_out
from frontier.llm.queries import VOCABULARY, table


def toxic(spark, docs, sf_dir):
    """Documents with a toxicity score of 0.7 or more go. As in the toxicity query, rows with
    crc32(doc_id) mod 3 = 1 are not learned from."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), 0.7, where=~held_out("id", 3, 1))


def lines(spark, docs, sf_dir):
    """Later copies of runs of lines with 50 words or more are cut out of the texts (n_chars
    follows); a document goes when nothing of it is left."""
    return linededup.drop_repeated_runs(docs, size_col="n_chars")


def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays: that with the smallest doc_id."""
    return minhash.drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a whole benchmark window of 10 words go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir):
    """Token ids of what is left, checked by decoding: the result of the pipeline."""
    return bpe.round_trip(docs, VOCABULARY)


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontamination", decontamination), ("bpe", tokens)]
#: The learned toxicity scores can't be written in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
