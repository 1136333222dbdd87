"""The corpus pipeline: stages over ``documents``, each written and read again.

Rows keep the columns of ``documents`` up to the last stage, which gives
``doc_id`` with the piece ids.  A stage takes null and empty texts, repeated
rows, empty tables and further columns as its operator does (see the modules).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from torque.llm import decontamination, line_dedup, sentencepiece_codec, simhash, toxicity
from torque.llm.common import read_table, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the labels of those at hand."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, up to two edits, go from the texts; every document stays."""
    return line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays (the smallest doc_id)."""
    return simhash.keep_one(docs, repeats=False)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether they decode to it."""
    return sentencepiece_codec.encode_checked(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: SQL cannot express the classifier or the fingerprints: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
