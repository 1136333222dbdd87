"""Exact dedup: equal texts by 128-bit content hash, bytes compared inside the groups.

DataFrame functions only.

1. Every row becomes one small fingerprint (row number, id, 128-bit hash, digest),
   written once; texts are not shuffled for it.
2. Fingerprints are grouped by hash, combined map-side: a text that a third of all
   rows hold leaves each task as one row.
3. Of the hashes that stand twice or more, the texts themselves are grouped by
   (hash, text).  The grouping compares whole texts, byte by byte, and again sends
   each distinct text once a task.  A hash with two texts is a collision; its rows,
   and only these, are grouped by their texts from then on.
4. Each fingerprint meets the row that stays.  Only hashes of two rows or more are
   joined, broadcast under a counted bound; above it AQE splits a hot hash.

Edge cases: a null text is empty, and all empty texts are equal; texts are equal
when the same after lower-casing A-Z only (``fold=False``: when the same); of equal
texts the row with the largest ``doc_id`` stays (``keep="smallest"``: the smallest);
a null ``doc_id`` comes last in either case; of repeated rows (same id, equal text)
exactly one stays; very long texts are compared whole; an empty table gives an
empty one; other columns are ignored by :func:`exact_dedup` and kept, whatever
their names, by :func:`drop_copies`.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage


def md5_128(text: Column) -> Column:
    """128-bit content hash of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def normalised(fold: bool) -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase) if fold else text


def _staying(rows: DataFrame, keys: list[str], keep: str) -> DataFrame:
    """(keys, keep_id, keep_row, group_size): the row that stays of each group.  The
    aggregates have fixed-width state, so groups are hashed and combined map-side."""
    best, pick = (F.max, F.max_by) if keep == "largest" else (F.min, F.min_by)
    return rows.groupBy(*keys).agg(
        best("doc_id").alias("keep_id"),
        F.coalesce(pick("row", "doc_id"), F.min("row")).alias("keep_row"),
        F.count(F.lit(1)).alias("group_size"))


def _decided(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with its group; rows without one are alone in theirs."""
    large = groups.filter("group_size > 1")
    joined = rows.join(broadcast_if_small(large), keys, "left")
    alone = F.col("keep_row").isNull()
    return joined.select(
        "row", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def _groups(rows: DataFrame, texts: DataFrame, keep: str, content_hash: Callable[[Column], Column]) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) of fingerprints ``rows``
    made from ``texts`` (doc_id, body)."""
    groups = stage(_staying(rows, ["hash"], keep).filter("group_size > 1"), "exact-groups")
    bodies = texts.select(content_hash(F.col("body")).alias("hash"), "body")
    distinct = (bodies.join(broadcast_if_small(groups.select("hash")), "hash", "left_semi")
                .groupBy("hash", "body").agg(F.lit(1).alias("one")))
    collided = stage(distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"),
                     "exact-collided")
    if collided.isEmpty():
        return _decided(rows, groups, ["hash"])
    collided = broadcast_if_small(collided)
    apart = texts.withColumn("hash", content_hash(F.col("body"))).join(collided, "hash", "left_semi")
    apart = stage(_numbered(apart.select("doc_id", "hash", "body")), "exact-apart")
    return (_decided(rows.join(collided, "hash", "left_anti"), groups, ["hash"])
            .unionByName(_decided(apart, _staying(apart, ["hash", "body"], keep), ["hash", "body"])))


def _numbered(texts: DataFrame) -> DataFrame:
    """Row numbers (fixed once the result is written) and digests of rows with a ``body``."""
    return texts.withColumn("digest", F.unhex(F.sha2(F.col("body"), 256))).withColumn(
        "row", F.monotonically_increasing_id())


def exact_dedup(docs: DataFrame, keep: str = "largest", fold: bool = True,
                content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    texts = docs.select("doc_id", normalised(fold).alias("body"))
    rows = stage(_numbered(texts.withColumn("hash", content_hash(F.col("body")))).select(
        "row", "doc_id", "hash", "digest"), "exact-rows")
    return _groups(rows, texts, keep, content_hash).drop("row")


def drop_copies(docs: DataFrame, keep: str = "largest", fold: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged, in all their columns.

    Every row gets a number of its own, written with it, so of repeated rows one stays.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()), "exact-numbered")
    texts = numbered.select(F.col(number).alias("doc_row"), "doc_id", normalised(fold).alias("body"))
    rows = stage(texts.select("doc_row", "doc_id", md5_128(F.col("body")).alias("hash"), "body")
                 .groupBy("hash", "body")
                 .agg((F.max_by if keep == "largest" else F.min_by)("doc_row", "doc_id").alias("by_id"),
                      F.min("doc_row").alias("first"))
                 .select(F.coalesce("by_id", "first").alias(number)), "exact-stay")
    return numbered.join(broadcast_if_small(rows), number, "left_semi").drop(number)
