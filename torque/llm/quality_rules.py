"""Quality rules: hashed n-gram log-likelihood ratio, DataFrame functions only.

Words and word pairs of every text are hashed into ``BUCKETS`` buckets.  Two
multinomials with the same smoothing are counted over all documents: one of the
trusted target (documents labelled of good quality), one of the raw corpus.  A
document's score is the mean, over its n-grams, of the log of the two
probabilities' ratio, so long and short texts compare; it is kept if the score
is at least ``THRESHOLD`` and the base rules pass.  Nothing is drawn at random.

Counting explodes n-grams into a grouped sum (combined map-side: a hot word is
one row a task and bucket), and the weights are one array of ``BUCKETS``
numbers, read through a scalar subquery.  No Python runs on the executors.

Edge cases: a null, empty or white-space text has no words and fails the base
rules; its score is 0.  Without any trusted document all scores are 0 and the
base rules decide alone.  Repeated rows get equal results and count as often as
they stand there; a document labelled twice is trusted if one label says so; a
null ``doc_id`` is not trusted; an empty table gives an empty one; columns
beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, stage

BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.1
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def with_words(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text, words) and ``more``; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), *more).withColumn(
        "words", F.array_remove(F.split("text", "[ \\t-\\r]+"), ""))


def _windows(n: int, hashed) -> Column:
    """One value for each run of n words."""
    last = F.size("words") - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), hashed)).otherwise(
        F.array().cast("array<bigint>"))


def _ngrams() -> Column:
    """Bucket numbers of all words and word pairs."""
    def bucket(*w: Column) -> Column:
        return F.pmod(F.xxhash64(*w), F.lit(BUCKETS))

    pairs = _windows(2, lambda i: bucket(F.col("words")[i], F.col("words")[i + 1]))
    return F.concat(F.transform("words", lambda w: bucket(w)), pairs)


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, one array: the log of the probabilities' ratio of each bucket."""
    trusted = (labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
               .select("doc_id").distinct().withColumn("is_target", F.lit(1)))
    both = docs.select("doc_id", "text").join(broadcast_if_small(trusted), "doc_id", "left")
    counts = (with_words(both, "is_target").select("is_target", F.explode(_ngrams()).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("is_target").alias("target")))
    # At most BUCKETS rows from here on, written once: three readers follow.
    counts = stage(counts, "quality-counts")
    total = counts.agg(F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))

    def log_p(n: Column, of: Column) -> Column:
        return F.log((n + SMOOTHING) / (of + SMOOTHING * BUCKETS))

    filled = (docs.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket")).join(counts, "bucket", "left")
              .select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "target")]))
    n_raw, n_target = total.select("n_raw").scalar(), total.select("n_target").scalar()
    ratio = F.when(n_target > 0, log_p(F.col("target"), n_target) - log_p(F.col("raw"), n_raw)).otherwise(0.0)
    return (filled.select(F.struct("bucket", ratio.alias("w")).alias("b"))
            .agg(F.transform(F.sort_array(F.collect_list("b")), lambda b: b["w"]).alias("w")))


def _repeats(df: DataFrame) -> DataFrame:
    """``df`` with n_repeat_words: words covered by a 3-word window that stands
    there twice or more.  Only texts with such a window sort their windows."""
    w = F.col("words")
    df = df.withColumn("grams", _windows(3, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    df = df.withColumn("ordered", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    o = F.col("ordered")

    def repeated(x: Column, i: Column) -> Column:
        return ((i > 0) & (F.get(o, i - 1)["g"] == x["g"])) | F.coalesce(F.get(o, i + 1)["g"] == x["g"], F.lit(False))

    df = df.withColumn("starts", F.sort_array(F.transform(F.filter(o, repeated), lambda x: x["i"])))
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(3), s - acc["last"])).alias("n"), s.alias("last")),
        lambda acc: acc["n"])
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, score) of every row of ``docs``."""
    weight = weights(docs, labels).scalar()     # one array of BUCKETS numbers, computed once
    lines = F.filter(F.split("text", "\n"), lambda x: _without(x, WHITE) != "")
    df = _repeats(with_words(docs)).withColumn("lines", lines).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
    # Used once each and apart from what is used twice, n-grams and weights stay
    # inside one expression: no row carries the array of weights.
    df = df.withColumn("weight", weight)
    n = F.size("words") + F.greatest(F.size("words") - 1, F.lit(0))
    total = F.aggregate(_ngrams(), F.lit(0.0), lambda acc, b: acc + F.get("weight", b.cast("int")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.length(_without(F.col("text"), WHITE)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words", F.when(n > 0, total / n).otherwise(0.0).alias("score"),
    ).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
