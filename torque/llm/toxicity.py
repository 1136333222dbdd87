"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is a bag of subwords: every white-space token, lower-cased and without
ASCII punctuation at its ends, gives itself and its character n-grams of 3 to 5
with marked ends, hashed into buckets.  The bucket vectors are averaged over
the whole text and go into a two-class softmax; vectors and softmax are trained
jointly in numpy.  A misspelling never seen shares most of its
n-grams with the word it hides.

The model is fitted on a bounded sample of labelled rows (``MAX_POSITIVE`` and
``MAX_NEGATIVE``, the lowest hashes of ``doc_id``, none over ``MAX_CHARS``),
which is the only thing that reaches the driver.  Rows of the held-out third,
``crc32(doc_id) % 3 == 1``, are never drawn.  Scoring reads every whole text;
the model sent to the tasks is one number a bucket (``BUCKETS`` of them).

Edge cases: a null, empty or punctuation-only text has no subwords and the
model's prior as its score; without labels of both classes every score is 0;
labels that are null are not drawn, and a document labelled twice is toxic if
one of its labels says so; a null ``doc_id`` is not held out; repeated rows get
equal scores; an empty table gives an empty one.  Only ``text`` is an input of
a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, mix, prefix_hash, span_hash, text_chunks

#: Bounds of the training sample.
MAX_POSITIVE, MAX_NEGATIVE, MAX_CHARS = 1000, 2000, 200_000
BUCKETS = 1 << 18
DIM, STEPS, RATE, DECAY, GAIN, MIN_DOCS = 2, 100, 0.2, 1e-3, 100.0, 4
GRAMS = (3, 4, 5)
#: Entries of the sample's bags summed at once.
BLOCK = 1 << 19
THRESHOLD = 0.7
CACHE_WORDS = 300_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the third that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, row bounds) of the subwords of each token; none for bare punctuation."""
    plain = [w.strip(PUNCTUATION).decode("utf-8", "replace").lower() for w in words]
    marked = "".join(f"\x02{w}\x03" if w else "" for w in plain)
    lengths = np.array([len(w) + 2 if w else 0 for w in plain], np.int64)
    codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    prefix = prefix_hash(mix((codes + np.uint64(1)) * GOLDEN))
    end = np.cumsum(lengths)
    start = end - lengths
    rows, hashes = [np.flatnonzero(lengths)], [span_hash(prefix, start[lengths > 0], end[lengths > 0])]
    row = np.repeat(np.arange(len(plain)), lengths)
    at = np.arange(len(codes))
    for n in GRAMS:
        ok = (at + n <= end[row]) & (lengths[row] != n) if len(at) else np.zeros(0, bool)
        rows.append(row[ok])
        hashes.append(span_hash(prefix, at[ok], at[ok] + n))
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.argsort(rows, kind="stable")
    bounds = np.searchsorted(rows[order], np.arange(len(plain) + 1))
    return (hashes[order] % np.uint64(BUCKETS)).astype(np.int64), bounds


def _row_sums(columns: np.ndarray, at: np.ndarray, weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of columns[at] * weight over bounds[i]:bounds[i + 1], some entries at a time."""
    out = np.zeros((len(bounds) - 1, columns.shape[1]), np.float32)
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BLOCK, "right")) - 1)
        a, b = bounds[lo], bounds[hi]
        if b > a:
            some = np.flatnonzero(bounds[lo + 1:hi + 1] > bounds[lo:hi])
            out[lo + some] = np.add.reduceat(columns[at[a:b]] * weight[a:b, None], bounds[lo + some] - a, axis=0)
        lo = hi
    return out


def _bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, share, bounds): the subword bag of each text, shares adding up to 1."""
    known: dict[bytes, int] = {}
    counted = [np.unique(np.array([known.setdefault(w, len(known)) for w in tokens(t)], np.int64), return_counts=True)
               for t in texts]
    names, parts, sizes = list(known), [], []
    for lo in range(0, len(names), 20_000):         # a slice at a time: the n-grams of all take much memory
        found, ends = subwords(names[lo:lo + 20_000])
        parts.append(found.astype(np.int32))
        sizes.append(np.diff(ends))
    bucket = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    sub = np.r_[0, np.cumsum(np.concatenate(sizes))] if sizes else np.zeros(1, np.int64)
    ids, shares = [], []
    for words, n in counted:
        per = sub[words + 1] - sub[words]
        total = max(1, int((n * per).sum()))
        at = np.repeat(sub[words] - np.r_[0, np.cumsum(per)[:-1]] if len(words) else per, per) + np.arange(per.sum())
        b, back = np.unique(bucket[at], return_inverse=True)
        ids.append(b.astype(np.int32))
        shares.append((np.bincount(back, np.repeat(n, per), len(b)) / total).astype(np.float32))
    return np.concatenate(ids), np.concatenate(shares), np.cumsum([0] + [len(b) for b in ids])


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float] | None:
    """(weight of each bucket, bias) of the log-odds; None without both classes.

    Subwords of fewer than ``MIN_DOCS`` sampled texts are left at zero: they
    could only learn those texts by heart.  A vector's gradient is divided by the
    root of its subword's mean share, which holds back words that every text has;
    beyond that all take steps of one common scale, so that what many toxic texts
    share grows first.  The softmax takes Adam steps."""
    if len(set(labels.tolist())) < 2:
        return None
    bucket, share, bounds = _bags(texts)
    used = np.flatnonzero(np.bincount(bucket, minlength=BUCKETS) >= MIN_DOCS)
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    keep = place[bucket] >= 0
    bounds = np.r_[0, np.cumsum(keep)][bounds]
    bucket, share = place[bucket[keep]], share[keep]
    scale = np.sqrt(np.bincount(bucket, share, len(used)) / len(texts)).astype(np.float32)[:, None]
    order = np.argsort(bucket, kind="stable")
    doc_back = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))[order]
    share_back = share[order]
    back = np.r_[0, np.cumsum(np.bincount(bucket, minlength=len(used)))]
    del keep, order
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.001, (len(used), DIM)).astype(np.float32)
    out = rng.normal(0, 1.0, (DIM, 2)).astype(np.float32)
    bias = np.log(np.bincount(labels, minlength=2) / len(labels)).astype(np.float32)
    hot = np.eye(2, dtype=np.float32)[labels]
    speed = np.zeros_like(vectors)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (out, bias)]
    for step in range(1, STEPS + 1):
        h = GAIN * _row_sums(vectors, bucket, share, bounds)
        z = h @ out + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        dz = ((p - hot) / len(labels)).astype(np.float32)
        if len(used):
            d = _row_sums(GAIN * dz @ out.T, doc_back, share_back, back) / scale
            speed = 0.8 * speed + d / max(1e-12, float(np.abs(d).max()))
            vectors = (1 - DECAY) * vectors - RATE * (1 - 0.9 * step / STEPS) * speed
        for param, grad, (m, v) in zip((out, bias), (h.T @ dz, dz.sum(axis=0)), state, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= 0.02 * (m / (1 - 0.9 ** step) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8))
    weight = np.zeros(BUCKETS, np.float32)
    weight[used] = GAIN * vectors @ (out[:, 1] - out[:, 0])
    return weight, float(bias[1] - bias[0])


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray, float]:
    """The bounded training sample: whole texts, their labels, and what the log-odds of
    its classes lack to those of all labels outside the held-out third."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # Drawn from the labels of documents that are at hand and can be learnt from.
    usable = docs.filter(F.length("text") <= MAX_CHARS).select("doc_id").distinct()
    at_hand, drawn = known.join(usable, "doc_id", "left_semi"), None
    for label, most in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE)):
        part = at_hand.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    # MAX_POSITIVE + MAX_NEGATIVE rows of two numbers at most: a proven bound.
    rows = (docs.filter(F.length("text") <= MAX_CHARS).select("doc_id", "text")
            .join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "toxic")
            .dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    labels = np.array([r["toxic"] for r in rows], np.int64)
    counts = {r["toxic"]: r["count"] for r in known.filter("toxic in (0, 1)").groupBy("toxic").count().collect()}
    drawn_1, drawn_0 = int(labels.sum()), int((labels == 0).sum())
    lacking = (np.log(counts[1] / counts[0]) - np.log(drawn_1 / drawn_0)) if drawn_1 and drawn_0 else 0.0
    return [r["text"].encode() for r in rows], labels, float(lacking)


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*kept).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
    weight, bias = spark.sparkContext.broadcast(model[0]), model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, known = weight.value.astype(np.float64), {}
        for part, data, at in text_chunks(batches):
            if len(known) > CACHE_WORDS:
                known = {}
            raw = data.tobytes()
            bags = [tokens(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            new = list({w for bag in bags for w in bag} - known.keys())
            bucket, bounds = subwords(new)
            total = np.r_[0, np.cumsum(v[bucket])]
            known |= zip(new, zip((total[bounds[1:]] - total[bounds[:-1]]).tolist(), np.diff(bounds).tolist(),
                                  strict=True), strict=True)
            logit = []
            for bag in bags:
                pairs = [known[w] for w in bag]
                n = sum([p[1] for p in pairs])
                logit.append(sum([p[0] for p in pairs]) / n + bias if n else bias)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(1 / (1 + np.exp(-np.clip(logit, -60, 60))))], [*part.schema.names, "score"])

    schema = docs.select(*kept).schema.add("score", "double")
    return (docs.select(*kept).mapInArrow(run, schema)
            .withColumn("predicted", (F.col("score") >= F.lit(THRESHOLD)).cast("int")))


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    texts, marks, lacking = sample(docs, labels)
    model = fit(texts, marks)
    return None if model is None else (model[0], model[1] + lacking)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    return score(docs.select("doc_id", "text"), train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns unchanged."""
    scored = score(docs.select(F.struct(*docs.columns).alias("row"), "text"), train(docs, labels))
    return scored.filter("predicted = 0").select("row.*")
