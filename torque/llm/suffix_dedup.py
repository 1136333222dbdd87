"""Exact substring dedup: every byte under a 400-byte string that stands elsewhere too.

Prefix-free parsing in Spark's terms.  Rolling-hash triggers (the least of the
201 hashes of 200-byte grams in a 400-byte window) cut each text into phrases:
a phrase is the run of neighbouring windows that one trigger governs, with the
bytes under them.  Equal windows have equal triggers wherever they stand, so

1. triggers are counted over the corpus; a trigger that stands at one place
   only governs no repeated window (one row a phrase, combined map-side);
2. for the others, the dictionary counts distinct phrases.  All windows of a
   phrase that stands at two places are repeated: a passage that a third of the
   corpus shares is a few phrases here, each counted once a task;
3. phrases whose trigger recurs but that differ around it are told apart by
   suffix arrays.  Distinct phrases are dealt by trigger to shards of bounded
   size.  A shard sorts the parts of its phrases before the trigger (read
   backwards: the dictionary's suffixes) and those from the trigger on (the
   parse), and notes how far neighbours agree.  A window that begins x bytes
   before the trigger then has a place in corpus order given by two numbers: its
   class in the first array at depth x, and its class in the second at depth
   400 - x.  Windows are equal, byte for byte, if both are;
4. a trigger with more distinct phrases than a shard may hold is not collected:
   the windows of its phrases are counted by 64-bit hashes, combined map-side.

Phrases are equal by a 64-bit rolling hash (step 2); with n of them compared, the
chance that any two collide is about n**2 / 2**65.

Edge cases: a null text is empty; a text of fewer than 400 bytes loses nothing;
a repeated row (same id and text) is the same document, so it does not repeat
itself, and equal texts under different ids do; rows with a null ``doc_id``
and equal texts are one document; an empty table gives an empty one; other
columns are ignored.  Matches lie inside one document and may cut a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, broadcast_if_small, prefix_hash, stage, text_chunks
from .windows import anchored_runs, covered, keyed, sha256, split_by_key, window_hashes

LENGTH, GRAM = 400, 200
#: Text bytes that a kernel works on at once; its hashes take some ten times as much.
CHUNK = 1 << 18
#: Distinct phrases that a shard of suffix arrays holds on average, and that one trigger may bring to it.
SHARD, HOT = 20_000, 20_000
_RUN = "key bigint, lo int, hi int, at int, core bigint, full bigint"


def _prefix(data: np.ndarray) -> np.ndarray:
    return prefix_hash(BYTE_CODES[data])


def _phrases(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            text, lo, hi, core, full, place = anchored_runs(_prefix(data), at, length, gram)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                 pa.array((place - at[text] - lo).astype(np.int32)), pa.array(core), pa.array(full)],
                ["key", "lo", "hi", "at", "core", "full"])
    return run


def _lists(column: pa.Array, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(row ends, one array a field) of an array<struct> column."""
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(ends[0], ends[-1] - ends[0])
    return ends - ends[0], [values.field(values.type.get_field_index(f)).to_numpy(zero_copy_only=False)
                            for f in fields]


def _contexts(length: int):
    """(key, runs, text) -> the bytes of each run, with the place of its trigger in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            ends, (lo, hi, place, heavy, core) = _lists(part.column(2), ("lo", "hi", "at", "heavy", "core"))
            owner, raw = np.repeat(np.arange(part.num_rows), np.diff(ends)), data.tobytes()
            begin = at[owner] + lo
            cut = [raw[a:b] for a, b in zip(begin.tolist(), (at[owner] + hi + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(core), part.column(0).take(pa.array(owner)), pa.array(lo), pa.array(place), pa.array(heavy),
                 pa.array(cut, pa.binary())], ["core", "key", "lo", "at", "heavy", "bytes"])
    return run


_CONTEXT = "core bigint, key bigint, lo int, at int, heavy boolean, bytes binary"


def _sorted_agreement(core: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of texts of each trigger: (their order, how many bytes each agrees
    on with the one before it in that order; -1 across triggers)."""
    order = np.array(sorted(range(len(texts)), key=lambda i: (core[i], texts[i])), np.int64)
    size = np.array([len(t) for t in texts], np.int64)
    width = int(size.max(initial=0)) + 1
    agree = np.zeros(len(texts), np.int64)
    step = max(2, (1 << 24) // width)
    for lo in range(0, len(texts), step - 1):           # neighbouring pieces share a row
        some = order[lo:lo + step]
        box = np.zeros((len(some), width), np.uint16)   # 0: beyond the text
        flat = np.frombuffer(b"".join([texts[i] for i in some.tolist()]), np.uint8).astype(np.uint16) + 1
        box[np.arange(width) < size[some][:, None]] = flat
        same = box[1:] == box[:-1]
        same[:, -1] = False
        agree[lo + 1:lo + len(some)] = np.minimum(same.argmin(1), np.minimum(size[some][1:], size[some][:-1]))
    changed = core[order][1:] != core[order][:-1]
    agree[1:][changed] = -1
    agree[:1] = -1
    return order, agree


def _classes(order: np.ndarray, agree: np.ndarray, depth: int) -> np.ndarray:
    """The class of each text at a depth: texts that agree on so many bytes are neighbours."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(agree < depth)
    return out


def repeated_windows(core: np.ndarray, texts: list[bytes], at: np.ndarray, heavy: np.ndarray, length: int) -> np.ndarray:
    """(phrases, most windows): whether the window at each place of each phrase is repeated.
    A phrase has a window for every place at which ``length`` bytes begin."""
    windows = np.array([len(t) for t in texts], np.int64) - length + 1
    out = np.zeros((len(texts), int(windows.max(initial=0))), bool)
    before = _sorted_agreement(core, [t[:a][::-1] for t, a in zip(texts, at.tolist(), strict=True)])
    onward = _sorted_agreement(core, [t[a:] for t, a in zip(texts, at.tolist(), strict=True)])
    for x in range(int(at.max(initial=-1)) + 1):
        place = at - x                                  # the window that begins x bytes before the trigger
        some = np.flatnonzero((place >= 0) & (place < windows))
        if len(some) < 2:
            continue
        code = _classes(*before, x)[some] * np.int64(len(texts) + 1) + _classes(*onward, length - x)[some]
        _, back, n = np.unique(code, return_inverse=True, return_counts=True)
        weight = n + np.bincount(back, heavy[some], len(n))
        out[some, place[some]] = weight[back] > 1
    return out


def _suffix_arrays(length: int):
    """The phrases of a shard -> byte ranges [a, b) under repeated windows, one a run of them."""
    def run(shard: pa.Table) -> pa.Table:
        core, at, lo = (shard.column(c).to_numpy() for c in ("core", "at", "lo"))
        heavy = shard.column("heavy").to_numpy(zero_copy_only=False)
        hit = repeated_windows(core, shard.column("bytes").to_pylist(), at.astype(np.int64), heavy, length)
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1]
        return pa.table({"key": shard.column("key").take(pa.array(row)), "a": pa.array((lo[row] + first).astype(np.int32)),
                         "b": pa.array((lo[row] + last - 1 + length).astype(np.int32))})
    return run


def _open(length: int):
    """(key, runs, text) -> a row for each window of the runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            ends, (lo, hi, heavy) = _lists(part.column(2), ("lo", "hi", "heavy"))
            owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
            p, h = window_hashes(_prefix(data), lo + at[owner], hi + at[owner], length)
            n = hi - lo + 1
            row = np.repeat(owner, n)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array((p - at[row]).astype(np.int32)), pa.array(h),
                 pa.array(np.repeat(heavy, n))], ["key", "pos", "window", "heavy"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> the result row; spans may overlap."""
    for part, data, at in text_chunks(batches, max_bytes=CHUNK):
        ends, (a, b) = _lists(part.column(2), ("a", "b"))
        owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
        gone = covered(a + at[owner], b + at[owner], len(data))
        before = np.r_[False, gone[:-1]]
        before[at[:-1][at[:-1] < len(data)]] = False        # a run ends with its text
        opens = np.r_[0, np.cumsum(gone & ~before)]
        total, kept = np.r_[0, np.cumsum(gone)], ~gone
        digest = [sha256([data[x:y][kept[x:y]].tobytes()]) for x, y in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(at)), pa.array(np.diff(total[at])), pa.array(np.diff(opens[at])),
             pa.array(digest)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(key, spans): byte ranges [a, b), overlapping, whose union is what is covered by
    repeated ``length``-byte strings, for the documents of :func:`windows.keyed` that have any."""
    phrases = docs.select("key", "text").mapInArrow(_phrases(length, gram), _RUN)
    place = F.xxhash64("key", "lo").alias("place")
    triggers = (phrases.select("core", "full", place).groupBy("core")
                .agg(F.min("place").alias("p0"), F.max("place").alias("p1"),
                     F.min("full").alias("f0"), F.max("full").alias("f1"))
                .filter("p0 <> p1").select("core", F.expr("f0 <> f1").alias("mixed")))
    triggers = stage(triggers, "suffix-triggers")
    found = stage(phrases.join(triggers, "core").select("key", "lo", "hi", "at", "core", "full", "mixed"), "suffix-phrases")
    mixed = found.filter("mixed").select("key", "lo", "hi", "at", "core", "full", place)
    dictionary = stage(mixed.groupBy("full").agg(F.min("place").alias("p0"), F.max("place").alias("p1")),
                       "suffix-dictionary")
    known = stage(mixed.join(dictionary, "full").select(
        "key", "lo", "hi", "at", "core", F.expr("p0 <> p1").alias("heavy"), F.expr("place = p0").alias("first")), "suffix-known")
    # One place of each distinct phrase is opened; it weighs as two if the phrase has more.
    distinct = known.filter("first").drop("first")
    crowded = distinct.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("core")
    crowded = broadcast_if_small(stage(crowded, "suffix-crowded"))
    texts = docs.select("key", "text")

    def opened(rows: DataFrame, name: str) -> DataFrame:
        runs = rows.groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "at", "heavy", "core")).alias("runs"))
        return split_by_key(texts, stage(runs, name))[0].select("key", "text", "runs")

    whole = found.filter("not mixed").select("key", "lo", "hi").union(known.filter("heavy").select("key", "lo", "hi"))
    return (whole.select("key", F.col("lo").alias("a"), (F.col("hi") + length).alias("b"))
            .unionByName(_by_suffix_arrays(opened(distinct.join(crowded, "core", "left_anti"), "suffix-opened"), distinct, length, shard))
            .unionByName(_by_windows(opened(distinct.join(crowded, "core", "left_semi"), "suffix-crowded-opened"), length))
            .groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans")))


def _by_suffix_arrays(opened: DataFrame, distinct: DataFrame, length: int, shard: int) -> DataFrame:
    """(key, a, b): the ranges that shards of suffix arrays find in opened phrases."""
    shards = max(1, -(-distinct.count() // shard))
    contexts = opened.mapInArrow(_contexts(length), _CONTEXT)
    number = F.pmod(F.xxhash64("core"), F.lit(shards)).alias("shard")
    return contexts.groupBy(number).applyInArrow(_suffix_arrays(length), "key bigint, a int, b int")


def _by_windows(opened: DataFrame, length: int) -> DataFrame:
    """(key, a, b): the repeated windows of opened phrases, by their hashes."""
    windows = stage(opened.mapInArrow(_open(length), "key bigint, pos int, window bigint, heavy boolean"), "suffix-windows")
    at = F.xxhash64("key", "pos").alias("place")
    repeated = (windows.select("window", "heavy", at).groupBy("window")
                .agg(F.min("place").alias("p0"), F.max("place").alias("p1"), F.max("heavy").alias("heavy"))
                .filter("heavy or p0 <> p1").select("window"))
    repeated = stage(repeated, "suffix-repeated")
    return windows.filter("not heavy").join(repeated, "window", "left_semi").select(
        "key", F.col("pos").alias("a"), (F.col("pos") + length).alias("b"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs, "doc_id")
    spans = stage(repeated_spans(rows, length, gram, shard, hot), "suffix-spans")
    hit, clean = split_by_key(rows, spans)
    empty = F.array().cast("array<struct<a:int,b:int>>").alias("spans")
    both = hit.select("doc_id", "text", "spans"), clean.select("doc_id", "text", empty)
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return both[0].mapInArrow(_cut, schema).unionByName(both[1].mapInArrow(_cut, schema))
