"""Benchmark decontamination by winnowing.

Every window of ``WINDOW`` (10) consecutive words of a benchmark item that also
stands in a document hits the document's words under it.  ``GRAM``-word hashes
are winnowed over ``WINDOW - GRAM + 1`` neighbours: each window of ten words,
in items and documents alike, keeps its least one, so two equal windows share a
kept fingerprint.  Document fingerprints are joined with the items' sorted ones
in numpy, and each hit is extended word by word to both sides as far as a
window that holds it can reach.  An item of fewer than ten words is one window;
its whole hash is looked up among all word runs of its length.

The benchmark is read in passes of about ``PASS_BYTES`` of text, each sent to
the tasks as one index of bounded size; documents are scanned once a pass, and
more than one pass's hits are merged by document.

Edge cases: a null, empty or punctuation-only text has no words, no hits, and
the digest of the empty string; items without words, and items with a null id,
have no windows; items that share an id count once; repeated documents get
equal rows; a null ``doc_id`` stays a row; an empty table of documents gives an
empty one, an empty benchmark no hits; other columns are ignored by
:func:`contamination` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BYTE_CODES, broadcast_if_small, prefix_hash, span_hash, stage, text_chunks, window_anchors,
                     words)

WINDOW, GRAM = 10, 5
PASS_BYTES = 8 << 20
#: Pairs of a document's and an item's place extended at once.
BLOCK = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of the lower-cased words of some texts."""
    data = _LOWER[data]
    start, end, text = words(data, at, _IS_WORD)
    return span_hash(prefix_hash(BYTE_CODES[data]), start, end), text


def grams(prefix: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, and which of them lie in one text."""
    i = np.arange(max(0, len(text) - k + 1))
    return span_hash(prefix, i, i + k), text[i] == text[i + k - 1] if len(i) else np.zeros(0, bool)


def fingerprints(prefix: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the winnowed grams."""
    h, _ = grams(prefix, text, GRAM)
    at = window_anchors(h, WINDOW - GRAM + 1)
    inside = text[:len(at)] == text[WINDOW - 1:WINDOW - 1 + len(at)]
    at = np.unique(at[inside])
    return at, h[at]


@dataclass
class Index:
    """The fingerprints of some items, sorted by hash."""
    names: list[str]
    words: np.ndarray           # word hashes, item after item
    bounds: np.ndarray          # first word of each item
    keys: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]     # length -> (sorted hashes, items)


def index(items: list[tuple[str, str]]) -> Index:
    raw = [t.encode() for _, t in items]
    at = np.cumsum([0] + [len(r) for r in raw])
    h, item = word_hashes(np.frombuffer(b"".join(raw), np.uint8), at)
    bounds = np.searchsorted(item, np.arange(len(items) + 1))
    prefix = prefix_hash(h)
    places, keys = fingerprints(prefix, item)
    order = np.argsort(keys, kind="stable")
    n, short = np.diff(bounds), {}
    for length in range(1, WINDOW):
        some = np.flatnonzero(n == length)
        if len(some):
            whole = span_hash(prefix, bounds[some], bounds[some] + length)
            by = np.argsort(whole, kind="stable")
            short[length] = whole[by], some[by]
    return Index([i for i, _ in items], h, bounds, keys[order], places[order], short)


def _matches(sorted_keys: np.ndarray, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(probe number, place in sorted_keys) of all equal pairs, some at a time."""
    lo, hi = np.searchsorted(sorted_keys, probes, "left"), np.searchsorted(sorted_keys, probes, "right")
    hit = np.flatnonzero(hi > lo)
    n = (hi - lo)[hit]
    total = np.cumsum(n)
    first = 0
    while first < len(hit):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + BLOCK, "right")))
        rows, counts = hit[first:last], n[first:last]
        before = np.repeat(np.cumsum(counts) - counts, counts)
        yield np.repeat(rows, counts), np.repeat(lo[rows], counts) + np.arange(counts.sum()) - before
        first = last


def hits(idx: Index, h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end word, item) of runs of the texts' words that stand in an item
    and hold a window of it."""
    out = []
    prefix = prefix_hash(h)
    item_of = np.repeat(np.arange(len(idx.names)), np.diff(idx.bounds))
    at, keys = fingerprints(prefix, text)
    for probe, place in _matches(idx.keys, keys):
        i, j = at[probe], idx.places[place]
        item, doc = item_of[j], text[i]
        left, right = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        same = np.ones(len(i), bool)
        for k in range(GRAM):
            same &= h[i + k] == idx.words[j + k]
        for step, run in ((-1, left), (1, right)):
            going = same.copy()
            for k in range(1, WINDOW - GRAM + 1):
                a, b = (i - k, j - k) if step < 0 else (i + GRAM - 1 + k, j + GRAM - 1 + k)
                ok = going & (a >= 0) & (a < len(h)) & (b >= idx.bounds[item]) & (b < idx.bounds[item + 1])
                a, b = np.where(ok, a, 0), np.where(ok, b, 0)
                going = ok & (text[a] == doc) & (h[a] == idx.words[b])
                run += going
        found = same & (left + GRAM + right >= WINDOW)
        out.append(np.stack([(i - left)[found], (i + GRAM + right)[found], item[found]]))
    for length, (keys, items) in idx.short.items():
        g, inside = grams(prefix, text, length)
        starts = np.flatnonzero(inside)
        for probe, place in _matches(keys, g[starts]):
            i = starts[probe]
            out.append(np.stack([i, i + length, items[place]]))
    return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, np.int64),) * 3


_SCHEMA = "n_words bigint, runs array<struct<a:bigint,b:bigint>>, items array<string>"


def _scan(docs: DataFrame, idx: Index) -> DataFrame:
    """(doc_id, key, n_words, runs, items): disjoint hit runs and item names of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(idx)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_index = sent.value
        for part, data, at in text_chunks(batches):
            h, text = word_hashes(data, at)
            first = np.searchsorted(text, np.arange(part.num_rows + 1))
            a, b, item = hits(item_index, h, text)
            cover = np.zeros(len(h) + 1, np.int64)
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
            covered = np.r_[np.cumsum(cover)[:-1] > 0, False]
            # A run ends with its text, too.
            new = covered & ~np.r_[False, covered[:-1]]
            edge = np.zeros(len(h) + 1, bool)
            edge[first] = True
            new |= covered & edge
            start = np.flatnonzero(new)
            stop = np.flatnonzero((covered[:-1] & ~covered[1:]) | (covered[:-1] & new[1:])) + 1
            row = text[start]
            runs = pa.StructArray.from_arrays([pa.array(start - first[row]), pa.array(stop - first[row])], ["a", "b"])
            run_ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            pairs = np.unique(text[a] * len(item_index.names) + item) if len(a) else np.zeros(0, np.int64)
            owner, item = np.divmod(pairs, max(1, len(item_index.names)))
            item_ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(np.diff(first)),
                 pa.ListArray.from_arrays(pa.array(run_ends), runs),
                 pa.ListArray.from_arrays(pa.array(item_ends),
                                          pa.array([item_index.names[k] for k in item.tolist()], pa.string()))],
                ["doc_id", "key", "n_words", "runs", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
            .mapInArrow(run, f"doc_id {kind}, key bigint, {_SCHEMA}"))


def contamination(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    items = (benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
             .select(F.col("item_id").cast("string").alias("item_id"), "text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    scans = []
    for p in range(passes):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p) if passes > 1 else items
        scans.append(_scan(docs, index(sorted(tuple(r) for r in mine.collect()))))
    merged = scans[0]
    if passes > 1:
        for s in scans[1:]:
            merged = merged.unionByName(s)
        # Equal rows fall into one group; each is given back.
        merged = (merged.groupBy("doc_id", "key", "n_words")
                  .agg(F.flatten(F.collect_list("runs")).alias("runs"),
                       F.flatten(F.collect_list("items")).alias("items"), F.count(F.lit(1)).alias("n"))
                  .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") / passes).cast("int")))))
    hit = F.aggregate(
        F.sort_array("runs"), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), r["b"] - F.greatest(r["a"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], r["b"]).alias("end")),
        lambda acc: acc["n"])
    found = merged.select("doc_id", "n_words", hit.alias("n_hit"), F.sort_array(F.array_distinct("items")).alias("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text has no hit, in all their columns; a row is known by
    its id and text, so null and repeated ids are no exception."""
    key = F.xxhash64("doc_id", "text")
    hit = "hit"
    while hit in docs.columns:
        hit += "_"
    found = contamination(docs.select(key.alias("doc_id"), "text"), benchmark).filter("contaminated")
    found = stage(found.select(F.col("doc_id").alias(hit)).distinct(), "contaminated")
    return docs.join(broadcast_if_small(found), key == F.col(hit), "left_anti")
