"""Runs of fixed-length windows keyed by content, shared by the substring operators.

A window of ``length`` symbols is keyed by its anchor: the least of the rolling
hashes of its ``gram``-symbol substrings.  The anchor depends on the window's
content alone, so equal windows have equal anchors at the same offset, and
neighbouring windows with one anchor form a run.  Two runs with equal ``full``
hashes hold the same windows in the same order.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, broadcast_if_small, mix, span_hash, window_anchors


def anchor_runs(prefix: np.ndarray, at: np.ndarray, length: int, gram: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, last, core, full): each run of windows first..last (starts, from the
    text's own first symbol), the hash of its anchor gram and of all its symbols."""
    return anchored_runs(prefix, at, length, gram)[:5]


def anchored_runs(prefix: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The runs of :func:`anchor_runs`, and where the anchor of each begins (from the first symbol of all)."""
    n = int(at[-1])
    none = np.zeros(0, np.int64)
    if n < length:
        return (none,) * 6
    i = np.arange(n - gram + 1)
    h = span_hash(prefix, i, i + gram)
    anchor = window_anchors(h, length - gram + 1)
    text = np.repeat(np.arange(len(at) - 1), np.maximum(0, np.diff(at) - length + 1))
    if not len(text):
        return (none,) * 6
    sizes = np.maximum(0, np.diff(at) - length + 1)
    p = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + at[text]
    s = anchor[p]
    begins = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (text[1:] != text[:-1])])
    ends = np.r_[begins[1:], len(p)] - 1
    lo, hi, s, text = p[begins], p[ends], s[begins], text[begins]
    full = mix(span_hash(prefix, lo, hi + length) + (s - lo).astype(np.uint64) * GOLDEN)
    start = at[text]
    return text, lo - start, hi - start, h[s].view(np.int64), full.view(np.int64), s


def window_hashes(prefix: np.ndarray, first: np.ndarray, last: np.ndarray, length: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every window of the runs first..last."""
    n = last - first + 1
    p = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    return p, span_hash(prefix, p, p + length).view(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n symbols lie in one of the ranges."""
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, ends, -1)
    return np.cumsum(cover)[:-1] > 0


def sha256(parts) -> str:
    digest = hashlib.sha256()
    for p in parts:
        digest.update(p)
    return digest.hexdigest()


def keyed(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """(key, text, columns): the key names a document by its id and text, so a
    repeated row is the same document."""
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "text", *columns)


def split_by_key(docs: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` joined with their row of ``lists``, the other rows).  Few keys are
    broadcast and only their documents are shuffled; many keys shuffle both sides."""
    keys = broadcast_if_small(lists.select("key"))
    return docs.join(keys, "key", "left_semi").join(lists, "key"), docs.join(keys, "key", "left_anti")
