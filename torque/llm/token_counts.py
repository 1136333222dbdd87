"""Exact token counts at every prefix, by prefix dynamic programming (``pieces``).

The table of a word holds the token count of each of its prefixes, and a text
is a sequence of words between which no piece reaches; so the count at any
prefix of a text is the sum of the whole words before it and one table entry.
Truncation and budget questions are answered from those counts without
encoding anything again.

Counts are those of the library for the same model, without begin, end or
added special tokens; special strings in a text are ordinary text.  A null or
empty text has 0 tokens; an empty table gives an empty one; repeated rows get
equal rows; other columns are ignored by :func:`token_counts` and kept by
:func:`truncate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_chunks
from .pieces import CACHE_WORDS, SPACE, Pieces, default_model, load, split, tokens

LIMIT = 4096


class PrefixCounts:
    """The token count of every prefix of one text."""

    def __init__(self, pieces: Pieces, text: str):
        self.text = text
        counts = [np.zeros(1, np.int64)]
        tables: dict[str, np.ndarray] = {}
        words = split(text)
        for group, (_, _, count) in pieces._tables(dict.fromkeys(words)):
            tables.update(zip(group, count, strict=True))
        done = 0
        for w in words:
            counts.append(tables[w][1:] + done)
            done += int(tables[w][-1])
        # The leading space is no character of the text: entry i is text[:i].
        self.counts = np.concatenate(counts)[min(len(text), 1):]
        if len(text):
            self.counts[0] = 0

    def at(self, n_chars: int) -> int:
        """Tokens of ``text[:n_chars]``."""
        return int(self.counts[min(n_chars, len(self.text))])

    def longest_prefix(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts <= max(0, budget))[-1])


_KNOWN: dict[str, dict[str, int]] = {}


def _counts(path: str) -> dict[str, int]:
    """A worker's known words with their token counts, kept from task to task."""
    return _KNOWN.setdefault(path, {})


def _texts(data: np.ndarray, at: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    path = model or default_model()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _counts(path)
        for part, data, at in text_chunks(batches, max_bytes=4 << 20):
            distinct, code, first = tokens(data, at)
            words = pc.replace_substring(distinct, " ", SPACE).to_pylist()
            known.update(load(path).count_words([w for w in words if w not in known]))
            each = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            total = np.r_[0, np.cumsum(each[code])][first]
            if len(known) > CACHE_WORDS:
                known.clear()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(at)), pa.array(np.diff(total))], ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))


def truncate(docs: DataFrame, budget: int, model: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with each text cut to its longest prefix of at most ``budget`` tokens."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for part, data, at in text_chunks(batches, text):
            i = part.schema.get_field_index(text)
            cut = [None if not x.is_valid else t[:PrefixCounts(pieces, t).longest_prefix(budget)]
                   for x, t in zip(part.column(i), _texts(data, at), strict=True)]
            yield part.set_column(i, part.schema.field(i), pa.array(cut, part.schema.field(i).type))

    return docs.mapInArrow(run, docs.schema)
