"""SentencePiece encoding and decoding by batched dynamic programming (``pieces``).

``encode`` gives the ids that the library gives for the same model; ``decode``
is its inverse.  Every distinct word that a worker has not seen lately is
segmented, words of equal length together, and a document's ids are its words'
ids, gathered by word number.

Edge cases: a null or empty text has no ids (an empty array) and decodes to the
empty text; characters outside the vocabulary become byte pieces; a text that
holds the meta symbol U+2581 itself decodes to a space there, as in the
library; ids of control pieces decode to nothing, and null ids to null; byte
pieces that are no UTF-8 decode to U+FFFD; repeated rows get equal rows; an
empty table gives an empty one.  Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import text_chunks
from .pieces import default_model, store, tokens


#: Text bytes encoded at once.
CHUNK = 4 << 20


def _encoded(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray, path: str) -> tuple[pa.ListArray, np.ndarray]:
    """(ids of each text, whether all its words' ids decode to them)."""
    words = store(path)
    distinct, code, first = tokens(data, at)
    number = words.numbers(distinct)[code]
    flat, ends = words.ids(number)
    bad = np.r_[0, np.cumsum(~words.good[number])][first]
    offsets = pa.array(np.r_[0, ends][first].astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(flat)), bad[1:] == bad[:-1]


def encode(docs: DataFrame, model: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids``: the text's piece ids (array of int).  As with
    ``withColumn``, a column of that name is replaced."""
    path = model or default_model()
    kept = [c for c in docs.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, text, CHUNK):
            yield pa.RecordBatch.from_arrays([*part.columns, _encoded(part, data, at, path)[0]], [*part.schema.names, ids])

    schema = docs.select(*kept).schema.add(ids, T.ArrayType(T.IntegerType()))
    return docs.select(*kept).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``text``: the text of its ids; a column of that name is replaced."""
    path = model or default_model()
    kept = [c for c in encoded.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = store(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                column = part.column(part.schema.get_field_index(ids))
                flat = column.flatten()                             # without null rows
                n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                known = flat.is_valid().to_numpy(zero_copy_only=False)
                values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)
                values = np.where(known, values, words.nothing) if not known.all() else values
                raw, ends = words.decoded(values)
                raw, ends = raw.tobytes(), np.r_[0, ends][np.r_[0, np.cumsum(n)]]
                texts = [None if null else raw[a + (raw[a:a + 1] == b" " and a < b):b].decode("utf-8", "replace")
                         for a, b, null in zip(ends[:-1].tolist(), ends[1:].tolist(),
                                               column.is_null().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 [*part.schema.names, text])

    schema = encoded.select(*kept).schema.add(text, "string")
    return encoded.select(*kept).mapInArrow(run, schema)


def encode_checked(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): the ids, and whether they decode to the text (to
    all its words, which decode apart: each distinct word is encoded and decoded once)."""
    path = model or default_model()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, "text", CHUNK):
            lists, good = _encoded(part, data, at, path)
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pc.list_value_length(lists).cast(pa.int64()), pa.array(good)],
                                             ["doc_id", "ids", "n_tokens", "round_trip"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, ids array<int>, n_tokens bigint, round_trip boolean")
