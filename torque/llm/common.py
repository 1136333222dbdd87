"""Helpers shared by the operators: tables, Arrow text access, vectorised hashing."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Text bytes a Python kernel works on at once (its numpy arrays are a few times as large).
CHUNK_BYTES = 2 << 20

MIX_1, MIX_2, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder under the shared work folder and
    read back: cuts the lineage, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings (dots written as two underscores) held during an action."""
    named = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# -- Arrow text ---------------------------------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``max_bytes`` of text (one text at least,
    whole texts always), each with its (bytes, offsets)."""
    for batch in batches:
        data, at = utf8(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + max_bytes, "right")) - 1)
            hi = min(hi, lo + 20_000, batch.num_rows)
            yield batch.slice(lo, hi - lo), data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
            lo = hi


# -- vectorised words and hashes ----------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * GOLDEN)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Powers a worker keeps; longer texts make theirs anew.
KEPT_POWERS = 3 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least, from one table that grows."""
    global _POWERS
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    size, out = -(-n // (1 << 16)) << 16, []
    for base in (_BASE, _INVERSE):
        p = np.ones(size, np.uint64)
        p[1:] = base & (2**64 - 1)
        out.append(np.multiply.accumulate(p, out=p))
    if size <= KEPT_POWERS:
        _POWERS = out
    return out[0], out[1]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash of 64-bit symbols; see ``span_hash``."""
    up, _ = powers(len(symbols) + 1)
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up[:len(symbols)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of symbols[start:end], equal for equal symbol runs wherever they stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def words(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of maximal runs of word bytes; runs end with their text."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    m = np.zeros(len(data) + 1, np.int8)
    m[:-1] = is_word[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[at] = True
    before = np.zeros(len(data) + 1, np.int8)
    before[1:] = m[:-1]
    before[begins] = 0
    start = np.flatnonzero(m > before)
    after = np.zeros(len(data), np.int8)
    after[:] = m[1:]
    after[begins[1:]] = 0
    end = np.flatnonzero(m[:-1] > after) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def not_space() -> np.ndarray:
    """Byte table of ``[^\\x20\\x09-\\x0D]``."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


#: Rows (of an id each) up to which a side of a join is broadcast.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows; any
    larger side is left to a shuffle join, with the same result."""
    from pyspark.sql import functions as F
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i that has so many values."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:]) if len(x) > span else x[:0]
        span *= 2
    rest = width - span
    return np.minimum(x[:-rest], x[rest:]) if rest and len(x) > rest else x[:0] if rest else x


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of its least one (by the upper
    32 bits, the leftmost of equals): it depends on the window's content alone."""
    low = np.uint64(0xFFFFFFFF)
    packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    return (sliding_min(packed, width) & low).astype(np.int64)
