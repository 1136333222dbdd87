"""Line dedup by a segment-partition edit join.

Lines are the \\n-split parts of a text, without ASCII white space at their
ends; every line with another character takes part.  A line goes if the same
line, or a near one, stands earlier (by doc_id, then by place); other lines stay
as they are.  Two lines are near if they are within ``DISTANCE`` edits and the
edits are at most one for every ``PER_EDIT`` characters of the shorter line
(:func:`allowed`): lines of up to four characters go by equality alone, of five
to nine with one edit, longer ones with two.

A line of n characters is split into ``DISTANCE + 1`` segments.  Two lines within
that many edits share one segment, at a place bounded by the edits on either
side of it; so each line puts its segments into an index by length, and probes
the index of each length it may be near with just the substrings that can
match.  Index and probe are two sets of hashed keys joined by Spark; the join's
condition also holds their parity sketches against each other, which lines within
that many edits always pass.  Candidate
pairs of distinct lines, each once, are verified by a banded bit-parallel edit
distance, many pairs at a time in numpy.

Equal lines are one row from the start, so a line that a third of all documents
hold costs one row a task; segments shared by many different lines are split by
AQE's skew join.  No candidate is dropped.

Edge cases: a null text has no lines and stays null; an empty text stays empty;
a text whose lines all go becomes empty; rows of one ``doc_id`` are told apart
by their text, and a repeated row (same id and text) is the same document; a
null ``doc_id`` comes after all others, ordered by a hash of its text; ids of any
ordered type are compared as they are; an empty table gives an empty one;
:func:`dedup_lines` keeps all columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, MIX_1, MIX_2, broadcast_if_small, mix, prefix_hash, span_hash, stage, text_chunks

DISTANCE, MIN_CHARS, PER_EDIT = 2, 1, 5
WHITE = b" \t\n\x0b\f\r"
#: Characters of padded pairs verified at once.
VERIFY_CHARS = 1 << 21


def allowed(n: np.ndarray, distance: int) -> np.ndarray:
    """Edits within which a line of n characters and a longer one are near."""
    return np.minimum(distance, n // PER_EDIT)


def lines_of(text: bytes, min_chars: int = MIN_CHARS) -> list[tuple[int, bytes]]:
    """(number, stripped line) of the lines of a text that take part: not the empty ones."""
    out = []
    for i, line in enumerate(text.split(b"\n")):
        line = line.strip(WHITE)
        if len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode("utf-8", "replace")) >= min_chars):
            out.append((i, line))
    return out


def line_id(line: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(line, digest_size=8).digest(), "little", signed=True)


def _raw(data: np.ndarray, at: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _lines(min_chars: int):
    """(key, doc, text) -> (id, doc, tie, line number), the first place of each line in its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches):
            ids, owner, number = [], [], []
            for k, text in enumerate(_raw(data, at)):
                for i, line in lines_of(text, min_chars):
                    ids.append(line_id(line))
                    owner.append(k)
                    number.append(i)
            take = pa.array(np.array(owner, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(ids, np.int64)), part.column(1).take(take), part.column(0).take(take),
                 pa.array(np.array(number, np.int32))], ["id", "doc", "key", "number"])
    return run


# -- segment keys --------------------------------------------------------------

def segments(n: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, length) of each of the distance + 1 segments of lines of length n."""
    parts = distance + 1
    short, longer = n // parts, n % parts        # the last `longer` segments have one more
    out, start = [], np.zeros_like(n)
    for i in range(parts):
        length = short + (i >= parts - longer)
        out.append((start, length))
        start = start + length
    return out


#: Hashes of the characters up to U+FFFF, looked up rather than computed.
_BMP = mix((np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * GOLDEN)


def char_codes(text: str) -> np.ndarray:
    """A 64-bit hash of every character."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = _BMP[np.minimum(codes, 0xFFFF)]
    beyond = np.flatnonzero(codes >= 0xFFFF)
    out[beyond] = mix((codes[beyond].astype(np.uint64) + np.uint64(1)) * GOLDEN)
    return out


def _key(h: np.ndarray, n: np.ndarray, i: int) -> np.ndarray:
    return mix(h ^ (n.astype(np.uint64) * np.uint64(64) + np.uint64(i)) * GOLDEN).view(np.int64)


def coded(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(characters of each line, hashes of all characters)."""
    text = [x.decode("utf-8", "replace") for x in lines]
    return np.array([len(t) for t in text], np.int64), char_codes("".join(text))


def segment_keys(m: np.ndarray, codes: np.ndarray, distance: int, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key): the keys that lines (:func:`coded`) put into the index, or probe it with."""
    begin = np.cumsum(m) - m
    prefix = prefix_hash(codes)
    rows, keys = [], []
    for shorter in range(distance + 1 if probe else 1):
        n = m - shorter
        for i, (p, length) in enumerate(segments(n, distance)):
            lo, hi = (max(-i, shorter - (distance - i)), min(i, shorter + (distance - i))) if probe else (0, 0)
            for move in range(lo, hi + 1):
                s = p + move
                ok = np.flatnonzero((n > 0) & (length > 0) & (s >= 0) & (s + length <= m))
                h = span_hash(prefix, begin[ok] + s[ok], begin[ok] + s[ok] + length[ok])
                rows.append(ok)
                keys.append(_key(h, n[ok], i))
    return np.concatenate(rows), np.concatenate(keys)


def sketches(n: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A parity sketch of each line (:func:`coded`): of its characters in the lower 32 bits, of
    its character pairs in the upper ones.  An edit flips at most 2 of the lower and 4 of
    the upper bits, so lines further apart than that are no candidates."""
    begin = np.cumsum(n) - n
    one, upper = np.uint64(1), np.uint64(59)
    pairs = np.zeros(len(codes), np.uint64)
    pairs[:-1] = one << (((codes[:-1] * MIX_1 + codes[1:] * MIX_2) >> upper) + np.uint64(32))
    pairs[begin + n - 1] = 0                        # none across two lines
    pairs ^= one << (codes >> upper)
    return np.bitwise_xor.reduceat(pairs, begin).view(np.int64)


def _keys(distance: int, probe: bool, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in text_chunks(batches):
            # Shorter lines are near none; longer ones have distance + 1 segments.
            least = max(min_chars, PER_EDIT, distance + 1)
            distinct = list({line for text in _raw(data, at) for _, line in lines_of(text, least)})
            if not distinct:
                continue
            ids = np.array([line_id(x) for x in distinct], np.int64)
            n, codes = coded(distinct)
            row, key = segment_keys(n, codes, distance, probe)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[row]), pa.array(sketches(n, codes)[row])],
                                             ["segment", "id", "sketch"])
    return run


# -- verification --------------------------------------------------------------

def banded(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, distance: int) -> np.ndarray:
    """The edit distance of each pair of padded rows a[:n], b[:m]; if it is over
    ``distance``, some number over it.

    Bit-parallel along the diagonal band: bit 63 of a column's words stands for the
    band's lowest row, and the distance is followed down that diagonal until the
    last row, then along it.  Rows hold 0 beyond a text in ``a`` and 1 in ``b``
    (character codes are shifted by 2), so padding never matches."""
    w = 2 * distance + 1
    one = np.uint64(1)
    vp = np.full(len(n), (~np.uint64(0)) << np.uint64(63 - distance), np.uint64)
    vn = np.zeros(len(n), np.uint64)
    dist = np.full(len(n), distance, np.int64)
    across = np.full(len(n), 62, np.uint64)
    wide = np.zeros((len(n), a.shape[1] + 2 * w), a.dtype)
    wide[:, w:w + a.shape[1]] = a
    for i in range(int(m.max(initial=0))):
        x = np.zeros(len(n), np.uint64)
        column = b[:, i]
        for k in range(w):                      # rows i + distance, then upwards
            row = i + distance - k + w
            if row < wide.shape[1]:
                x |= (wide[:, row] == column).astype(np.uint64) << np.uint64(63 - k)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        live = i < m
        down = live & (i < n - distance)
        along = live & ~down
        dist += down & ((d0 >> np.uint64(63)) == 0)
        dist += along & ((hp >> across) & one).astype(bool)
        dist -= along & ((hn >> across) & one).astype(bool)
        across[along] -= one
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
    return np.where(np.abs(n - m) <= distance, dist, distance + 1)


def near(left: list[str], right: list[str], distance: int) -> np.ndarray:
    """Whether each pair of lines is near (see :func:`allowed`)."""
    out = np.zeros(len(left), bool)
    swap = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(left, right, strict=True)]
    n = np.array([len(x) for x, _ in swap], np.int64)
    m = np.array([len(y) for _, y in swap], np.int64)
    size = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(m, 1))).astype(np.int64))
    for width in np.unique(size):
        rows = np.flatnonzero((size == width) & (m - n <= allowed(n, distance)) & (n >= max(PER_EDIT, distance)))
        step = max(1, VERIFY_CHARS // int(width))
        for lo in range(0, len(rows), step):
            some = rows[lo:lo + step]
            padded = []
            for side, filler in ((0, 0), (1, 1)):
                box = np.full((len(some), int(width)), filler, np.uint32)
                for r, k in enumerate(some.tolist()):
                    code = np.frombuffer(swap[k][side].encode("utf-32-le"), np.uint32)
                    box[r, :len(code)] = code + 2
                padded.append(box)
            out[some] = banded(padded[0], n[some], padded[1], m[some], distance) <= allowed(n[some], distance)
    return out


def _verify(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                ok = near(part.column(2).to_pylist(), part.column(3).to_pylist(), distance)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok))
    return run


def _pick(min_chars: int):
    """(text) -> (id, line), each line once a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in text_chunks(batches):
            distinct = list({line for text in _raw(data, at) for _, line in lines_of(text, min_chars)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([line_id(x) for x in distinct], pa.int64()),
                 pa.array([x.decode("utf-8", "replace") for x in distinct], pa.string())], ["id", "line"])
    return run


def line_links(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS,
               first: DataFrame | None = None) -> DataFrame:
    """(a, b): every pair of distinct near lines, once, a < b by id.  ``first`` (id, key): a
    document of ``docs`` that holds each line, if it is known; lines are then read there."""
    text = docs.select("text")
    schema = "segment bigint, id bigint, sketch bigint"
    index = text.mapInArrow(_keys(distance, False, min_chars), schema).alias("i")
    probe = text.mapInArrow(_keys(distance, True, min_chars), schema).withColumnRenamed("id", "other").alias("p")
    # What the sketches rule out is never made a row: lines of one origin share
    # segments with each other, whatever else was changed in them.
    differ = F.col("i.sketch").bitwiseXOR(F.col("p.sketch"))
    near = ((F.col("i.segment") == F.col("p.segment")) & (F.col("id") != F.col("other"))
            & (F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF))) <= 2 * distance)
            & (F.bit_count(F.shiftrightunsigned(differ, 32)) <= 4 * distance))
    pairs = (index.join(probe, near)
             .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
    pairs = stage(pairs, "line-pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = stage(ids, "line-ids")
    if first is not None:
        holders = stage(ids.join(first, "id").select("key").distinct(), "line-holders")
        text = docs.join(broadcast_if_small(holders), "key", "left_semi").select("text")
    lines = (text.mapInArrow(_pick(min_chars), "id bigint, line string")
             .join(broadcast_if_small(ids), "id", "left_semi").dropDuplicates(["id"]))
    lines = stage(lines, "line-texts")
    x, y = (lines.select(F.col("id").alias(c), F.col("line").alias(f"line_{c}")) for c in "ab")
    full = pairs.join(x, "a").join(y, "b").select("a", "b", "line_a", "line_b")
    return stage(full.mapInArrow(_verify(distance), "a bigint, b bigint"), "line-links")


def repeated_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, number, near): the lines to remove from rows (key, text, doc); near: no equal
    line stands earlier, but a near one does."""
    kind = docs.schema["doc"].dataType.simpleString()
    places = docs.select("key", "doc", "text").mapInArrow(
        _lines(min_chars), f"id bigint, doc {kind}, key bigint, number int")
    place = F.struct(F.col("doc").isNull().alias("last"), "doc", "key", "number")
    first = stage(places.groupBy("id").agg(F.min(place).alias("first")), "line-first")
    links = line_links(docs, distance, min_chars, first.select("id", "first.key"))
    both = links.union(links.select("b", "a")).toDF("id", "other")
    other = first.select(F.col("id").alias("other"), F.col("first").alias("near"))
    beaten = (both.join(first, "id").join(other, "other").filter("near < first").select("id").distinct()
              .withColumn("beaten", F.lit(True)))
    marked = stage(first.join(beaten, "id", "left"), "line-marked")
    return (places.join(marked, "id")
            .filter((F.col("first") < place) | F.col("beaten"))
            .select("key", "number", (F.col("first") == place).alias("near")).distinct())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, gone): the text without its lines of the numbers in gone."""
    for part, data, at in text_chunks(batches):
        i = part.schema.get_field_index("text")
        gone = part.column(part.schema.get_field_index("gone"))
        kept = []
        for text, null, numbers in zip(_raw(data, at), part.column(i).is_null().to_pylist(), gone, strict=True):
            numbers = set(numbers.as_py() or ())
            kept.append(None if null else
                        b"\n".join([x for k, x in enumerate(text.split(b"\n")) if k not in numbers]).decode())
        yield part.set_column(i, part.schema.field(i), pa.array(kept, part.schema.field(i).type))


def _keyed(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "text", F.col("doc_id").alias("doc"), *columns)


def _cut_rows(docs: DataFrame, distance: int, min_chars: int) -> DataFrame:
    """(row, text without the removed lines, n_removed, n_near) of every row of ``docs``."""
    rows = _keyed(docs, F.struct(*docs.columns).alias("row"))
    gone = stage(repeated_lines(rows, distance, min_chars).groupBy("key").agg(
        F.collect_set("number").alias("gone"), F.count_if("near").alias("n_near")), "line-gone")
    keys = broadcast_if_small(gone.select("key"))
    hit = rows.join(keys, "key", "left_semi").join(gone, "key").select("row", "text", "gone", "n_near")
    cut = hit.mapInArrow(_cut, hit.schema).select("row", "text", F.size("gone").cast("bigint").alias("n_removed"), "n_near")
    clean = rows.join(keys, "key", "left_anti").select(
        "row", "text", F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_near"))
    return cut.unionByName(clean)


def line_dedup(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_near, kept_sha256) of every row: its \\n-split lines, how
    many of them go, how many of those for a near line only, and the digest of what is left."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return _cut_rows(docs.select("doc_id", "text"), distance, min_chars).select(
        "row.doc_id", F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n"))).cast("bigint")
        .alias("n_lines"), "n_removed", "n_near", F.sha2(text, 256).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``; all rows and columns stay."""
    cut = _cut_rows(docs, distance, min_chars)
    return cut.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
