"""Substring dedup over words: recurring passages lose all but their first document.

A window is 50 consecutive words.  A word goes if a window over it also starts
in a document with a smaller ``doc_id``.

1. Candidates: in each window the least hash of its ``GRAM``-word phrases is its
   anchor, so equal windows hold the same phrase at the same place.  Phrases that
   anchor windows of two documents or more are counted by hash (combined map-side).
2. Dictionary: the words of each such phrase are read from one document that holds it.
3. Automata: documents with candidates are dealt into blocks of bounded size, and a
   block is joined by the phrases that its documents may hold.  Each block compiles
   an Aho-Corasick automaton over word numbers (pyahocorasick) and streams its
   documents through it, which locates every occurrence of its phrases and confirms
   them on their words.  So a document passes through one automaton, and an automaton
   holds no more phrases than its documents have anchors.  Where an anchor has the
   hash of a phrase but other words, those are one more phrase, and its documents
   are streamed again.
4. If all occurrences of a phrase stand in equal passages, those after the first
   document's go.  Otherwise the passages around it are told apart: of equal ones
   all but the first document's go, and the windows of what is left are compared
   one by one.  Passages and windows are compared by phrase, which is confirmed on
   its words, and a 64-bit hash of all their words.

Edge cases: a null, empty or white-space text has no words and the digest of the
empty string; a text of fewer than 50 words loses nothing; a repeated row (same
id and text) is the same document and keeps its words as often as it stands
there; repeats inside one document stay; ids of any ordered type are compared as
they are; a null ``doc_id`` comes after all others, and two such rows leave each
other alone; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, broadcast_if_small, not_space, prefix_hash, span_hash, stage, text_chunks, words
from .suffix_dedup import CHUNK, _lists
from .windows import anchored_runs, covered, keyed, sha256, split_by_key, window_hashes

LENGTH, GRAM = 50, 15
#: Text bytes of a block: its automaton has a node for each word of a phrase at most.
BLOCK_BYTES = 4 << 20
_NOT_SPACE = not_space()


def _words(data: np.ndarray, at: np.ndarray, codes: np.ndarray = BYTE_CODES) -> tuple[np.ndarray, ...]:
    """(prefix hashes of the word sequence, first word of each text, word starts, word ends)."""
    start, end, text = words(data, at, _NOT_SPACE)
    hashes = span_hash(prefix_hash(codes[data]), start, end)
    return prefix_hash(hashes), np.searchsorted(text, np.arange(len(at))), start, end


def _phrases(length: int, gram: int, codes: np.ndarray):
    """(key, text) -> (core, key): the anchors of its windows, by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            prefix, first, _, _ = _words(data, at, codes)
            text, _, _, core, _, _ = anchored_runs(prefix, first, length, gram)
            yield pa.RecordBatch.from_arrays([pa.array(core), part.column(0).take(pa.array(text))], ["core", "key"])
    return run


def _joined(raw: bytes, start: np.ndarray, end: np.ndarray, place: int, gram: int) -> str:
    return b" ".join([raw[i:j] for i, j in zip(start[place:place + gram].tolist(), end[place:place + gram].tolist(),
                                               strict=True)]).decode()


def _plain_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row ends, values) of an array column."""
    ends = column.offsets.to_numpy().astype(np.int64)
    return ends - ends[0], column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False)


def _dictionary(length: int, gram: int, codes: np.ndarray):
    """(key, text, cores) -> (core, phrase): the words of the phrases that are asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            prefix, first, start, end = _words(data, at, codes)
            text, _, _, core, _, place = anchored_runs(prefix, first, length, gram)
            ends, asked = _plain_lists(part.column(2))
            owner, raw, out = np.repeat(np.arange(part.num_rows), np.diff(ends)), data.tobytes(), {}
            wanted = set(zip(owner.tolist(), asked.tolist(), strict=True))
            for t, c, p in zip(text.tolist(), core.tolist(), place.tolist(), strict=True):
                if (t, c) in wanted and c not in out:
                    out[c] = _joined(raw, start, end, p, gram)
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.string())],
                                             ["core", "phrase"])
    return run


def _numbered_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, numbers: dict[str, int]) -> np.ndarray:
    """The number of every word of a chunk; 0: in no phrase."""
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int32)
    column = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[_NOT_SPACE[data]]))
    coded = column.dictionary_encode()
    known = np.array([numbers.get(w, 0) for w in coded.dictionary.to_pylist()], np.int64)
    return known[coded.indices.to_numpy()] if len(start) else known


def _locate(length: int, gram: int, codes: np.ndarray):
    """The documents of a block and its phrases -> (key, lo, hi, phrase, full): the runs of
    windows around each occurrence that the block's automaton finds; and anchors of a
    phrase's hash with other words, with those words."""
    def run(docs: pa.Table, phrases: pa.Table) -> pa.Table:
        if not phrases.num_rows or not docs.num_rows:
            return _FOUND.empty_table()
        numbers: dict[str, int] = {}
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for number, phrase in zip(phrases.column("number").to_pylist(), phrases.column("phrase").to_pylist(), strict=True):
            automaton.add_word(tuple([numbers.setdefault(w, len(numbers) + 1) for w in phrase.split(" ")]), number)
        automaton.make_automaton()
        cores, out = np.unique(phrases.column("core").to_numpy()), []
        for part, data, at in text_chunks(iter(docs.select(["key", "text"]).combine_chunks().to_batches()), max_bytes=CHUNK):
            prefix, first, start, end = _words(data, at, codes)
            text, lo, hi, core, full, place = anchored_runs(prefix, first, length, gram)
            code, found = _numbered_words(data, start, end, numbers), np.full(len(start) + 1, -1, np.int64)
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                if b - a >= length:
                    hits = list(automaton.iter(tuple(code[a:b].tolist())))
                    if hits:
                        last, number = zip(*hits, strict=True)
                        found[np.array(last) + (a - gram + 1)] = number
            number = found[place]
            some = np.flatnonzero((number >= 0) | np.isin(core, cores))
            other, raw = np.flatnonzero(number[some] < 0).tolist(), data.tobytes()
            words_of = [None] * len(some)
            for k in other:
                words_of[k] = _joined(raw, start, end, int(place[some[k]]), gram)
            out.append(pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text[some])), pa.array(lo[some].astype(np.int32)), pa.array(hi[some].astype(np.int32)),
                 pa.array(number[some]), pa.array(full[some]), pa.array(core[some]), pa.array(words_of, pa.string())], schema=_FOUND))
        return pa.Table.from_batches(out, _FOUND)
    return run


_FOUND = pa.schema([("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("phrase", pa.int64()), ("full", pa.int64()),
                    ("core", pa.int64()), ("words", pa.string())])


def _open(length: int):
    """(key, runs, text) -> a row for each window of the runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            prefix, first, _, _ = _words(data, at)
            ends, (lo, hi, phrase) = _lists(part.column(2), ("lo", "hi", "phrase"))
            owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
            p, h = window_hashes(prefix, lo + first[owner], hi + first[owner], length)
            row = np.repeat(owner, hi - lo + 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row)), pa.array((p - first[row]).astype(np.int32)),
                 pa.array(np.repeat(phrase, hi - lo + 1)), pa.array(h)], ["key", "pos", "phrase", "window"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> the result row; spans of words may overlap."""
    for part, data, at in text_chunks(batches, max_bytes=CHUNK):
        _, first, start, end = _words(data, at)
        ends, (a, b) = _lists(part.column(2), ("a", "b"))
        owner = np.repeat(np.arange(part.num_rows), np.diff(ends))
        gone = covered(a + first[owner], b + first[owner], len(start))
        total, raw = np.r_[0, np.cumsum(gone)], data.tobytes()
        digest = []
        for x, y in zip(first[:-1], first[1:], strict=True):
            if total[x] == total[y]:
                kept = b" ".join(raw[start[x]:end[y - 1]].split()) if y > x else b""
            else:
                some = np.flatnonzero(~gone[x:y]) + x
                kept = b" ".join([raw[i:j] for i, j in zip(start[some].tolist(), end[some].tolist(), strict=True)])
            digest.append(sha256([kept]))
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(first)), pa.array(np.diff(total[first])), pa.array(digest)],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _one_a_key(docs: DataFrame) -> DataFrame:
    """One row of each document: repeated rows are few in kind, however many they are."""
    twice = stage(docs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "substring-repeated")
    twice = broadcast_if_small(twice)
    once = docs.join(twice, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"), F.first("rank").alias("rank"))
    return docs.join(twice, "key", "left_anti").unionByName(once)


def located_phrases(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES,
                    codes: np.ndarray = BYTE_CODES) -> DataFrame:
    """(key, lo, hi, phrase, full): every run of windows around a phrase of two documents,
    located by the blocks' automata in rows (key, text).  ``codes`` are the bytes' hashes."""
    docs = docs.select("key", "text")
    candidates = stage(docs.mapInArrow(_phrases(length, gram, codes), "core bigint, key bigint"), "substring-candidates")
    recurring = candidates.groupBy("core").agg(F.min("key").alias("k0"), F.max("key").alias("k1")).filter("k0 <> k1")
    recurring = stage(recurring.select("core", "k0"), "substring-cores")
    held = stage(candidates.join(recurring.select("core"), "core").select("key", "core"), "substring-held")
    asked = recurring.groupBy(F.col("k0").alias("key")).agg(F.collect_list("core").alias("cores"))
    named, _ = split_by_key(docs, stage(asked, "substring-asked"))
    phrases = named.select("key", "text", "cores").mapInArrow(_dictionary(length, gram, codes), "core bigint, phrase string")
    keys = broadcast_if_small(stage(held.select("key").distinct(), "substring-documents"))
    texts = docs.join(keys, "key", "left_semi")
    sized = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(max(1, -(-sized // block_bytes)))).alias("block")
    held = held.select(block, "core").distinct()
    while True:
        phrases = stage(phrases.withColumn("number", F.monotonically_increasing_id()), "substring-phrases")
        found = texts.select(block, "key", "text").groupBy("block").cogroup(held.join(phrases, "core").groupBy("block"))
        found = stage(found.applyInArrow(_locate(length, gram, codes), "key bigint, lo int, hi int, phrase bigint, full bigint, "
                                                                "core bigint, words string"), "substring-located")
        others = found.filter("words is not null").select("core", F.col("words").alias("phrase")).distinct()
        if others.isEmpty():
            return found.select("key", "lo", "hi", "phrase", "full")
        phrases = phrases.select("core", "phrase").unionByName(others)


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, spans): word ranges [a, b), overlapping, to remove from rows (key, text, rank)."""
    docs = _one_a_key(docs)
    ranks = docs.select("key", "rank")
    runs = located_phrases(docs, length, gram, block_bytes)
    keys = broadcast_if_small(stage(runs.select("key").distinct(), "substring-keys"))
    ranks = stage(ranks.join(keys, "key", "left_semi"), "substring-ranks")
    runs = stage(runs.join(broadcast_if_small(ranks), "key"), "substring-found")
    first = runs.groupBy("phrase").agg(F.min("rank").alias("r0"), F.max("rank").alias("r1"),
                                       (F.min("full") != F.max("full")).alias("mixed")).filter("r0 < r1")
    found = stage(runs.join(stage(first.select("phrase", "r0", "mixed"), "substring-first"), "phrase"), "substring-shared")
    mixed = found.filter("mixed").drop("r0", "mixed")
    passages = stage(mixed.groupBy("phrase", "full").agg(F.min("rank").alias("r0")), "substring-passages")
    known = stage(mixed.join(passages, ["phrase", "full"]).select("key", "rank", "lo", "hi", "phrase", "r0"), "substring-known")
    opened = known.filter("rank = r0").groupBy("key").agg(F.collect_list(F.struct("lo", "hi", "phrase")).alias("runs"))
    texts, _ = split_by_key(docs.select("key", "text"), stage(opened, "substring-opened"))
    windows = texts.select("key", "text", "runs").mapInArrow(_open(length), "key bigint, pos int, phrase bigint, window bigint")
    windows = stage(windows.join(broadcast_if_small(ranks), "key"), "substring-windows")
    earliest = windows.groupBy("phrase", "window").agg(F.min("rank").alias("r0"), F.max("rank").alias("r1")).filter("r0 < r1")
    earliest = stage(earliest.select("phrase", "window", "r0"), "substring-windows-first")
    single = windows.join(earliest, ["phrase", "window"]).filter("rank > r0").select(
        "key", F.col("pos").alias("a"), (F.col("pos") + length).alias("b"))
    whole = (found.filter("not mixed and rank > r0").select("key", "lo", "hi")
             .union(known.filter("rank > r0").select("key", "lo", "hi")))
    spans = whole.select("key", F.col("lo").alias("a"), (F.col("hi") + length).alias("b")).unionByName(single)
    return spans.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def substring_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = keyed(docs, "doc_id", F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id")).alias("rank"))
    spans = stage(removed_spans(rows.select("key", "text", "rank"), length, gram, block_bytes), "substring-spans")
    hit, clean = split_by_key(rows, spans)
    empty = F.array().cast("array<struct<a:int,b:int>>").alias("spans")
    schema = f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    return (hit.select("doc_id", "text", "spans").mapInArrow(_cut, schema)
            .unionByName(clean.select("doc_id", "text", empty).mapInArrow(_cut, schema)))
