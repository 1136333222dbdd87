"""Phrase collocations: counts of all phrases by vertical partitioning of a suffix tree.

Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into
words ``[^\\x20\\x09]+``.  A suffix starts at every word, ends with its piece and is
truncated to ``longest`` words; a phrase occurs as often as it is the prefix of a
suffix.  The tree of all suffixes is never in one place:

1. vertical partitioning: word frequencies are counted.  A word over the memory budget
   is replaced, as a prefix, by its two-word extensions, those over it by three-word
   ones, up to whole suffixes; prefixes within the budget are dealt to groups, as many
   as keep the mean group at half the budget.  Only prefixes over the budget (at most
   total / budget of them a level) are known to every task;
2. each task turns its texts into distinct truncated suffixes with counts and writes,
   for each group it has any of, one sorted, compressed run: equal suffixes of a hot
   passage are one line of it;
3. each group merges its runs and builds its subtree: sorted suffixes, nodes where
   they part, leaf totals added up to the nodes.  A node above a group's prefixes is
   split between groups; its count is the prefix frequency of step 1.

Scores are integers: ``scale * a * a`` div ``l * r`` in DECIMAL(38), exact while it
holds ``scale * a * a`` (a below 10**16).

Edge cases: null and empty texts have no words; a null lang is ``und``; a null
``doc_id`` counts as any other; repeated rows count as often as they stand there;
very long texts are one chunk each; ties in score and count go by phrase in byte order,
so ranks are unique; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import (BYTE_CODES, GOLDEN, broadcast_if_small, mix, prefix_hash, span_hash, stage, text_chunks, utf8,
                     words)

LONGEST, MIN_COUNT, SCALE, COVER_PERCENT, TOP = 3, 10, 1_000_000, 50, 2000
#: Suffix occurrences that a group of prefixes may hold (a group takes some 100 bytes for each distinct one).
BUDGET = 1_000_000
#: Prefixes of a level that may exceed the budget: every task knows them.
HEAVY_PREFIXES = 20_000
#: Text bytes of a chunk: its distinct suffixes are what a task holds at once.
CHUNK = 8 << 20
#: Rows of a language ranked in one task; more are thinned first.
RANKED = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


def chunk_words(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, word numbers, text of each, piece of each) of a chunk, in order."""
    data = _LOWER[data]
    start, end, text = words(data, at, _WORD)
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int32)
    column = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[_WORD[data]]))
    coded = column.dictionary_encode()
    return (coded.dictionary, coded.indices.to_numpy().astype(np.int64), text,
            np.cumsum(_BREAK[data])[start] + text if len(start) else text)


def _by_lang(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray):
    """(lang, distinct words, word numbers, pieces) for each language of a chunk."""
    distinct, code, text, piece = chunk_words(data, at)
    langs = part.column(part.schema.get_field_index("lang")).dictionary_encode()
    lang = langs.indices.to_numpy()[text]
    for i, name in enumerate(langs.dictionary.to_pylist()):
        of = lang == i
        if of.any():
            yield name, distinct, code[of], piece[of]


def suffix_codes(code: np.ndarray, piece: np.ndarray, size: int, longest: int) -> list[np.ndarray]:
    """Word numbers + 1 at distances 0 to longest - 1 of every word, 0 beyond its piece."""
    out = [code + 1]
    for k in range(1, longest):
        ahead = np.zeros(len(code), np.int64)
        if len(code) > k:
            inside = piece[k:] == piece[:-k]
            ahead[:-k][inside] = code[k:][inside] + 1
        out.append(ahead)
    return out


def _distinct(columns: list[np.ndarray], weight: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of number columns, sorted, and their (weighted) counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    opens = np.flatnonzero(new)
    counts = np.add.reduceat(np.ones(len(order), np.int64) if weight is None else weight[order], opens) if len(opens) else opens
    return [c[opens] for c in columns], counts


def _join(distinct: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    """Words joined by one space; number 0 is no word."""
    taken = [distinct.take(pa.array(c - 1, mask=c == 0)) for c in columns]
    return pc.binary_join_element_wise(*taken, " ", null_handling="skip")


def _prefix_counts(length: int, heavy: frozenset[tuple[str, str]]):
    """Texts -> (lang, prefix, n) of their ``length``-word prefixes; beyond one word, of
    those that extend a heavy prefix of one word less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            for lang, distinct, code, piece in _by_lang(part, data, at):
                columns = suffix_codes(code, piece, len(distinct), length)
                if length > 1:
                    of = columns[-1] > 0
                    of[of] = _heavy_rows(lang, distinct, [c[of] for c in columns[:-1]], heavy)
                    columns = [c[of] for c in columns]
                columns, n = _distinct(columns)
                prefix = _join(distinct, columns)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), prefix, pa.array(n)],
                                                 ["lang", "prefix", "n"])
    return run


def _heavy_rows(lang: str, distinct: pa.Array, columns: list[np.ndarray], heavy: frozenset[tuple[str, str]]) -> np.ndarray:
    """Which rows of word numbers are a heavy prefix of exactly so many words."""
    names = [p for x, p in heavy if x == lang and p.count(" ") == len(columns) - 1]
    found = np.zeros(len(columns[0]), bool)
    if not names:
        return found
    numbers = np.stack([pc.index_in(pa.array([p.split(" ")[k] for p in names], pa.string()), distinct)
                        .fill_null(-1).to_numpy() for k in range(len(columns))], 1) + 1
    size = np.int64(len(distinct) + 1)
    keys, rows = np.zeros(len(names), np.int64), np.zeros(len(found), np.int64)
    for k, c in enumerate(columns):
        keys, rows = keys * size + numbers[:, k], rows * size + c
    return np.isin(rows, keys[(numbers > 0).all(1)])


def _runs(groups: int, longest: int, heavy: frozenset[tuple[str, str]]):
    """Texts -> (grp, lang, suffixes, counts): a sorted run of distinct suffixes a group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in text_chunks(batches, max_bytes=CHUNK):
            for lang, distinct, code, piece in _by_lang(part, data, at):
                columns, n = _distinct(suffix_codes(code, piece, len(distinct), longest))
                grp = _group_of(lang, distinct, columns, groups, heavy)
                order = np.argsort(grp, kind="stable")
                grp, n = grp[order], n[order].astype(np.int64)
                lines = pc.binary_join_element_wise(_join(distinct, [c[order] for c in columns]), "", "\n")
                ends = lines.buffers()[1]
                offset = np.frombuffer(ends, np.int32)[lines.offset:lines.offset + len(lines) + 1]
                raw = lines.buffers()[2]
                opens = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
                closes = np.r_[opens[1:], len(grp)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp[opens]), pa.array([lang] * len(opens), pa.string()),
                     pa.array([pa.compress(raw[offset[x]:offset[y]], "zstd", asbytes=True)
                               for x, y in zip(opens, closes, strict=True)], pa.binary()),
                     pa.array([pa.compress(n[x:y].tobytes(), "zstd", asbytes=True)
                               for x, y in zip(opens, closes, strict=True)], pa.binary()),
                     pa.array(offset[closes] - offset[opens], pa.int64()), pa.array(closes - opens)],
                    ["grp", "lang", "suffixes", "counts", "n_bytes", "n_rows"])
    return run


_RUN = "grp bigint, lang string, suffixes binary, counts binary, n_bytes bigint, n_rows bigint"


def _word_hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes that deal words to groups (equal words to equal groups; nothing else hangs on them)."""
    data, at = utf8(distinct)
    return span_hash(prefix_hash(BYTE_CODES[data]), at[:-1], at[1:])


def _group_of(lang: str, distinct: pa.Array, columns: list[np.ndarray], groups: int, heavy: frozenset[tuple[str, str]]) -> np.ndarray:
    """The group of each suffix: a hash of its shortest prefix that is not heavy."""
    h = np.r_[np.uint64(0), _word_hashes(distinct)]
    tag = np.uint64(_lang_tag(lang))
    key = mix(h[columns[0]] ^ tag)
    over = np.ones(len(key), bool)
    for k in range(1, len(columns)):
        over[over] = _heavy_rows(lang, distinct, [c[over] for c in columns[:k]], heavy)
        if not over.any():
            break
        key[over] = mix(key[over] * GOLDEN + h[columns[k][over]])
    return (key % np.uint64(groups)).astype(np.int64)


def _lang_tag(lang: str) -> int:
    """Parts the groups of languages; a clash only makes two share groups."""
    return int.from_bytes(lang.encode()[-8:].rjust(8, b"\0"), "little")


def subtree(lines: pa.Array, counts: np.ndarray, longest: int, least: int) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """Suffix lines with counts -> (words, depth, total) of the nodes of two words or
    more with a total of at least ``least``."""
    split = pc.split_pattern(lines, " ")
    length = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    ends = split.offsets.to_numpy()
    flat = split.flatten().dictionary_encode()
    code = flat.indices.to_numpy().astype(np.int64) + 1
    columns = []
    for k in range(longest):
        c = np.zeros(len(length), np.int64)
        c[length > k] = code[ends[:-1][length > k] - ends[0] + k]
        columns.append(c)
    columns, leaf = _distinct(columns, counts)          # the leaves, in the tree's order
    out, depths, totals = [], [], []
    for depth in range(2, longest + 1):
        has = columns[depth - 1] > 0
        path, leaves = [c[has] for c in columns[:depth]], leaf[has]
        new = np.zeros(len(leaves), bool)
        new[:1] = True
        for c in path:
            new[1:] |= c[1:] != c[:-1]
        opens = np.flatnonzero(new)
        total = np.add.reduceat(leaves, opens) if len(opens) else opens
        opens, total = opens[total >= least], total[total >= least]
        out.append([np.zeros(len(opens), np.int64) if k >= depth else path[k][opens] for k in range(longest)])
        depths.append(np.full(len(opens), depth))
        totals.append(total)
    taken = [np.concatenate([o[k] for o in out]) for k in range(longest)]
    return ([flat.dictionary.take(pa.array(c - 1, mask=c == 0)) for c in taken], np.concatenate(depths).astype(np.int64),
            np.concatenate(totals).astype(np.int64))


def _build(longest: int, least: int, heavy: frozenset[tuple[str, str]]):
    """The runs of one group -> its frequent nodes; those above its prefixes are left out."""
    def run(table: pa.Table) -> pa.Table:
        out = []
        for lang in table.column("lang").unique().to_pylist():
            part = table.filter(pc.equal(table.column("lang"), lang))
            raw = [pa.decompress(x.as_py(), n.as_py(), "zstd", asbytes=True)
                   for x, n in zip(part.column("suffixes"), part.column("n_bytes"), strict=True)]
            counts = np.concatenate([np.frombuffer(pa.decompress(x.as_py(), 8 * n.as_py(), "zstd", asbytes=True), np.int64)
                                     for x, n in zip(part.column("counts"), part.column("n_rows"), strict=True)])
            data = np.frombuffer(b"".join(raw), np.uint8)
            close = np.flatnonzero(data == 10)
            offsets = np.r_[0, close + 1 - np.arange(1, len(close) + 1)].astype(np.int64)
            lines = pa.LargeStringArray.from_buffers(len(close), pa.py_buffer(offsets), pa.py_buffer(data[data != 10]))
            taken, depth, total = subtree(lines, counts, longest, least)
            joined = pc.binary_join_element_wise(*[t.cast(pa.string()) for t in taken], " ", null_handling="skip")
            # The node of a heavy prefix is split between groups.
            whole = pc.invert(pc.is_in(joined, pa.array([p for x, p in heavy if x == lang], pa.string())))
            joined = joined.filter(whole)
            out.append(pa.table({"lang": pa.array([lang] * len(joined), pa.string()), "phrase": joined,
                                 "n_words": pa.array(depth).filter(whole), "f": pa.array(total).filter(whole)}))
        return pa.concat_tables(out)
    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = MIN_COUNT, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """((lang, prefix, n) of all words, (lang, phrase, n_words, f) of all phrases of 2 to
    ``longest`` words that occur ``least`` times or more), both written."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    kind = "lang string, prefix string, n bigint"

    def counted(length: int, heavy: frozenset) -> DataFrame:
        rows = texts.mapInArrow(_prefix_counts(length, heavy), kind)
        return stage(rows.groupBy("lang", "prefix").agg(F.sum("n").alias("n")), f"collocation-prefixes-{length}")

    levels, heavy = [counted(1, frozenset())], frozenset()
    total = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # At most HEAVY_PREFIXES prefixes of a level pass this, whatever the input.
    budget = max(budget, -(-total // HEAVY_PREFIXES))
    for length in range(2, longest + 1):
        over = levels[-1].filter(F.col("n") > budget)
        new = frozenset((r[0], r[1]) for r in over.select("lang", "prefix").collect())
        heavy |= new
        if not new:
            break
        if length < longest:
            levels.append(counted(length, heavy))
    groups = max(1, -(-2 * total // budget))
    runs = texts.mapInArrow(_runs(groups, longest, heavy), _RUN)
    # Nodes in the groups; nodes above them have their prefix frequency.
    nodes = runs.groupBy("grp").applyInArrow(_build(longest, least, heavy), "lang string, phrase string, n_words bigint, f bigint")
    for length, level in enumerate(levels[1:], 2):
        above = level.filter((F.col("n") > budget) & (F.col("n") >= least))
        nodes = nodes.unionByName(above.select("lang", F.col("prefix").alias("phrase"), F.lit(length).cast("bigint").alias("n_words"),
                                               F.col("n").alias("f")))
    return levels[0], stage(nodes, "collocation-nodes")


def _run_of(phrase: str, first: Column, n: Column) -> Column:
    """``n`` words of a phrase, from its word number ``first``."""
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def scored(unigrams: DataFrame, phrases: DataFrame, longest: int = LONGEST, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, n_words, a, l, r, score): every phrase with its weakest cut."""
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    least = phrases.agg(F.min("f")).scalar()        # no part of a phrase is rarer than the phrase
    single = unigrams.filter(F.col("n") >= least).select("lang", F.col("prefix").alias("part"), F.col("n").alias("f"))
    known = stage(known.unionByName(single), "collocation-parts")
    n = F.col("n_words").cast("int")
    cuts = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.struct(
        k.alias("k"), _run_of("phrase", F.lit(1), k).alias("left"), _run_of("phrase", k + 1, n - k).alias("right")))
    rows = phrases.select("lang", "phrase", "n_words", F.col("f").alias("a"), F.explode(cuts).alias("cut")).select(
        "lang", "phrase", "n_words", "a", "cut.*")
    rows = rows.join(known.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    rows = rows.join(known.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr(f"cast({scale} * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) as decimal(38,0)) "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    return rows.withColumn("score", score).groupBy("lang", "phrase", "n_words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")).select("lang", "phrase", "n_words", "a", "best.l", "best.r", "best.score")


def covered(phrases: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """(lang, phrase) of phrases inside a longer one with ``percent`` of their count or more."""
    longer = phrases.filter("n_words > 2").select("lang", "n_words", "phrase", F.col("f").alias("longer"))
    n = F.col("n_words").cast("int")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda size: F.transform(
        F.sequence(F.lit(1), n - size + 1), lambda i: _run_of("phrase", i, size))))
    most = (longer.select("lang", "longer", F.explode(inner).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return most.join(phrases, ["lang", "phrase"]).filter(100 * F.col("longer") >= percent * F.col("f")).select("lang", "phrase")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """``rank`` of the first ``top`` rows of each language.  Many rows are thinned to the
    first ``top`` of random parts of a language, again and again, before one task ranks them."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]

    def parts_of(rows: DataFrame) -> int:
        most = rows.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
        return -(-most // max(RANKED, 4 * top))

    while (parts := parts_of(rows)) > 1:
        part = F.pmod(F.xxhash64("phrase"), F.lit(parts)).alias("part")
        best = Window.partitionBy("lang", "part").orderBy(*order)
        rows = stage(rows.withColumn("part", part).withColumn("rank", F.row_number().over(best))
                     .filter(F.col("rank") <= top).drop("rank", "part"), "collocation-thinned")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP, longest: int = LONGEST, least: int = MIN_COUNT, scale: int = SCALE,
                 percent: int = COVER_PERCENT, budget: int = BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``top`` phrases of each language."""
    unigrams, phrases = phrase_counts(docs, longest, least, budget)
    rows = scored(unigrams, phrases, longest, scale).join(covered(phrases, percent), ["lang", "phrase"], "left_anti")
    total = unigrams.groupBy("lang").agg(F.sum("n").alias("n"))
    best = ranked(stage(rows, "collocation-scored"), top)
    return best.join(broadcast_if_small(stage(total, "collocation-totals")), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
