"""LM scoring: cross-entropy difference of two matched n-gram models.

The target model is counted over the trusted documents (labelled of good
quality), the background model over all.  Both share one vocabulary (all words
of the corpus and one unseen word), all its pairs and one smoothing, so their
difference speaks of the texts and not of the models.  Words are white-space
words with A-Z lower-cased.

    P(w)     = (c(w) + ALPHA) / (N + ALPHA * (words + 1))
    P(w | v) = (c(v, w) + MU * P(w)) / (c(v) + MU),  c(v): the pairs that begin with v

A document's score is its mean loss per token under the target model less that
under the background model: the lower, the more target-like.

All documents are counted and every word and pair keeps its own count; nothing
that grows with the corpus reaches the driver or is broadcast.  Documents are
dealt to blocks of about ``BLOCK_BYTES`` of text by a hash of the row.  A block
sends its distinct words and pairs (64-bit hashes, packed, sorted) to shards by
hash range; a shard adds up what the blocks send and answers each block in the
order it sent; the block then scores its texts.  A code is sent once a block, so
a pair that all documents hold costs one entry a block.

Edge cases: a null, empty or white-space text has no tokens, losses and score 0;
without trusted documents the target model is the smoothing alone; a document
labelled twice is trusted if one label says so; a null ``doc_id`` is not
trusted; repeated rows count as often as they stand there and get equal rows;
an empty table gives an empty one; columns beside ``doc_id`` and ``text`` are
ignored.  A caller may ask for bounded models (``vocabulary``, ``pairs``: the
most frequent words and pairs, equal counts by hash); the query does not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, GOLDEN, MIX_1, broadcast_if_small, conf, mix, not_space, prefix_hash, span_hash, stage, text_chunks, words

ALPHA, MU = 0.5, 50.0
#: Text bytes of a block of documents.
BLOCK_BYTES = 4 << 20
#: Text bytes that a block looks at once.
LOOK_BYTES = 1 << 19
#: Stands for the word before a text's first.
START = mix(GOLDEN.reshape(1) * MIX_1)
#: Most rows that a limit can name.
MOST = (1 << 31) - 1
#: Counts that a task holds before it hands them on.
HELD = 2_000_000
_NOT_SPACE = not_space()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def word_ids(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word."""
    data = _LOWER[data]
    start, end, text = words(data, at, _NOT_SPACE)
    return span_hash(prefix_hash(BYTE_CODES[data]), start, end).view(np.int64), text


@dataclass
class Models:
    """Both models, bounded: a column each for background and target."""
    vocabulary: np.ndarray      # sorted word hashes; then the unknown word, then the text's start
    word: np.ndarray            # (words + 1, 2) probabilities
    pairs: np.ndarray           # sorted v * (words + 2) + w
    pair: np.ndarray            # (pairs, 2) counts
    context: np.ndarray         # (words + 2, 2) counts of kept pairs by their first word

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def pair_codes(self, hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(v, w, code) of each token and the one before it in its text."""
        w = self.ids(hashes)
        v = np.r_[0, w[:-1]]
        v[np.r_[True, text[1:] != text[:-1]][:len(v)]] = len(self.vocabulary) + 1
        return v[:len(w)], w, v[:len(w)] * (len(self.vocabulary) + 2) + w

    def losses(self, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
        """(tokens, 2): minus the log probability of each token."""
        v, w, code = self.pair_codes(hashes, text)
        count = np.zeros((len(w), 2))
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            count = np.where((self.pairs[at] == code)[:, None], self.pair[at], 0)
        return -np.log((count + MU * self.word[w]) / (self.context[v] + MU))


def _counted(count):
    """Rows (code, n, t) from (hashes, text, trusted) of the chunks; merged before they leave the task."""
    def merge(parts):
        code = np.concatenate([p[0] for p in parts])
        distinct, back = np.unique(code, return_inverse=True)
        return [(distinct, *[np.bincount(back, np.concatenate([p[i] for p in parts]), len(distinct)).astype(np.int64)
                             for i in (1, 2)])]

    def batch(parts):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in merge(parts)[0]], ["code", "n", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for part, data, at in text_chunks(batches):
            hashes, text = word_ids(data, at)
            trusted = part.column(1).is_valid().to_numpy(zero_copy_only=False)
            held += merge([(count(hashes, text), np.ones(len(text)), trusted[text])])
            if sum(len(p[0]) for p in held) > HELD:
                held = merge(held)
                if len(held[0][0]) > HELD // 2:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)
    return run


def _sums(docs: DataFrame, count, name: str) -> DataFrame:
    return stage(docs.mapInArrow(_counted(count), "code bigint, n bigint, t bigint")
                 .groupBy("code").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), name)


def _top(counts: DataFrame, most: int) -> np.ndarray:
    """The ``most`` most frequent codes with both counts, sorted by code: a bounded table."""
    t = counts.orderBy(F.desc("n"), "code").limit(most).toArrow()
    rows = np.stack([t.column(c).to_numpy() for c in ("code", "n", "t")], axis=1) if t.num_rows else np.zeros((0, 3), np.int64)
    return rows[np.argsort(rows[:, 0])]


def _marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, is_target): is_target is null but for trusted documents."""
    trusted = (labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
               .select("doc_id").distinct().withColumn("is_target", F.lit(1)))
    return (docs.select("doc_id", "text").join(broadcast_if_small(trusted), "doc_id", "left")
            .select("doc_id", "text", "is_target"))


def _schema(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, n_tokens bigint, target_loss double, background_loss double, score double"


def _scored(doc_id: pa.Array, text: np.ndarray, loss: np.ndarray) -> pa.RecordBatch:
    n = np.bincount(text, minlength=len(doc_id))
    mean = [np.bincount(text, loss[:, i], len(doc_id)) / np.maximum(n, 1) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(n.astype(np.int64)), pa.array(mean[1]), pa.array(mean[0]), pa.array(mean[1] - mean[0])],
        ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def train(docs: DataFrame, labels: DataFrame, vocabulary: int = MOST, pairs: int = MOST) -> Models:
    """Bounded models: the most frequent words and pairs."""
    both = _marked(docs, labels).select("text", "is_target")
    counts = _sums(both, lambda hashes, text: hashes, "lm-words")
    total = counts.agg(F.sum("n"), F.sum("t")).first()
    top = _top(counts, vocabulary)
    n = np.array([[x or 0 for x in total]], np.float64)
    count = np.vstack([top[:, 1:], n - top[:, 1:].sum(axis=0)])         # the unknown word last
    word = (count + ALPHA) / (n + ALPHA * len(count))
    size = len(top) + 2
    models = Models(top[:, 0].copy(), word, np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros((size, 2)))
    sent = docs.sparkSession.sparkContext.broadcast(models)             # the vocabulary alone so far
    kept = _top(_sums(both, lambda hashes, text: sent.value.pair_codes(hashes, text)[2], "lm-pairs"), pairs)
    context = np.stack([np.bincount(kept[:, 0] // size, kept[:, i], size) for i in (1, 2)], axis=1)
    return Models(models.vocabulary, word, kept[:, 0].copy(), kept[:, 1:].astype(np.float64), context)


def _bounded_scores(docs: DataFrame, labels: DataFrame, vocabulary: int, pairs: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, vocabulary, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for part, data, at in text_chunks(batches):
            hashes, text = word_ids(data, at)
            loss = models.losses(hashes, text)
            yield _scored(part.column(0), text, loss)

    return docs.select("doc_id", "text").mapInArrow(run, _schema(docs))


# -- all words and pairs -------------------------------------------------------

def _pack(x: np.ndarray) -> bytes:
    """64-bit values by byte planes, which compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(raw: bytes | pa.Buffer, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


def _pair_codes(w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word before, pair code) of each token; first: it begins its text."""
    v = np.r_[START, w[:-1]][:len(w)]
    v[first] = START
    return v, mix(v * MIX_1 + w)


def _add(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, their counts): counts are rows of numbers a code."""
    distinct, back = np.unique(np.concatenate(codes), return_inverse=True)
    counts = np.concatenate(counts, axis=1)
    return distinct, np.stack([np.bincount(back, c, len(distinct)).astype(np.int64) for c in counts])


def _tokens(block: pa.Table):
    """(rows, word hashes, text index, begins its text) of the chunks of a block."""
    for part, data, at in text_chunks(block.to_batches(), max_bytes=LOOK_BYTES):
        hashes, text = word_ids(data, at)
        yield part, hashes.view(np.uint64), text, np.r_[True, text[1:] != text[:-1]][:len(text)]


def _block_counts(block: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, counts) of the block's pairs (n, t) and words (n, t, n and t before another)."""
    kinds = [([np.zeros(0, np.uint64)], [np.zeros((k, 0), np.int64)]) for k in (2, 4)]
    for part, w, text, first in _tokens(block):
        t = part.column(part.schema.get_field_index("is_target")).is_valid().to_numpy(zero_copy_only=False)[text].astype(np.int64)
        one, none = np.ones(len(w), np.int64), np.zeros(len(w), np.int64)
        v, pair = _pair_codes(w, first)
        word = _add([w, v], [np.stack([one, t, none, none]), np.stack([none, none, one, t])])
        for (codes, counts), (code, count) in zip(kinds, (_add([pair], [np.stack([one, t])]), word), strict=True):
            codes.append(code)
            counts.append(count)
    return [_add(codes, counts) for codes, counts in kinds]


def _bounds(codes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of the sorted codes begins and the last one ends."""
    shard = ((codes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))


def _send(shards: int):
    """A block's rows (block, shard, width, codes, counts)."""
    def run(block: pa.Table) -> pa.Table:
        number, rows = block.column("block")[0].as_py(), []
        for codes, counts in _block_counts(block):
            at = _bounds(codes, shards)
            for s in np.flatnonzero(at[1:] > at[:-1]).tolist():
                some = codes[at[s]:at[s + 1]]
                rows.append((number, s, len(counts), _pack(np.diff(some, prepend=np.uint64(0))),
                             _pack(counts[:, at[s]:at[s + 1]].reshape(-1))))
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in
                         enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                        ["block", "shard", "width", "codes", "counts"])
    return run


def _answer(sent: pa.Table) -> pa.Table:
    """A shard's rows (block, shard, width, counts): what the other blocks have of each code
    that a block sent, in its order; and a row without block of the shard's words, n and t."""
    out, shard, whole = [], sent.column("shard")[0].as_py(), np.zeros(3, np.int64)
    block, widths = (sent.column(c).to_pylist() for c in ("block", "width"))
    for width in (2, 4):
        rows = [i for i, k in enumerate(widths) if k == width]
        if not rows:
            continue
        codes = [np.cumsum(_unpack(sent.column("codes")[i].as_buffer(), np.uint64), dtype=np.uint64) for i in rows]
        own = [_unpack(sent.column("counts")[i].as_buffer(), np.int64).reshape(width, -1) for i in rows]
        distinct, counts = _add(codes, own)
        for i, code, less in zip(rows, codes, own, strict=True):
            others = counts[:, np.searchsorted(distinct, code)] - less
            out.append((block[i], shard, width, _pack(others.reshape(-1)), None, None, None))
        if width == 4:
            whole = np.r_[np.count_nonzero(counts[0]), counts[:2].sum(axis=1)]
    out.append((None, shard, None, None, *whole.tolist()))
    names = ("block", "shard", "width", "counts", "words", "n", "t")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], list(names))


def _score(words: int, total: np.ndarray):
    """A block's documents and the answers to it -> their scores."""
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("width", "shard", "counts")), strict=True),
                      key=lambda r: r[:2])
        found = [np.concatenate([np.zeros((width, 0), np.int64)] + [_unpack(r[2], np.int64).reshape(width, -1)
                                                                    for r in rows if r[0] == width], axis=1) for width in (2, 4)]
        (pairs, own_pairs), (known, own_words) = _block_counts(block)
        found = [found[0] + own_pairs, found[1] + own_words]
        pair = found[0].T
        smooth = MU * (found[1][:2].T + ALPHA) / (total + ALPHA * (words + 1))
        context = found[1][2:].T + MU
        out = []
        for part, w, text, first in _tokens(block):
            v, code = _pair_codes(w, first)
            at_w, at_v, at_pair = (np.searchsorted(table, distinct)[back] for table, (distinct, back) in (
                (table, np.unique(x, return_inverse=True)) for table, x in ((known, w), (known, v), (pairs, code))))
            loss = -np.log((pair[at_pair] + smooth[at_w]) / context[at_v])
            out.append(_scored(part.column(part.schema.get_field_index("doc_id")), text, loss))
        return pa.Table.from_batches(out)
    return run


def _exact_scores(docs: DataFrame, labels: DataFrame, block_bytes: int) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    # The row alone says its block, so that both passes see the same blocks.
    both = _marked(docs, labels).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    sent = both.groupBy("block").applyInArrow(
        _send(blocks), "block int, shard int, width int, codes binary, counts binary")
    # What this query shuffled is not read again: its files go when it ends.
    with conf(docs.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        answers = stage(sent.groupBy("shard").applyInArrow(
            _answer, "block int, shard int, width int, counts binary, words bigint, n bigint, t bigint"), "lm-counts")
    words, n, t = (x or 0 for x in answers.agg(F.sum("words"), F.sum("n"), F.sum("t")).first())
    back = answers.filter("block is not null").select("block", "shard", "width", "counts")
    return (both.groupBy("block").cogroup(back.groupBy("block"))
            .applyInArrow(_score(words, np.array([n, t], np.float64)), _schema(docs)))


def lm_scores(docs: DataFrame, labels: DataFrame, vocabulary: int | None = None, pairs: int | None = None,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) of every row, by all words
    and pairs unless a bound is given."""
    if vocabulary is None and pairs is None:
        return _exact_scores(docs, labels, block_bytes)
    return _bounded_scores(docs, labels, MOST if vocabulary is None else vocabulary, MOST if pairs is None else pairs)
