"""Segmentation into the pieces of a SentencePiece BPE model, by dynamic programming.

BPE merges the best-scored adjacent pair again and again.  Two facts turn its
result into a table over prefixes: the encoding of a prefix that ends at one of
its token ends is a prefix of the encoding, and a sequence of pieces is what
BPE gives if and only if each adjacent pair of them is (encoding the two
pieces' text gives the same two).  So at each end ``i`` of a word exactly one
piece fits behind the piece that ends where it begins.  The table holds that
piece (a backpointer) and the exact token count of every prefix.

Words of equal length advance together in numpy: hashes of all substrings that
end at ``i`` probe the sorted piece keys, pairs are looked up in a sorted table,
and the fitting piece is taken by a maximum over the candidate lengths.

No piece goes from another character to a space, nor holds a line feed, so a
text is cut there first (:func:`tokens`); :class:`Pieces` checks both of its model.
A worker segments each distinct word once and keeps its ids (:class:`Store`); a
text's ids are gathered from there by word numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import GOLDEN, mix, powers

SPACE = "▁"
#: Words kept in a worker's cache (results are the same with any number).
CACHE_WORDS = 250_000
#: Pairs of pieces that a worker keeps.
KEPT_PAIRS = 1_000_000
_UPPER = np.uint64(44)
#: Table entries (words x ends) advanced at once.
ENTRIES = 1 << 18


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        self.text = [sp.id_to_piece(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(self.size)]
        self.byte_ids = [0] * 256
        for i in range(self.size):
            if sp.is_byte(i):
                self.byte_ids[int(self.text[i][3:5], 16)] = i
        if not all(self.byte_ids):
            raise ValueError("the model must have byte fallback")
        if sp.normalize("ﬁ  a\n") != SPACE + "ﬁ" + SPACE * 2 + "a\n":
            raise ValueError("the model must not normalise texts beyond a leading space")
        self.score = [sp.get_score(i) for i in range(self.size)]
        self.id_of = {t: i for i, t in enumerate(self.text) if not special[i]}
        if any(SPACE in t.lstrip(SPACE) or "\n" in t for t in self.id_of):
            raise ValueError("a piece crosses a word's start or a line's end")
        self.longest = max(map(len, self.id_of))
        self._fits: dict[int, bool] = {}                    # pairs seen lately
        self._pairs = np.zeros(0, np.int64)                 # all others, sorted
        self._pairs_fit = np.zeros(0, bool)
        keys = np.array([self._key(t) for t in self.id_of], np.uint64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.fromiter(self.id_of.values(), np.int64)[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("piece keys collide")
        # Where the sorted keys of the same upper bits begin, and how many have them at most.
        self._from = np.searchsorted(self.keys >> _UPPER, np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        self._some = np.diff(self._from) > 0
        self._crowd = int(np.diff(self._from).max())
        # Pairs seen lately by a hash of theirs: most are answered here.
        self._slot, self._slot_fits = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return mix((np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)) * GOLDEN)

    def _key(self, text: str) -> np.uint64:
        with np.errstate(over="ignore"):
            return (self._codes(text) * powers(len(text))[0][:len(text)]).sum()

    # -- pairs ------------------------------------------------------------------
    def _merge(self, text: str) -> list[str]:
        """BPE by its definition, for the text of two pieces at most."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.id_of.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may stand behind ``before`` (-1: a text's start or a
        character outside the vocabulary)."""
        code = (before + 1) * self.size + piece
        known = self._fits.get(code)
        if known is None:
            alone = [self.text[piece]] if before < 0 else [self.text[before], self.text[piece]]
            known = self._fits[code] = self._merge("".join(alone)) == alone
        return known

    def _fit(self, pairs: np.ndarray) -> np.ndarray:
        """``fits`` for codes (before + 1) * size + piece."""
        slot = ((pairs.view(np.uint64) * GOLDEN) >> _UPPER).astype(np.int64)
        out, new = self._slot_fits[slot], np.flatnonzero(self._slot[slot] != pairs)
        if len(new):
            out[new] = self._look_up(pairs[new])
            self._slot[slot[new]], self._slot_fits[slot[new]] = pairs[new], out[new]
        return out

    def _look_up(self, pairs: np.ndarray) -> np.ndarray:
        out, new = np.zeros(len(pairs), bool), np.ones(len(pairs), bool)
        if len(self._pairs):
            at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
            new = self._pairs[at] != pairs
            out = self._pairs_fit[at] & ~new
        if new.any():
            codes, back = np.unique(pairs[new], return_inverse=True)
            out[new] = np.array([self.fits(c // self.size - 1, c % self.size) for c in codes.tolist()], bool)[back]
        return out

    def _settle(self) -> None:
        """Move the pairs seen lately to the sorted ones."""
        if len(self._fits) > 2000 + len(self._pairs) // 20:
            codes = np.concatenate([self._pairs, np.fromiter(self._fits, np.int64)])
            ok = np.concatenate([self._pairs_fit, np.fromiter(self._fits.values(), bool)])
            if len(codes) > KEPT_PAIRS:             # the latest stay
                codes, ok = codes[-len(self._fits):], ok[-len(self._fits):]
            order = np.argsort(codes, kind="stable")
            self._pairs, self._pairs_fit, self._fits = codes[order], ok[order], {}

    # -- tables -----------------------------------------------------------------
    def table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words of one length n, (last, size, count), each len(words) x (n + 1):
        the id of the piece that ends a prefix's encoding (-1: a character outside
        the vocabulary, as bytes), its length, and the prefix's token count."""
        n, w = len(words[0]), len(words)
        last = np.full((w, n + 1), -1, np.int64)
        size = np.zeros((w, n + 1), np.int32)
        count = np.zeros((w, n + 1), np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(w, n)
        n_bytes = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        up, down = powers(n + 1)
        prefix = np.zeros((w, n + 1), np.uint64)
        np.cumsum(mix((chars.astype(np.uint64) + np.uint64(1)) * GOLDEN) * up[:n], axis=1, out=prefix[:, 1:])
        for i in range(1, n + 1):
            lo = max(0, i - self.longest)
            keys = (prefix[:, i, None] - prefix[:, lo:i]) * down[lo:i]
            upper = (keys >> _UPPER).astype(np.int32)
            rows, j = np.nonzero(self._some[upper])     # some piece has these upper bits
            keys, at = keys[rows, j], self._from[upper[rows, j]]
            for _ in range(self._crowd - 1):
                at = at + (self.keys[at] < keys)
                at = np.minimum(at, len(self.keys) - 1)
            hit = self.keys[at] == keys
            rows, j, piece = rows[hit], j[hit] + lo, self.key_ids[at[hit]]
            ok = self._fit((last[rows, j] + 1) * self.size + piece)
            # One candidate fits, so the maximum over lengths is that one.
            np.maximum.at(last[:, i], rows[ok], piece[ok])
            size[:, i] = 1
            size[rows[ok], i] = i - j[ok]
            steps = np.where(last[:, i] >= 0, 1, n_bytes[:, i - 1])
            count[:, i] = count[np.arange(w), i - size[:, i]] + steps
        return last, size, count

    def segment(self, words: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """(words, their ids end to end, ids of each), by walking the backpointers."""
        for group, (last, size, _) in self._tables(words):
            n, rows = len(group[0]), np.arange(len(group))
            at, columns = np.full(len(group), n), []
            while at.any():
                piece = np.where(at > 0, last[rows, at], -2)
                columns.append((piece, at.copy()))
                at = at - np.where(at > 0, size[rows, at], 0)
            ids = np.stack([c[0] for c in reversed(columns)], axis=1)
            strange = (ids == -1).any(axis=1)
            known = ids[~strange]
            yield ([group[k] for k in np.flatnonzero(~strange)], known[known != -2].astype(np.int32),
                   (known != -2).sum(axis=1))
            if strange.any():
                ends = np.stack([c[1] for c in reversed(columns)], axis=1)
                some = np.flatnonzero(strange).tolist()
                spelt = [[i for p, e in zip(ids[k].tolist(), ends[k].tolist(), strict=True) if p != -2
                          for i in ([p] if p >= 0 else [self.byte_ids[b] for b in group[k][e - 1].encode()])] for k in some]
                yield ([group[k] for k in some], np.array([i for row in spelt for i in row], np.int32),
                       np.array([len(row) for row in spelt]))

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """word -> its ids as packed 32-bit integers."""
        out = {}
        for group, flat, n in self.segment(words):
            ends = np.cumsum(n)
            out.update((w, flat[e - k:e].astype("<i4").tobytes()) for w, e, k in zip(group, ends, n, strict=True))
        return out

    def count_words(self, words: Iterable[str]) -> dict[str, int]:
        """word -> its token count."""
        return {w: c for group, (_, _, count) in self._tables(words)
                for w, c in zip(group, count[:, -1].tolist(), strict=True)}

    def _tables(self, words: Iterable[str]):
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            step = max(1, ENTRIES // (n + 1))
            for lo in range(0, len(group), step):
                yield group[lo:lo + step], self.table(group[lo:lo + step])
                self._settle()


_SPLIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def split(text: str) -> list[str]:
    """The words of a text between which no piece reaches, the leading space added."""
    return _SPLIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def tokens(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word numbers in order, first word of each text and the end) of the
    texts data[at[i]:at[i + 1]].  Words are those of :func:`split` with plain spaces."""
    mark = SPACE.encode()
    if (raw := data.tobytes()).find(mark) >= 0:
        texts = [raw[a:b].replace(mark, b" ") for a, b in zip(at[:-1], at[1:], strict=True)]
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
    some = np.diff(at) > 0
    data = np.insert(data, at[:-1][some], 0x20)
    at = at + np.r_[0, np.cumsum(some)]
    if not len(data):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    space, feed = data == 0x20, data == 0x0A
    opens = feed.copy()
    opens[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
    opens[at[:-1][some]] = True
    start = np.flatnonzero(opens)
    column = pa.StringArray.from_buffers(len(start), pa.py_buffer(np.r_[start, len(data)].astype(np.int32)), pa.py_buffer(data))
    coded = column.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(start, at)


class Store:
    """A worker's known words, kept from task to task: ids of each end to end, and
    whether they decode to the word (results are the same with any number kept)."""

    def __init__(self, path: str):
        self.pieces = load(path)
        out = [t.replace(SPACE, " ").encode() if t in self.pieces.id_of else b"" for t in self.pieces.text]
        for b, i in enumerate(self.pieces.byte_ids):
            out[i] = bytes([b])
        self.nothing = out.index(b"")       # a control piece
        self.length = np.array([len(x) for x in out], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(out), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.good = np.zeros(0, bool)

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the ids end to end, where each id's bytes end)."""
        n = self.length[ids]
        end = np.cumsum(n)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[ids] - end + n, n)
        return self.bytes[at], end

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        """The number of each word; unknown ones are segmented first, all together."""
        words = pc.replace_substring(distinct, " ", SPACE).to_pylist()
        if len(self.number) > CACHE_WORDS:
            self._clear()
        new = [w for w in words if w not in self.number]
        if new:
            flats, lengths, good = [self.flat], [], [self.good]
            for group, flat, n in self.pieces.segment(new):
                self.number.update(zip(group, range(len(self.number), len(self.number) + len(group)), strict=True))
                flats.append(flat)
                lengths.append(n)
                good.append(self._round_trip(group, flat, n))
            self.flat, self.good = np.concatenate(flats), np.concatenate(good)
            self.first = np.r_[self.first, self.first[-1] + np.cumsum(np.concatenate(lengths))]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def _round_trip(self, group: list[str], flat: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ids of each word decode to it."""
        raw, ends = self.decoded(flat)
        got = np.diff(np.r_[0, ends][np.r_[0, np.cumsum(n)]])
        plain = "".join(group).replace(SPACE, " ")
        length = pc.binary_length(pc.replace_substring(pa.array(group, pa.string()), SPACE, " ")).to_numpy()
        if np.array_equal(got, length) and raw.tobytes() == plain.encode():
            return np.ones(len(group), bool)
        at, raw = np.r_[0, np.cumsum(got)], raw.tobytes()
        return np.array([raw[a:b] == w.replace(SPACE, " ").encode() for a, b, w in zip(at[:-1], at[1:], group, strict=True)], bool)

    def ids(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words end to end, where each word's end)."""
        n = self.first[number + 1] - self.first[number]
        end = np.cumsum(n)
        at = np.arange(end[-1] if len(end) else 0) + np.repeat(self.first[number] - end + n, n)
        return self.flat[at], end


_MODELS: dict[str, Pieces] = {}
_STORES: dict[str, Store] = {}


def store(path: str) -> Store:
    if path not in _STORES:
        _STORES[path] = Store(path)
    return _STORES[path]


def load(path: str) -> Pieces:
    """The model, read once in each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]
