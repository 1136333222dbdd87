import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq

from llm_fixtures import frame  # noqa: F401
from torque.llm import suffix_dedup as S
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, length):
    places = defaultdict(set)
    raw = {}
    for i, text in set(docs):
        b = (text or "").encode()
        raw[i, text] = b
        for p in range(len(b) - length + 1):
            places[hashlib.md5(b[p:p + length]).digest()].add((i, text, p))
    gone = {k: bytearray(len(b)) for k, b in raw.items()}
    for found in places.values():
        if len(found) > 1:
            for i, text, p in found:
                gone[i, text][p:p + length] = b"\1" * length
    out = []
    for i, text in docs:
        b, g = raw[i, text], gone[i, text]
        spans = sum(1 for p in range(len(b)) if g[p] and (p == 0 or not g[p - 1]))
        kept = bytes(x for x, y in zip(b, g, strict=True) if not y)
        out.append((i, len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute(docs, 400)
    assert any(r[2] for r in want)
    assert got(QUERIES["op3_suffix_array_dedup"](spark, SF)) == want


def test_random_repeats(frame, spark):
    rng = random.Random(11)

    def some(n):
        return "".join(rng.choice("abé ") for _ in range(n))

    parts = [some(rng.randint(5, 90)) for _ in range(14)]
    docs = []
    for i in range(70):
        text = "".join(rng.choice(parts) if rng.random() < 0.6 else some(rng.randint(1, 25)) for _ in range(rng.randint(0, 7)))
        docs.append((i, text))
    docs += [(100, docs[5][1]), (100, docs[5][1]), (101, "z" * 500), (102, None), (103, ""), (104, "y" * 20), (None, parts[0] * 3)]
    df = frame(docs, ", key string, spans int, lo int")
    assert got(S.suffix_dedup(df, 20, 10)) == brute(docs, 20)
    assert got(S.suffix_dedup(df, 40, 13, shard=5)) == brute(docs, 40)
    assert got(S.suffix_dedup(df, 20, 10, hot=2)) == brute(docs, 20)       # most triggers by window hashes
    assert got(S.suffix_dedup(spark.createDataFrame([], df.schema))) == []


def test_very_long_text(frame):
    long = "".join(f"{i:07d}" for i in range(60_000))
    docs = [(1, long), (2, long[100_000:300_000]), (3, "q" + long[5:404] + "q"), (4, "p" + long[5:405] + "q")]
    by = {r["doc_id"]: r for r in S.suffix_dedup(frame(docs)).collect()}
    assert (by[2]["n_removed"], by[3]["n_removed"], by[4]["n_removed"]) == (200_000, 0, 400)
    assert (by[1]["n_removed"], by[1]["n_spans"]) == (200_400, 2)


def test_suffix_arrays_find_every_repeated_window():
    """Shards of phrases against a plain count of their windows, trigger by trigger."""
    rng, length = random.Random(3), 12
    core, texts, at, heavy = [], [], [], []
    for c in range(12):
        trigger = bytes(rng.choice(b"ab") for _ in range(5))
        heads, tails = ([bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 7))) for _ in range(4)] for _ in range(2))
        for _ in range(rng.randint(1, 9)):
            head, tail = rng.choice(heads), rng.choice(tails) + bytes(rng.choice(b"ab") for _ in range(7))
            if len(head + trigger + tail) >= length:
                core.append(c)
                texts.append(head + trigger + tail)
                at.append(min(len(head), len(head + trigger + tail) - length))
                heavy.append(rng.random() < 0.1)
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            if p <= at[i]:
                places[core[i], at[i] - p, t[p:p + length]].append((i, p))
    want = {x for found in places.values() if len(found) + sum(heavy[i] for i, _ in found) > 1 for x in found}
    hit = S.repeated_windows(np.array(core), texts, np.array(at), np.array(heavy), length)
    assert want and {(int(i), int(p)) for i, p in zip(*np.nonzero(hit), strict=True)} == want


def test_agreement_of_sorted_texts():
    texts = [b"", b"a", b"ab", b"ab", b"abc", b"b", b"", b"\0", b"\xff"]
    order, agree = S._sorted_agreement(np.array([1, 1, 1, 1, 1, 1, 2, 2, 2]), texts)
    assert [texts[i] for i in order] == [b"", b"a", b"ab", b"ab", b"abc", b"b", b"", b"\0", b"\xff"]
    assert agree.tolist() == [-1, 0, 1, 2, 2, 0, -1, 0, 0]
