import hashlib
import random
import re

import numpy as np
import pyarrow.parquet as pq

from llm_fixtures import frame  # noqa: F401
from torque.llm import substring_dedup as S
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, length):
    words = [((i is None, i if i is not None else 0), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            first[k] = min(i, first.get(k, i))
    out = []
    for (i, _), (order, w) in zip(docs, words, strict=True):
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < order:
                gone.update(range(p, p + length))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute(docs, 50)
    assert any(r[2] for r in want)
    assert got(QUERIES["op10_substring_dedup"](spark, SF)) == want


def test_random_passages(frame, spark):
    rng = random.Random(2)

    def some(n):
        return [rng.choice("abcé") for _ in range(n)]

    parts = [some(rng.randint(3, 30)) for _ in range(12)]
    docs = []
    for i in range(80):
        w = [x for _ in range(rng.randint(0, 7)) for x in (rng.choice(parts) if rng.random() < 0.6 else some(rng.randint(1, 6)))]
        docs.append((i, "".join(x + rng.choice([" ", "\n", "  "]) for x in w)))
    docs += [(90, docs[6][1]), (90, docs[6][1]), (91, None), (92, " \n"), (93, "a " * 300), (94, "a " * 200)]
    docs += [(None, docs[8][1] + " x"), (None, "q " * 40)]
    df = frame(docs, ", key string, spans int, doc int")
    assert got(S.substring_dedup(df, 10, 5)) == brute(docs, 10)
    assert got(S.substring_dedup(df, 12, 9)) == brute(docs, 12)
    assert got(S.substring_dedup(spark.createDataFrame([], df.schema))) == []


def test_small_blocks_text_ids_and_repeated_rows(spark):
    rng = random.Random(7)
    parts = [" ".join(rng.choice("abcd") for _ in range(20)) for _ in range(6)]
    docs = [(f"d{i % 37}", " ".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(90)]
    docs += [("z", parts[0] + " " + parts[1])] * 40 + [(None, parts[0] + " " + parts[1])] * 3
    df = spark.createDataFrame(docs, "doc_id string, text string").repartition(5)
    rows = [(i, t) for i, t in docs]
    ranked = {i: n for n, i in enumerate(sorted({i for i, _ in rows if i is not None}))}
    back = {n: i for i, n in ranked.items()} | {None: None}
    want = sorted(((back[r[0]], *r[1:]) for r in brute([(None if i is None else ranked[i], t) for i, t in rows], 10)), key=repr)
    assert got(S.substring_dedup(df, 10, 5, block_bytes=500)) == want


def test_located_phrases_stand_in_two_documents(frame):
    docs = [(1, " ".join(f"a{i}" for i in range(40))), (2, " ".join(f"b{i}" for i in range(40))), (3, " ".join(f"a{i}" for i in range(40)))]
    rows = S.located_phrases(S.keyed(frame(docs), S.F.col("doc_id").alias("rank")), 10, 5).collect()
    assert rows and len({r["key"] for r in rows}) == 2
    by = {}
    for r in rows:
        by.setdefault(r["phrase"], set()).add(r["key"])
    assert all(len(k) == 2 for k in by.values())


def test_phrases_of_one_hash_and_other_words(frame):
    """With hashes that take all words of one length for the same, the automata still tell phrases apart."""
    rng = random.Random(12)
    parts = [" ".join(rng.choice(["ab", "cd", "e", "f"]) for _ in range(14)) for _ in range(6)]
    docs = S.keyed(frame([(i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))) for i in range(24)]))
    text = {r["key"]: r["text"].split() for r in docs.collect()}
    for codes in (S.BYTE_CODES, np.full(256, 3, np.uint64)):
        of = {}
        for r in S.located_phrases(docs, 10, 5, codes=codes).collect():     # the runs of a phrase share its five words
            of.setdefault(r["phrase"], []).append({tuple(text[r["key"]][p:p + 5]) for p in range(r["lo"], r["hi"] + 6)})
        assert len(of) > 3 and all(set.intersection(*x) for x in of.values())


def test_very_long_text(frame):
    long = [f"w{i}" for i in range(40_000)]
    docs = [(5, " ".join(long)), (2, " ".join(long[7_000:9_000])), (9, " ".join(["q", *long[100:149], "q"]))]
    by = {r["doc_id"]: r for r in S.substring_dedup(frame(docs)).collect()}
    assert (by[5]["n_removed"], by[2]["n_removed"], by[9]["n_removed"]) == (2_000, 0, 0)
