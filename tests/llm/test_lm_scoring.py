import math
from collections import Counter

import pyarrow.parquet as pq
import pytest

from llm_fixtures import frame  # noqa: F401
from torque.llm import lm_scoring as M
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split()


def brute(docs, good, vocabulary, pairs):
    """Scores; the choice among equal counts is left to the operator, so tests keep everything."""
    words, both = [Counter(), Counter()], [Counter(), Counter()]
    for i, text in docs:
        t = tokens(text)
        for m in (0, 1) if i in good else (0,):
            words[m].update(t)
            both[m].update(zip([None, *t], t, strict=False))
    assert len(words[0]) <= vocabulary and len(both[0]) <= pairs
    context = [Counter(), Counter()]
    for m in (0, 1):
        for (v, _), c in both[m].items():
            context[m][v] += c
    size = len(words[0]) + 1
    out = {}
    for i, text in docs:
        t, loss = tokens(text), [0.0, 0.0]
        for v, w in zip([None, *t], t, strict=False):
            for m in (0, 1):
                p = (words[m][w] + M.ALPHA) / (sum(words[m].values()) + M.ALPHA * size)
                loss[m] -= math.log((both[m][v, w] + M.MU * p) / (context[m][v] + M.MU))
        n = max(1, len(t))
        out[i] = (len(t), loss[1] / n, loss[0] / n, (loss[1] - loss[0]) / n)
    return out


def check(got, want):
    for r in got:
        n, target, background, score = want[r.doc_id]
        assert r.n_tokens == n
        assert (r.target_loss, r.background_loss, r.score) == pytest.approx((target, background, score), abs=1e-9)


def test_whole_tables_match_brute_force(spark):
    docs, labels = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("documents", "labels"))
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    texts = [(d["doc_id"], d["text"]) for d in docs]
    read = [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]
    got = M.lm_scores(*read, vocabulary=1 << 18, pairs=1 << 20).collect()
    assert len(got) == len(docs)
    check(got, brute(texts, good, 1 << 18, 1 << 20))


def test_junk_scores_above_clean_text(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    rows = [r for r in QUERIES["op6_lm_scoring"](spark, "/root/testdata/sf0.01").collect() if r.n_tokens >= 50]
    mean = {q: [r.score for r in rows if labels.get(r.doc_id) == q] for q in (0, 1)}
    assert sum(mean[0]) / len(mean[0]) > sum(mean[1]) / len(mean[1]) + 0.05


def test_edge_cases(frame, spark):
    docs = [(1, None), (2, ""), (3, "a b a b c"), (4, "A B"), (4, "A B"), (None, "a z"), (5, "q " * 40_000)]
    df = frame(docs, ", n int, t int, is_target int")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    got = M.lm_scores(df, labels).collect()
    assert len(got) == len(docs)
    check(got, brute(docs, {3}, 4096, 1 << 19))
    small = M.lm_scores(df, labels, vocabulary=2, pairs=2).collect()
    assert all(math.isfinite(r.score) for r in small)
    assert len(M.lm_scores(df, labels.limit(0)).collect()) == len(docs)
    assert M.lm_scores(spark.createDataFrame([], df.schema), labels).count() == 0


def test_no_word_or_pair_is_left_out(frame, spark):
    """More words than any fixed vocabulary, in several blocks: each keeps its own count."""
    docs = [(i, " ".join(f"w{(i * 131 + k * k) % 9000}" for k in range(300))) for i in range(120)]
    docs += [(200, None), (201, docs[7][1]), (202, "w1 only1 only2"), (202, "w1 only1 only2"), (None, "w1 w2")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(120)], "doc_id bigint, quality int, toxic int")
    want = brute(docs, set(range(0, 120, 3)), 1 << 18, 1 << 20)
    assert len({w for _, t in docs for w in tokens(t)}) > 4096
    for block_bytes in (M.BLOCK_BYTES, 20_000):
        got = M.lm_scores(frame(docs), labels, block_bytes=block_bytes).collect()
        assert len(got) == len(docs)
        check(got, want)


def test_query_matches_brute_force(spark):
    docs, labels = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("documents", "labels"))
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    check(QUERIES["op6_lm_scoring"](spark, SF).collect(),
          brute([(d["doc_id"], d["text"]) for d in docs], good, 1 << 18, 1 << 20))
