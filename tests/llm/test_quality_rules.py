import math
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
import xxhash

from llm_fixtures import frame  # noqa: F401
from torque.llm import quality_rules as Q
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words))


def buckets(text):
    def h(w, seed):
        return xxhash.xxh64_intdigest(w.encode(), seed)

    def bucket(x):
        return (x - (1 << 64) if x >> 63 else x) % Q.BUCKETS

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [bucket(h(w, 42)) for w in words] + [bucket(h(b, h(a, 42))) for a, b in zip(words, words[1:], strict=False)]


def test_query_matches_brute_force(spark):
    docs, labels = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("documents", "labels"))
    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    raw, target = Counter(), Counter()
    for d in docs:
        b = buckets(d["text"])
        raw.update(b)
        if d["doc_id"] in good:
            target.update(b)
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def weight(b):
        return (math.log((target[b] + 1) / (n_target + Q.BUCKETS)) - math.log((raw[b] + 1) / (n_raw + Q.BUCKETS)))

    got = {r["doc_id"]: r for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, b = got[d["doc_id"]], buckets(d["text"])
        want = base(d["text"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        score = sum(map(weight, b)) / len(b) if b else 0.0
        assert r.score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not want[-1] and score >= Q.THRESHOLD)


def test_edge_cases(frame, spark):
    rows = [(1, None), (2, ""), (3, " \n\x0b"), (4, "a b c a b c a b c"), (4, "a b c a b c a b c"), (5, "é|é\né|é\n \n \n"),
            (None, "x " * 60), (6, "q " * 40_000), (7, " ".join(f"w{i}" for i in range(40_000)))]
    df = frame(rows, ", words string, weight double, ngrams int")
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 1), (7, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        out = Q.quality_rules(df, lab).collect()
        assert len(out) == len(rows)
        for r in out:
            text = next(t for i, t in rows if i == r["doc_id"])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text)
    assert all(r.score == 0.0 and r.kept == (not r.base_failed) for r in out)
    assert Q.quality_rules(spark.createDataFrame([], df.schema), labels).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
