import hashlib
import random
import re

import pyarrow.parquet as pq

from llm_fixtures import frame  # noqa: F401
from torque.llm import decontamination as D
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        if name is not None and w:
            for i in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[i:i + 10]), set()).add(str(name))
    lengths = {len(k) for k in windows}
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                names = windows.get(tuple(w[s:s + n]))
                if names:
                    found |= names
                    hit.update(range(s, s + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs, items = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("documents", "benchmark"))
    want = brute([(d["doc_id"], d["text"]) for d in docs], [(b["item_id"], b["text"]) for b in items])
    assert got(QUERIES["op4_benchmark_decontamination"](spark, SF)) == want
    assert any(r[-1] for r in want)


def test_random_texts_and_several_passes(frame, spark):
    rng = random.Random(3)

    def some(n):
        return " ".join(rng.choice("abcd") + rng.choice("  .,") for _ in range(n))

    items = [(k, some(rng.choice([1, 3, 7, 9, 10, 11, 30]))) for k in range(40)] + [(None, "a b"), (50, None), (51, "..")]
    items += [(52, items[3][1]), (3, "d c b a d c b a d c")]
    docs = [(i, some(rng.randint(0, 60))) for i in range(120)] + [(200, items[6][1] * 2), (201, None), (202, ""), (203, "!")]
    docs += [(200, items[6][1] * 2), (None, items[7][1]), (204, some(20_000))]
    df = frame(docs, ", key string, runs int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert got(D.contamination(df, bench)) == want
    assert got(D.contamination(df, bench, pass_bytes=200)) == want
    assert got(D.contamination(spark.createDataFrame([], df.schema), bench)) == []
    assert got(D.contamination(df, bench.limit(0))) == brute(docs, [])
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == sorted(r[0] for r in want if r[0] and not r[-1])
