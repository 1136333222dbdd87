import random

import pyarrow.parquet as pq
import xxhash

from llm_fixtures import frame  # noqa: F401
from torque.llm import simhash
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(rows, k=4, radius=4):
    fps = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        grams = [b" ".join(words[j:j + k]) for j in range(max(1, len(words) - k + 1))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    comp = {i: i for i in fps}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(fps)
    for x in ids:
        for y in ids:
            if y > x and (fps[x] ^ fps[y]).bit_count() <= radius:
                a, b = sorted((root(x), root(y)))
                comp[b] = a
    return {i: (f"{fps[i]:016x}", root(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_query_matches_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet")
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    assert got(QUERIES["op1_simhash_near_dedup"](spark, SF)) == brute(rows)


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in list(fps[:100]):
        for b in rng.sample(range(64), rng.randint(1, 9)):
            f ^= 1 << b
            fps.append(f)                       # chains: each a bit further
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    comp = {f: f for f in signed}
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 4:
                x, y = comp[signed[i]], comp[signed[j]]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    for tile_rows in (1 << 16, 5):              # whole and split tiles
        df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
        links = simhash.fingerprint_links(df, tile_rows=tile_rows)
        roots = {r["node"]: r["root"] for r in simhash.star_components(links).collect()}
        assert {f: roots.get(f, f) for f in signed} == {f: min(k for k in comp if comp[k] == comp[f]) for f in signed}


def test_edge_cases(frame, spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b c d e f"), (6, "a b c d e f"),
            (7, long), (8, long + " end"), (None, "x y"), (9, "É one"), (10, "é one")]
    df = frame(rows, ", fp int, root string")
    result = simhash.components(df).collect()
    assert len(result) == len(rows)
    by = {r["doc_id"]: r for r in result}
    assert by[1]["fingerprint"] == "0" * 16 and by[3]["component_id"] == 1
    assert by[4]["component_id"] == by[5]["component_id"] == 4 and by[8]["component_id"] == 7
    assert by[9]["component_id"] != by[10]["component_id"]        # only A-Z is lower-cased
    assert by[None]["component_id"] is None
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 6, 6, 7, 9, 10]
    empty = spark.createDataFrame([], df.schema)
    assert simhash.components(empty).count() == 0 and simhash.keep_one(empty).count() == 0
