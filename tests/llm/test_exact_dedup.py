import hashlib
import random
import string

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from llm_fixtures import frame  # noqa: F401
from torque.llm import exact_dedup as X
from torque.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(docs, pick=max, fold=True):
    """Rows as (doc_id, keep_id, group_size, text_sha256); which of repeated rows stays is checked apart."""
    norm = [(i, (t or "").translate(FOLD) if fold else (t or "")) for i, t in docs]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        out.append((i, pick(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(df, want):
    rows = df.collect()
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == want
    stays = {}
    for r in rows:
        assert not r.kept or r.doc_id == r.keep_id
        stays[r.text_sha256] = stays.get(r.text_sha256, 0) + r.kept
    assert set(stays.values()) <= {1}


CASES = [(1, "Same text"), (2, "same TEXT"), (3, "same text "), (7, "ÉTÉ"), (8, "été"), (9, "ÉtÉ"), (4, None), (5, ""),
         (5, ""), (6, "x" * 300_000), (10, "X" * 300_000), (11, "x" * 299_999 + "y"), (None, "same text"), (None, "lone"),
         (None, None), (None, "two"), (None, "two"), (12, "Same text"), (12, "Same text")]


def test_query_matches_brute_force(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    want = brute(docs)
    assert any(r[2] > 1 for r in want)
    check(QUERIES["op13_exact_dedup"](spark, SF), want)


def test_edges(frame, spark):
    df = frame(CASES, ", row string, hash int, keep_id int, body string")
    check(X.exact_dedup(df), brute(CASES))
    check(X.exact_dedup(df, keep="smallest"), brute(CASES, min))
    check(X.exact_dedup(df, fold=False), brute(CASES, fold=False))
    assert X.exact_dedup(spark.createDataFrame([], df.schema)).collect() == []


def test_collisions_are_told_apart_by_bytes(frame):
    rng = random.Random(1)
    docs = [(rng.randint(0, 400), "".join(rng.choice("aB") for _ in range(rng.randint(0, 4)))) for _ in range(500)]
    weak = lambda c: F.unhex(F.lpad(F.hex(F.length(c)), 4, "0"))
    check(X.exact_dedup(frame(docs + CASES), content_hash=weak), brute(docs + CASES))


def test_drop_copies_keeps_one_whole_row_of_each_group(frame, spark):
    df = frame(CASES, ", row string, first string")
    kept = X.drop_copies(df)
    assert kept.columns == df.columns
    want = sorted({(r[1], r[3]) for r in brute(CASES)}, key=repr)
    assert sorted(((r.doc_id, hashlib.sha256((r.text or "").translate(FOLD).encode()).hexdigest())
                   for r in kept.collect()), key=repr) == want
    assert X.drop_copies(spark.createDataFrame([], df.schema)).collect() == []


def test_text_ids_and_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("b", "T"), ("a", "t"), (None, "t"), ("c", "u")], "doc_id string, text string")
    check(X.exact_dedup(df), brute([("b", "T"), ("a", "t"), (None, "t"), ("c", "u")]))
    plan = X.exact_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hot_text_leaves_each_task_as_one_row(spark):
    df = spark.range(0, 30_000, 1, 6).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'the same passage' else cast(id as string) end as text")
    rows = X.exact_dedup(df)
    assert rows.filter("not kept").count() == 9_999
    assert rows.filter("group_size = 10000").select("keep_id").distinct().collect() == [(29_997,)]
