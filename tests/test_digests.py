"""Digest reconciliation: equal to the full outer join, and equal buckets are never read."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from torque.plans import digests as D
from torque.sources.buckets import layout
from torque.sources.snapshots import SnapshotTable

SCHEMA = "k bigint, a double, b string"


def brute(x, y):
    out = []
    for k in sorted({*x, *y}):
        if x.get(k) != y.get(k):
            kind = "added" if k not in x else "removed" if k not in y else "changed"
            out.append((k, kind, *[v for i in (0, 1) for v in ((x.get(k) or (None, None))[i], (y.get(k) or (None, None))[i])]))
    return sorted(out, key=repr)


def store(spark, root, data, buckets=16):
    t = SnapshotTable(spark, root, ["k"], buckets)
    t.write(spark.createDataFrame([(k, *v) for k, v in data.items()], SCHEMA).repartition(3))
    return t


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    x = {k: (rng.choice([None, 0.0, 1.5, k / 7]), rng.choice([None, "", "é", "z" * 40])) for k in rng.sample(range(10**6), 900)}
    y = dict(x)
    keys = sorted(x)
    y.pop(keys[5])
    y[keys[9]] = (x[keys[9]][0], "other")
    y[-4] = (None, None)
    # The same values in other places: a digest that passes over nulls would not see it.
    x[10**7], y[10**7] = (None, "5"), (5.0, None)
    return x, y


def test_equals_the_full_outer_join(spark, tmp_path, data):
    x, y = data
    a, b = store(spark, f"{tmp_path}/a", x), store(spark, f"{tmp_path}/b", y)
    assert rows(D.reconcile_digest(a, b)) == brute(x, y)
    assert rows(D.reconcile_digest(a, a)) == []
    assert D.reconcile_digest(b, a, ["b"]).columns == ["k", "difference", "b_a", "b_b"]


def test_equal_buckets_are_not_scanned(spark, tmp_path, data):
    x, y = data
    a, b = store(spark, f"{tmp_path}/a", x), store(spark, f"{tmp_path}/b", y)
    want = rows(D.reconcile_digest(a, b))                   # digests are stored now
    one, two = layout(a, 0), layout(b, 0)
    buckets, leaves = D.differing(D.digests(one), D.digests(two))
    assert 0 < len(buckets) <= 4 and leaves.count() <= 5
    for at in (one, two):                                   # unreadable files in all other buckets
        for bucket, attempt in at.attempts.items():
            if bucket not in buckets:
                for f in glob.glob(f"{at.table.root}/data/att={attempt}/__b={bucket}/*.parquet"):
                    with open(f, "wb") as out:
                        out.write(b"no parquet")
    assert rows(D.reconcile_digest(a, b)) == want


def test_digests_of_kept_buckets_are_not_computed_again(spark, tmp_path, data):
    x, _ = data
    a = store(spark, f"{tmp_path}/a", x)
    first = D.digests(layout(a, 0))
    n = SnapshotTable(spark, f"{a.root}/{D.SIDECAR}").read().select("attempt", "bucket").distinct().count()
    k = next(iter(x))
    a.merge(spark.createDataFrame([(k, 99.0, "new")], SCHEMA))
    second = D.digests(layout(a, 1))
    after = SnapshotTable(spark, f"{a.root}/{D.SIDECAR}").read().select("attempt", "bucket").distinct().count()
    assert after == n + 1
    buckets, _ = D.differing(first, second)
    assert len(buckets) == 1
    assert rows(D.reconcile_digest(a, a, version_a=0, version_b=1)) == brute(x, x | {k: (99.0, "new")})


def test_a_hot_value_does_not_skew_the_digests(spark, tmp_path):
    df = spark.range(6000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("a"), F.lit("x").alias("b"))
    a, b = (SnapshotTable(spark, f"{tmp_path}/{n}", ["k"], 4) for n in "ab")
    a.write(df)
    b.write(df.filter("k <> 3000"))
    assert rows(D.reconcile_digest(a, b, ["a"])) == [(3000, "removed", 7.0, None)]
    with pytest.raises(ValueError):
        D.reconcile_digest(a, store(spark, f"{tmp_path}/c", {1: (1.0, "x")}, 8))
