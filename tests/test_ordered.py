"""As-of join, running windows and top-k against brute force, with a key that holds a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from torque.operators import ordered as O

T0 = datetime(2024, 1, 1)


def at(n):
    return None if n is None else T0 + timedelta(hours=n)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=["parted", "coalesced"])
def parted(request, spark):
    """With and without many range partitions: a hot key lies in many, or in one."""
    if request.param == "parted":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def some(seed, n):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 5 + ["a", "b", "c", None])
    left = [(i, key(), rng.choice([None] + list(range(60)))) for i in range(n)]
    right = [(key(), rng.choice([None] + list(range(0, 60, 3))), rng.choice([None, 1, 2, 3]), i % 4) for i in range(n // 3)]
    return left, right


def brute_asof(left, right, exact, tolerance):
    out = []
    for i, k, t in left:
        best = None
        for rk, rt, v, w in right:
            if None in (k, t, rt) or rk != k or rt > t or (rt == t and not exact):
                continue
            c = (rt, (v is not None, v or 0), w, v)
            best = c if best is None or c[:3] > best[:3] else best
        if best is not None and tolerance is not None and best[0] < t - tolerance:
            best = None
        out.append((i, k, at(t), *((best[3], best[2]) if best else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("exact, tolerance", [(True, None), (False, None), (True, 2)])
def test_asof_join(spark, parted, exact, tolerance):
    left, right = some(3, 240)
    a = spark.createDataFrame([(i, k, at(t)) for i, k, t in left], "id bigint, k string, t timestamp_ntz").repartition(3)
    b = spark.createDataFrame([(k, at(t), v, w) for k, t, v, w in right], "k string, t timestamp_ntz, v int, w int").repartition(2)
    limit = None if tolerance is None else F.expr(f"interval {tolerance} hours")
    out = O.asof_join(a, b, ["k"], "t", "t", ["v", "w"], limit, exact)
    assert got(out) == brute_asof(left, right, exact, tolerance)


def test_asof_join_of_empty_sides_and_repeated_rows(spark):
    a = spark.createDataFrame([(1, "k", at(5)), (1, "k", at(5)), (2, None, at(5))], "id bigint, k string, t timestamp_ntz")
    b = spark.createDataFrame([("k", at(5), 7)], "k string, t timestamp_ntz, v int")
    assert got(O.asof_join(a, b, ["k"], "t", "t", ["v"])) == got(a.withColumn("v", F.when(F.col("k") == "k", 7)))
    assert got(O.asof_join(a, b.limit(0), ["k"], "t", "t", ["v"])) == got(a.withColumn("v", F.lit(None).cast("int")))
    assert got(O.asof_join(a.limit(0), b, ["k"], "t", "t", ["v"])) == []


def test_running(spark, parted):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 4 + ["a", None]), rng.randint(0, 40), i, rng.choice([None, -3, 0, 2, 9])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, id int, v bigint").repartition(4)
    out = O.running(df, ["k"], ["t", "id"], {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")})
    want = []
    for k, t, i, v in rows:
        seen = [x for kk, tt, ii, x in rows if kk == k and (tt, ii) <= (t, i) and x is not None]
        want.append((k, t, i, v, sum(seen) if seen else None, len(seen), min(seen, default=None), max(seen, default=None)))
    assert got(out) == sorted(want, key=repr)


def test_hot_key_lies_in_many_blocks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                        F.lit(1).alias("t"), F.lit(1).cast("bigint").alias("v"))
        blocks = O.ordered_blocks(df, ["k"], ["t"])
        sizes = blocks.filter("k = 'hot'").groupBy(O.BLOCK).count().collect()
        assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 9_000       # equal rows are parted too
        assert O.running(df, ["k"], ["t"], {"n": ("count", "v")}).filter("k = 'hot'").agg(F.max("n"), F.count_distinct("n")).first() == (10_000, 10_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_k_keeps_bounded_buffers_in_every_task(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, 1, 2, 2, 3]), i % 50) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(4)
    out = O.top_k(df, ["k"], [F.col("v").desc_nulls_last()], 3)
    want = []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is None, -(r[1] or 0), r[1] or 0, r[2]))
        want += [(*r, n) for n, r in enumerate(mine[:3], 1)]
    assert got(out) == sorted(want, key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
