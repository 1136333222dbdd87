"""Grouping sets against Spark's own; multisets against Counter; a hot group is one row a task."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from torque.operators import grouping as G
from torque.operators import multiset as M


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sales(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([1, 2, None]), rng.choice(["x", None]), rng.choice([None, 1, 5, -2])) for _ in range(400)]
    return spark.createDataFrame(rows, "a string, b int, c string, v bigint").repartition(4)


MEASURES = {"s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "mean": ("avg", "v")}


def plain(df, kind):
    return getattr(df, kind)("a", "b", "c").agg(F.grouping_id().alias("g"), F.sum("v"), F.count("v"), F.min("v"), F.max("v"), F.avg("v"))


@pytest.mark.parametrize("kind", ["cube", "rollup"])
def test_cube_and_rollup(sales, kind):
    assert got(getattr(G, kind)(sales, ["a", "b", "c"], MEASURES)) == got(plain(sales, kind))


def test_named_sets(spark, sales):
    sets = [["a"], ["b", "c"], [], ["a"]]
    sales.createOrReplaceTempView("grouped_sales")
    want = spark.sql("""
        select a, null b, null c, 3 g, sum(v) s from grouped_sales group by a union all
        select a, null, null, 3, sum(v) from grouped_sales group by a union all
        select null, b, c, 4, sum(v) from grouped_sales group by b, c union all
        select null, null, null, 7, sum(v) from grouped_sales""")
    assert got(G.grouping_sets(sales, ["a", "b", "c"], sets, {"s": ("sum", "v")})) == got(want)
    assert got(G.cube(sales.limit(0), ["a"], MEASURES)) == []
    with pytest.raises(ValueError):
        G.grouping_sets(sales, ["a"], [["z"]], MEASURES)


def test_rows_are_aggregated_before_they_are_expanded(sales):
    plan = G.cube(sales, ["a", "b", "c"], MEASURES)._jdf.queryExecution().optimizedPlan().toString()
    top, below = plan.split("Generate", 1)
    assert "Aggregate" in top and "Aggregate" in below


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_multisets(spark):
    rng = random.Random(9)
    kinds = [(1, "x"), (1, None), (None, None), (2, ""), (None, "x")]
    a, b = ([rng.choice(kinds) for _ in range(n)] for n in (150, 100))
    a += [(7, "hot")] * 10_000
    b += [(7, "hot")] * 13
    x, y = (spark.createDataFrame(r, "i int, s string").repartition(3) for r in (a, b))
    m, n = Counter(a), Counter(b)
    assert counted(M.except_all(x, y)) == m - n
    assert counted(M.intersect_all(x, y.select("s", "i"))) == m & n
    assert counted(M.union_max(x, y)) == m | n
    assert counted(M.except_all(x, x)) == Counter() and counted(M.except_all(x.limit(0), y)) == Counter()
    differ = {tuple(r[:2]): (r.side, r.n) for r in M.symmetric_difference(x, y).collect()}
    assert differ == {k: ("left" if m[k] > n[k] else "right", abs(m[k] - n[k])) for k in {*m, *n} if m[k] != n[k]}
    with pytest.raises(ValueError):
        M.except_all(x, y.select("i"))
