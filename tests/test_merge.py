"""Keyed merge semantics on literal rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from torque.operators import merge as M

SCHEMA = "k bigint, a double, s string"


def _t(spark):
    return spark.createDataFrame([(1, 1.0, "x"), (2, None, None), (3, 3.0, "z"), (4, 4.0, "w")], SCHEMA)


def _s(spark):
    return spark.createDataFrame([(1, 10.0, "X"), (2, 20.0, "Y"), (3, None, None), (5, 50.0, "V")], SCHEMA)


@pytest.mark.parametrize("strategy", ["split", "outer"])
@pytest.mark.parametrize("policy,expect", [
    (M.REPLACE, {1: (10.0, "X"), 2: (20.0, "Y"), 3: (None, None), 4: (4.0, "w"), 5: (50.0, "V")}),
    (M.CUMULATIVE, {1: (11.0, None), 2: (None, None), 3: (None, None), 4: (4.0, "w"), 5: (50.0, "V")}),
    (M.PROGRESS, {1: (1.0, "x"), 2: (20.0, "Y"), 3: (3.0, "z"), 4: (4.0, "w"), 5: (50.0, "V")}),
    (M.SKIP_IF_NULL, {1: (10.0, "X"), 2: (20.0, "Y"), 3: (3.0, "z"), 4: (4.0, "w"), 5: (50.0, "V")}),
])
def test_policies_with_nulls_on_both_sides(spark, policy, expect, strategy):
    pol = {"a": policy} if policy == M.CUMULATIVE else {"a": policy, "s": policy}
    if policy == M.CUMULATIVE:
        pol["s"] = M.CONCAT
        expect = {**expect, 1: (11.0, "x, X"), 2: (None, "Y"), 3: (None, "z")}
    out = {r.k: (r.a, r.s) for r in M.merge(_t(spark), _s(spark), ["k"], pol, strategy=strategy).collect()}
    assert out == expect


def test_concat_rules(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, None)], "k bigint, s string")
    s = spark.createDataFrame([(1, "b"), (2, "b"), (3, None), (4, None)], "k bigint, s string")
    out = {r.k: r.s for r in M.merge(t, s, ["k"], {"s": M.CONCAT}).collect()}
    assert out == {1: "a, b", 2: "b", 3: "c", 4: None}


@pytest.mark.parametrize("policy,idempotent", [
    (M.REPLACE, True), (M.PROGRESS, True), (M.SKIP_IF_NULL, True), (M.CUMULATIVE, False)])
def test_idempotence(spark, policy, idempotent):
    once = M.merge(_t(spark), _s(spark), ["k"], {"a": policy})
    twice = M.merge(once, _s(spark), ["k"], {"a": policy})
    assert (rows(once) == rows(twice)) is idempotent


def test_only_supplied_columns_change_and_synced_at(spark):
    s = spark.createDataFrame([(1, 9.0), (6, 6.0)], "k bigint, a double")
    out = {r.k: r for r in M.merge(_t(spark), s, ["k"], synced_at=F.lit("2026-01-01 00:00:00")).collect()}
    assert (out[1].a, out[1].s) == (9.0, "x")          # s kept
    assert (out[6].a, out[6].s) == (6.0, None)         # new row: missing column null
    assert out[1].synced_at is not None and out[4].synced_at is None


def test_keyless_merge_appends(spark):
    assert M.merge(_t(spark), _s(spark), []).count() == 8


def test_null_key_parts_always_insert(spark):
    t = spark.createDataFrame([(None, 1.0, "t")], SCHEMA)
    s = spark.createDataFrame([(None, 2.0, "s")], SCHEMA)
    assert M.merge(t, s, ["k"]).count() == 2
    assert M.delete_by_key(t, s, ["k"]).count() == 1   # a null key matches nothing


def test_initial_load_creates_table(spark):
    assert rows(M.merge(None, _s(spark), ["k"])) == rows(_s(spark))


def test_dedupe_last_write_with_hot_key(spark):
    hot = spark.range(0, 30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    out = {r.k: r.v for r in M.dedupe_last(hot, ["k"], ["v"]).collect()}
    assert out == {0: 29999, 1: 29997}
    plan = M.dedupe_last(hot, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan   # combined map-side before the shuffle


def test_update_only_never_inserts(spark):
    s = spark.createDataFrame([(1, 10.0, "X"), (9, 90.0, "N")], SCHEMA)
    out = M.update_only(_t(spark), s, ["k"], {"a": M.CUMULATIVE, "s": M.CONCAT})
    got = {r.k: (r.a, r.s) for r in out.collect()}
    assert got == {1: (11.0, "X"), 2: (None, None), 3: (3.0, "z"), 4: (4.0, "w")}
    with pytest.raises(ValueError):
        M.update_only(_t(spark), s, [])


def test_strict_append(spark):
    with pytest.raises(ValueError):
        M.append_strict(_t(spark), _s(spark), ["k"])
    fresh = spark.createDataFrame([(7, 7.0, "n")], SCHEMA)
    assert M.append_strict(_t(spark), fresh, ["k"]).count() == 5
    rep = spark.createDataFrame([(7, 7.0, "n"), (7, 8.0, "m")], SCHEMA)
    assert [r.reason for r in M.strict_conflicts(_t(spark), rep, ["k"]).collect()] == ["repeated"]


def test_delete_cascade(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id bigint")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id bigint, pid bigint")
    p, c = M.delete_cascade(parents, children, spark.createDataFrame([(1,), (3,)], "id bigint"), "id", "pid")
    assert [r.id for r in p.collect()] == [2]
    assert sorted(r.id for r in c.collect()) == [11, 12]


def test_empty_load_is_noop(spark):
    empty = _s(spark).filter("false")
    assert M.load_table(_t(spark), empty, ["k"]) is not None
    assert rows(M.load_table(_t(spark), empty, ["k"])) == rows(_t(spark))
