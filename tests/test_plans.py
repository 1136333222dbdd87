"""Plan checks: pushdown, no target shuffle for a small batch, no Python in
the hot path."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from torque.catalog import QUERIES as CATALOG
from torque.catalog import WINDOW
from torque.functions.windows import changed_in, changed_in_coalesce
from torque.operators import merge as M


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_event_window_reaches_the_scan(spark):
    p = plan(CATALOG["filter_event_window"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date" in p


def test_change_window_rewrite_is_pushed(spark, tmp_path):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey"), F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate") + F.expr("interval 300 days")).alias("updated_at"))
    o.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        pushed = plan(t.filter(changed_in(WINDOW))).split("PushedFilters")[1].split("ReadSchema")[0]
        opaque = plan(t.filter(changed_in_coalesce(WINDOW))).split("PushedFilters")[1].split("ReadSchema")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Or(" in pushed and "updated_at" in pushed
    assert "created_at" not in opaque   # coalesce() is opaque to the Parquet reader
    assert t.filter(changed_in(WINDOW)).count() == t.filter(changed_in_coalesce(WINDOW)).count() > 0


def test_replace_merge_does_not_shuffle_a_big_target(spark):
    target = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    batch = target.filter(F.col("l_orderkey") < 10)
    p = plan(M.merge(target, batch, ["l_orderkey", "l_linenumber"], check_unique=False))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "Exchange hashpartitioning(l_orderkey" not in p


def test_policy_merge_cuts_target_by_semi_join(spark):
    target = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_totalprice")
    batch = target.filter(F.col("o_orderkey") < 50)
    p = plan(M.merge(target, batch, ["o_orderkey"], {"o_totalprice": M.CUMULATIVE}))
    assert "LeftSemi" in p and "LeftAnti" in p
    assert "FullOuter" not in p


def test_bounded_dimensions_are_broadcast(spark):
    p = plan(CATALOG["etl_car_sales"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 3


@pytest.mark.parametrize("key", sorted(k for k in CATALOG
                                       if not k.startswith(("elt_", "stream_", "parquet_", "etl_run", "snapshot_"))))
def test_no_python_in_registered_plans(spark, key):
    p = plan(CATALOG[key](spark, SF_SMALL))
    assert "EvalPython" not in p and "PythonUDF" not in p and "ExistingRDD" not in p


def test_small_batch_broadcast_is_proven_not_estimated(spark):
    """With size estimates unavailable (auto broadcast off, as for a huge
    target), the bounded count still broadcasts a small batch's keys; over the
    bound the merge falls back to a shuffle join."""
    target = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    batch = target.filter(F.col("l_orderkey") < 10)
    keys = ["l_orderkey", "l_linenumber"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan(M.merge(target, batch, keys, check_unique=False))
        big = plan(M.merge(target, batch, keys, broadcast_key_rows=1, check_unique=False))
        dele = plan(M.delete_by_key(target, batch, keys))
        conflicts = M.strict_conflicts(target, batch, keys)._jdf.queryExecution().executedPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    assert "SortMergeJoin" in big
    assert "BroadcastHashJoin" in dele and "SortMergeJoin" not in dele
    assert "LeftSemi, BuildRight" in conflicts   # the target streams past the broadcast batch keys


def test_semi_dimension_keeps_cars_unshuffled_without_estimates(spark):
    """Brands and types are proven small and broadcast with their change flags,
    so the one pass over ``cars`` needs no shuffle of cars."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        tree = CATALOG["dim_car_detail_semi"](spark, SF_SMALL)._jdf.queryExecution() \
            .executedPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert tree.count("Inner, BuildRight") == 2 and "SortMergeJoin" not in tree


def test_remembered_bound_is_only_reused_when_it_proves_the_answer(spark):
    from torque.operators.broadcast import bounded_broadcast
    df = spark.range(50)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert not hinted(bounded_broadcast(df, 10, remember=True))    # 11 counted: over 10
    assert hinted(bounded_broadcast(df, 100, remember=True))       # must recount: 50 <= 100
    assert not hinted(bounded_broadcast(df, 20, remember=True))    # exact 50 remembered: over 20


def test_a_side_over_the_bound_is_merged_whatever_its_file_takes(spark, tmp_path):
    """300,000 keys compress to a small file; their hashed relation would pass the driver."""
    from torque.operators.broadcast import bounded_broadcast
    spark.range(300_000).write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")
    for kind in ("inner", "left_semi", "left_anti"):
        p = plan(spark.range(10).join(bounded_broadcast(keys), "id", kind)) + plan(keys.join(bounded_broadcast(keys), "id", kind))
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p


def test_fact_sales_broadcasts_cars_and_customers_under_the_bound_only(spark, monkeypatch):
    from torque.fixtures import source
    from torque.operators import star
    src = source(spark, SF_SMALL)
    t = {n: getattr(src, n) for n in src.tables()}
    assert "SortMergeJoin" not in plan(star.fact_sales(t, src.rates_snapshot, None))
    monkeypatch.setattr(star, "MAX_DIMENSION_ROWS", 50)          # fewer than the cars and the customers
    p = plan(star.fact_sales(dict(t, cars=t["cars"].select("*"), customers=t["customers"].select("*")), src.rates_snapshot, None))
    assert p.count("SortMergeJoin") == 2
