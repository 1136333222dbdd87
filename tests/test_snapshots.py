"""Versioned tables: publish is all-or-nothing; empty batches publish nothing."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from torque.operators import merge as M
from torque.sources.snapshots import SnapshotTable, parquet_sink


def test_versions_and_reads(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    assert t.current_version() is None and t.read() is None
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, a double")
    assert t.merge(base, ["k"]) == 0
    assert t.merge(spark.createDataFrame([(2, 5.0), (3, 3.0)], "k bigint, a double"), ["k"],
                   policies={"a": M.CUMULATIVE}) == 1
    assert rows(t.read()) == [(1, 1.0), (2, 7.0), (3, 3.0)]
    assert rows(t.read(0)) == [(1, 1.0), (2, 2.0)]
    assert t.versions() == [0, 1]
    assert t.merge(base.filter("false"), ["k"]) == 1          # empty batch: no new version


def test_failure_before_publish_keeps_old_version(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(1, 1.0)], "k bigint, a double"))
    bad = spark.createDataFrame([(2, 0.0)], "k bigint, a double").select(
        "k", F.assert_true(F.col("a") > 0, "a must be positive").cast("double").alias("a"))
    with pytest.raises(Exception):
        t.write(bad)
    assert t.current_version() == 0
    assert rows(t.read()) == [(1, 1.0)]
    # the retried version rewrites its own data and publishes once
    assert t.write(spark.createDataFrame([(2, 2.0)], "k bigint, a double")) == 1
    with pytest.raises(Exception):
        t.write(spark.createDataFrame([(3, 3.0)], "k bigint, a double"), version=1)
    assert t.current_version() == 1
    assert rows(t.read()) == [(2, 2.0)]                       # the losing writer changed nothing


def test_parquet_sink_name(spark, tmp_path):
    p = parquet_sink(spark.range(3), str(tmp_path), "car_sales_dataset__19970101-19971231")
    assert p.endswith(".parquet") and spark.read.parquet(p).count() == 3


def test_small_batch_rewrites_only_its_buckets(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    t.write(spark.range(1000).selectExpr("id as k", "cast(id as double) as a"))
    assert set(t.manifest(0).values()) == {0} and len(t.manifest(0)) == 8
    t.merge(spark.createDataFrame([(5, -1.0), (5000, 1.0)], "k bigint, a double"))
    m = t.manifest(1)
    assert 1 <= sum(v == 1 for v in m.values()) <= 2          # only the touched buckets
    assert sum(v == 0 for v in m.values()) >= 6               # the rest are shared with v0
    got = {r.k: r.a for r in t.read().collect()}
    assert len(got) == 1001 and got[5] == -1.0 and got[5000] == 1.0
    t.delete(spark.createDataFrame([(5,)], "k bigint"))
    assert t.read().count() == 1000 and t.read(1).count() == 1001


def test_emptied_table_reads_as_empty_with_schema(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    t.write(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, a double"))
    t.delete(spark.createDataFrame([(1,), (2,)], "k bigint"))
    empty = t.read()
    assert empty is not None and empty.count() == 0 and empty.columns == ["k", "a"]
    t.merge(spark.createDataFrame([(3, 3.0)], "k bigint, a double"))
    assert rows(t.read()) == [(3, 3.0)]


def thousand(spark, root, buckets=8):
    t = SnapshotTable(spark, root, ["k"], buckets)
    t.write(spark.range(1000).selectExpr("id as k", "cast(id as int) as a"))
    return t


def test_narrower_key_type_updates_the_right_row(spark, tmp_path):
    t = thousand(spark, str(tmp_path / "t"))
    t.merge(spark.createDataFrame([(5, -1)], "k int, a int"))
    got = {r.k: r.a for r in t.read().collect()}
    assert t.read().count() == 1000 and got == {k: -1 if k == 5 else k for k in range(1000)}
    t.delete(spark.createDataFrame([(5,), (7,)], "k int"))
    assert {r.k for r in t.read().collect()} == set(range(1000)) - {5, 7}


def test_bucket_count_and_key_are_stored(spark, tmp_path):
    root = str(tmp_path / "t")
    thousand(spark, root)
    with pytest.raises(ValueError):
        SnapshotTable(spark, root, ["k"], 4)
    with pytest.raises(ValueError):
        SnapshotTable(spark, root, ["a"])
    again = SnapshotTable(spark, root)
    again.merge(spark.createDataFrame([(5, -1)], "k bigint, a int"), keys=["k"])
    assert (again.keys, again.buckets) == (["k"], 8)
    got = [(r.k, r.a) for r in SnapshotTable(spark, root, ["k"], 8).read().collect()]
    assert sorted(got) == sorted((k, -1 if k == 5 else k) for k in range(1000))


def test_new_column_and_lossy_types(spark, tmp_path):
    t = thousand(spark, str(tmp_path / "t"))
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    t.merge(spark.createDataFrame([(5, -1)], "k bigint, a int"), synced_at=stamp)
    out = t.read()
    assert out.columns == ["k", "a", "synced_at"]
    assert [r.k for r in out.filter("synced_at is not null").collect()] == [5]
    t.merge(spark.createDataFrame([(6, -2), (2000, 1)], "k bigint, a smallint"))
    got = {r.k: (r.a, r.synced_at is not None) for r in t.read().collect()}
    assert len(got) == 1001 and got[5] == (-1, True) and got[6] == (-2, False)
    with pytest.raises(ValueError):
        t.merge(spark.createDataFrame([(5, 1.5)], "k bigint, a double"))
    assert {r.k: r.a for r in t.read().collect()}[5] == -1


def test_a_read_broadcasts_no_manifest(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["k"], 4)
    t.write(spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("a")))
    t.merge(spark.createDataFrame([(5, 2)], "k bigint, a int"))
    p = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in p and t.read().filter("a = 2").count() == 1 and t.read().count() == 100
