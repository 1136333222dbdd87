"""Sketches merged from loads; sessions of a restarted stream equal to the batch query."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from torque.operators import sketches as K
from torque.session import staged
from torque.streaming import sessions as S


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_profile_merges_loads_without_reading_them_again(spark):
    df = spark.range(20_000).select((F.col("id") % 5).alias("load"), F.when(F.col("id") % 3 != 0, F.col("id") % 4_001).alias("k"),
                                    F.when(F.col("id") % 7 != 0, F.col("id") * 1.0).alias("v"))
    stored = staged(K.sketch_rows(df.filter("load < 4"), ["load"], ["k"], ["v"]), "loads")
    more = K.sketch_rows(df.filter("load = 4"), ["load"], ["k"], ["v"])
    both = K.merged(stored.unionByName(more), ["k"], ["v"])
    out = {r.column_name: r for r in K.profile(both, ["k"], ["v"], [0.5]).collect()}
    assert (out["k"].n_rows, out["k"].n_nulls, out["v"].n_nulls) == (20_000, 6_667, 2_858)
    assert (out["v"].min, out["v"].max) == (1.0, 19_998.0)
    exact = df.agg(F.count_distinct("k")).first()[0]
    assert abs(out["k"].distinct_estimate - exact) <= K.DISTINCT_ERROR * exact
    assert abs(out["v"].quantiles[0] / 20_000 - 0.5) <= K.RANK_ERROR
    audit = K.audit(df, K.profile(both, ["k"], ["v"], [0.1, 0.9]), ["k"], ["v"], [0.1, 0.9])
    assert {(r.column_name, r.distinct_holds, r.quantiles_hold) for r in audit.collect()} == {("k", True, None), ("v", None, True)}


def test_audit_sees_estimates_that_are_off(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 1.0).alias("v"))
    wrong = spark.createDataFrame([("k", 1000, 0, 700, None, None, None), ("v", 1000, 0, None, 0.0, 999.0, [600.0])],
                                  "column_name string, n_rows bigint, n_nulls bigint, distinct_estimate bigint, min double, max double, quantiles array<double>")
    audit = {r.column_name: r for r in K.audit(df, wrong, ["k"], ["v"], [0.5]).collect()}
    assert audit["k"].distinct_holds is False and audit["v"].quantiles_hold is False


def brute(events, gap):
    out, by = [], {}
    for i, (u, t) in enumerate(events):
        if t is not None:
            by.setdefault(u, []).append(t)
    for u, times in by.items():
        times.sort()
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if t < last + gap:
                n += 1
            else:
                out.append((u, start, last + gap, n))
                start, n = t, 1
            last = t
        out.append((u, start, last + gap, n))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    t0 = datetime(2024, 3, 1)
    return [(rng.choice([1, 1, 1, 2, 3]), None if i % 41 == 0 else t0 + timedelta(minutes=rng.randint(0, 6000), seconds=i % 60)) for i in range(400)]


def test_batch_sessions(spark, events):
    df = spark.createDataFrame(events, "u int, t timestamp").repartition(4)
    out = S.sessions(df, ["u"], "t", "30 minutes", [F.count("t").alias("n")])
    assert got(out) == brute(events, timedelta(minutes=30))


def test_restarted_stream_equals_the_batch(spark, events, tmp_path):
    df = spark.createDataFrame(events, "u int, t timestamp")
    out = S.sessions_of_landed(spark, df, str(tmp_path), ["u"], "t", "30 minutes", "10 minutes", [F.count("t").alias("n")], parts=3)
    assert got(out) == brute(events, timedelta(minutes=30))
    before = out.count()
    S.run_session_stream(spark, f"{tmp_path}/landing", df.schema, f"{tmp_path}/sessions", f"{tmp_path}/checkpoint", ["u"], "t",
                         "30 minutes", "10 minutes", [F.count("t").alias("n")])
    assert spark.read.parquet(f"{tmp_path}/sessions").filter("u is not null").count() == before     # a restart writes nothing twice


def test_state_expires_and_late_events_are_dropped(spark, tmp_path):
    t0 = datetime(2024, 3, 1)
    args = (["u"], "t", "30 minutes", "10 minutes", [F.count("t").alias("n")])

    def run(rows):
        df = spark.createDataFrame([(u, t0 + timedelta(minutes=m)) for u, m in rows], "u int, t timestamp")
        df.write.mode("append").parquet(f"{tmp_path}/landing")
        S.run_session_stream(spark, f"{tmp_path}/landing", df.schema, f"{tmp_path}/sessions", f"{tmp_path}/checkpoint", *args)

    run([(1, 0), (1, 10), (2, 500)])            # user 1's session has ended
    run([(1, 20), (2, 520)])                    # too late for user 1, in time for user 2
    run([(3, 2000)])
    run([(3, 9000)])
    written = spark.read.parquet(f"{tmp_path}/sessions").filter("u < 3")
    assert sorted((r.u, r.n) for r in written.collect()) == [(1, 2), (2, 2)]
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count()
    assert state <= 1                           # open sessions only


def test_query_on_events_matches_batch(spark):
    from torque.catalog import QUERIES
    from torque.catalog_derived import SESSION_GAP
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    batch = S.sessions(ev, ["user_id"], "ts", SESSION_GAP, [F.count("event_id").alias("n_events")])
    want = sorted((r.user_id, r.session_start, r.n_events) for r in batch.collect())
    out = QUERIES["stream_sessions"](spark, SF_SMALL)
    assert sorted((r.user_id, r.session_start, r.n_events) for r in out.collect()) == want
