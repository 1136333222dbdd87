"""Merge operators against a brute-force Python model on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from torque.operators import merge as M

SCHEMA = "k bigint, a bigint, s string"
POLICY = st.sampled_from([M.REPLACE, M.CUMULATIVE, M.PROGRESS, M.SKIP_IF_NULL])
SPOLICY = st.sampled_from([M.REPLACE, M.PROGRESS, M.SKIP_IF_NULL, M.CONCAT])


def table(max_size):
    row = st.tuples(st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.sampled_from("xyz")))
    return st.dictionaries(st.integers(0, 12), row, max_size=max_size)


def resolve(policy, old, new, update_only=False):
    if policy == M.REPLACE or (policy == M.CONCAT and update_only):
        return new
    if policy == M.CUMULATIVE:
        return None if old is None or new is None else old + new
    if policy == M.PROGRESS:
        return new if old is None else old
    if policy == M.SKIP_IF_NULL:
        return old if new is None else new
    if policy == M.CONCAT:
        if old is None:
            return new
        return old + ", " + new if new is not None else old


def model(target, incoming, pa, ps, update_only=False):
    out = dict(target)
    for k, (a, s) in incoming.items():
        if k in out:
            oa, os_ = out[k]
            out[k] = (resolve(pa, oa, a, update_only), resolve(ps, os_, s, update_only))
        elif not update_only:
            out[k] = (a, s)
    return sorted((k, a, s) for k, (a, s) in out.items())


def df(spark, d):
    return spark.createDataFrame([(k, a, s) for k, (a, s) in d.items()], SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=table(8), incoming=table(6), pa=POLICY, ps=SPOLICY)
def test_merge_matches_model(spark, target, incoming, pa, ps):
    expect = model(target, incoming, pa, ps)
    for strategy in ("split", "outer"):
        got = M.merge(df(spark, target), df(spark, incoming), ["k"], {"a": pa, "s": ps}, strategy=strategy)
        assert sorted(tuple(r) for r in got.collect()) == expect, strategy


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=table(8), incoming=table(6), pa=POLICY, ps=SPOLICY)
def test_update_only_matches_model(spark, target, incoming, pa, ps):
    got = M.update_only(df(spark, target), df(spark, incoming), ["k"], {"a": pa, "s": ps})
    assert sorted(tuple(r) for r in got.collect()) == model(target, incoming, pa, ps, update_only=True)
