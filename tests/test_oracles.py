"""Every registered key against its DuckDB oracle on sf0.001 (the driver runs
the same comparison on sf0.01)."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from torque.catalog import QUERIES
from torque.oracles import SQL

KEYS = sorted(QUERIES)
TABLES = ["nation", "customer", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "quantize"):
        return float(v)
    return v


def _canon(rs):
    return sorted((tuple(_norm(x) for x in r) for r in rs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(SQL) == set(QUERIES) and set(E.queries()) >= set(QUERIES) and set(E.oracle_sql()) >= set(SQL)


def test_entry_runs(spark):
    from torque.schemas import CAR_SALES_DATASET_COLUMNS
    df = E.entry(spark)
    assert df.count() == 131                      # valid 1997 sales at sf0.001
    assert df.columns == CAR_SALES_DATASET_COLUMNS  # the destination table's 12 columns, in order


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rel = duck.sql(SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    oracle = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert _canon(tuple(r) for r in df.collect()) == _canon(oracle)
