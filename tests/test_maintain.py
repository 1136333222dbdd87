"""Upkeep of the fact and the car dimension: equal to a full recomputation after every
change of any side, and only buckets of reached keys are rewritten."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from torque import schemas
from torque.fixtures import RATE_BASE_CODE, RATE_UNIX_TIME, RATES, source
from torque.operators.star import dim_car_detail, fact_sales
from torque.plans import maintain as U
from torque.plans.elt import table
from torque.sources.buckets import layout
from torque.sources.rates import RatesSnapshot, rates_from_mapping
from torque.sources.snapshots import SnapshotTable

SIDES = ["brands", "types", "currencies", "cities", "cars", "customers", "car_sales", "currency_rates"]


@pytest.fixture(scope="module")
def dest(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("upkeep"))
    src = source(spark, SF_SMALL)
    rows_of = {n: getattr(src, n) for n in SIDES[:-1]} | {"currency_rates": src.rates}
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda n: table(spark, root, n, 4).merge(rows_of[n]), rows_of))
    U.maintain(spark, root, RATE_BASE_CODE, buckets=4)
    return root


def current(spark, root):
    return {n: SnapshotTable(spark, f"{root}/{n}").read() for n in SIDES}


def views(spark, root):
    return [SnapshotTable(spark, f"{root}/{v.name}").read() for v in (U.FACT, U.DIMENSION)]


def check(spark, root):
    t = current(spark, root)
    rates = RatesSnapshot(t["currency_rates"], RATE_BASE_CODE, n_codes=t["currency_rates"].count())
    for got, want in zip(views(spark, root), (fact_sales(t, rates, None), dim_car_detail(t, None)), strict=True):
        assert rows(got.select(*want.columns)) == rows(want)


def moved(spark, root, name, before):
    t = SnapshotTable(spark, f"{root}/{name}")
    return layout(t, t.current_version()).moved(layout(t, before))


def test_first_computation_and_no_change(spark, dest):
    check(spark, dest)
    versions = U.maintain(spark, dest, RATE_BASE_CODE)
    assert versions == U.maintain(spark, dest, RATE_BASE_CODE)
    assert views(spark, dest)[0].columns == schemas.CAR_SALES_DATASET_COLUMNS


def test_one_changed_car_touches_its_buckets_only(spark, dest):
    cars, fact = SnapshotTable(spark, f"{dest}/cars"), SnapshotTable(spark, f"{dest}/{U.FACT.name}")
    some = fact.read().groupBy("car_id").count().orderBy("count", "car_id").first()["car_id"]
    before, at = fact.current_version(), cars.current_version()
    # A row that is written again as it was is no change.
    again = cars.read().filter(F.col("id").isin(some, some + 1))
    cars.merge(again.withColumn("name", F.when(F.col("id") == some, "renamed").otherwise(F.col("name"))))
    assert rows(U.changed_keys(cars, at, cars.current_version())) == [(some,)]
    U.maintain(spark, dest, RATE_BASE_CODE)
    check(spark, dest)
    assert fact.read().filter("car_name = 'renamed'").count() > 0
    assert 0 < len(moved(spark, dest, U.FACT.name, before)) < 4


def test_every_side_changes_and_rows_go(spark, dest):
    t = current(spark, dest)
    table(spark, dest, "brands", 4).merge(t["brands"].filter("id % 4 = 1").withColumn("name", F.lit("B")))
    table(spark, dest, "brands", 4).delete(t["brands"].filter("id = 6").select("id"))
    table(spark, dest, "types", 4).merge(t["types"].filter("id = 2").withColumn("name", F.lit("T")))
    table(spark, dest, "cities", 4).delete(t["cities"].filter("id = 3").select("id"))
    table(spark, dest, "customers", 4).merge(t["customers"].filter("id % 9 = 2").withColumn("address_city_id", F.lit(3).cast("bigint")))
    table(spark, dest, "car_sales", 4).merge(t["car_sales"].filter("id % 8 = 5").withColumn("car_id", F.col("car_id") + 1))
    table(spark, dest, "car_sales", 4).delete(t["car_sales"].filter("id % 50 = 7").select("id"))
    table(spark, dest, "currencies", 4).merge(t["currencies"].filter("id = 6").withColumn("name", F.lit("BMD")))
    table(spark, dest, "currency_rates", 4).merge(rates_from_mapping(spark, RATE_BASE_CODE, RATE_UNIX_TIME, RATES | {"JPY": 2.0}).table)
    U.maintain(spark, dest, RATE_BASE_CODE)
    check(spark, dest)


def test_a_changed_base_rate_reaches_every_sale(spark, dest):
    rates = rates_from_mapping(spark, RATE_BASE_CODE, RATE_UNIX_TIME, {RATE_BASE_CODE: 2.0}).table
    table(spark, dest, "currency_rates", 4).merge(rates)
    U.maintain(spark, dest, RATE_BASE_CODE)
    assert views(spark, dest)[0].count() == 0          # the base currency's rate is not 1: no price can be stated
    table(spark, dest, "currency_rates", 4).merge(source(spark, SF_SMALL).rates)
    U.maintain(spark, dest, RATE_BASE_CODE)
    check(spark, dest)
    assert views(spark, dest)[0].count() > 0


def test_a_hot_key_streams_past_its_side(spark, dest):
    """The reached sales are found by look-ups of small key sets: the stored sales are not shuffled."""
    t = current(spark, dest)
    plans = []
    staged = U.staged

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name)

    U.staged = seen
    try:
        keys = U.reached(U.FACT, t, {"brands": t["brands"].filter("id = 3").select("id"), "cities": t["cities"].filter("id = 1").select("id")})
    finally:
        U.staged = staged
    assert keys.count() > 0
    plan = dict(plans)["reached-car_sales"]
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert "hashpartitioning(car_id" not in plan and "hashpartitioning(customer_id" not in plan
