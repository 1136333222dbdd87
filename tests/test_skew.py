"""A key holding a third of the rows: results stay whole and the hot
partition is split (AQE skew join) or pre-aggregated (map-side combine)."""

from pyspark.sql import functions as F

from torque.functions.windows import year_window
from torque.operators import merge as M
from torque.operators import star

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _sales(spark, n=30000):
    ids = spark.range(n)
    car = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997 + 1000)   # car 7: a third
    return ids.select(
        F.col("id").alias("id"), car.cast("bigint").alias("car_id"), (F.col("id") % 50).alias("customer_id"),
        (F.col("id") % 100 + 1).cast("double").alias("price"), (F.col("id") % 2 + 1).alias("currency_id"),
        F.lit("1997-06-01").cast("timestamp_ntz").alias("transaction_date"))


def test_hot_car_is_split_and_the_result_is_whole(spark):
    sales = _sales(spark)
    cars = spark.range(1, 3000).select(F.col("id"), F.concat(F.lit("car"), F.col("id")).alias("name"),
                                       (F.col("id") % 5 + 1).alias("brand_id"))
    brands = spark.range(1, 6).select("id", F.concat(F.lit("b"), F.col("id")).alias("name"))
    currencies = spark.createDataFrame([(1, "USD"), (2, "EUR")], "id bigint, name string")
    t = {"car_sales": sales, "cars": cars, "brands": brands, "currencies": currencies}
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        wide = star.sales_wide(t, year_window(1997))
        n = wide.count()
        hot = wide.filter("car_id = 7").count()
        wide.collect()   # runs the DataFrame's own execution, finalising its adaptive plan
        final = wide._jdf.queryExecution().executedPlan().treeString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == 30000 and hot == 10000
    assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final
    assert "NestedLoop" not in final


def test_hot_key_dedupe_is_combined_map_side(spark):
    rows = spark.range(60000).select((F.col("id") % 3 != 0).cast("int").alias("k"), F.col("id").alias("v"))
    out = M.dedupe_last(rows.repartition(8), ["k"], ["v"])
    assert {r.k: r.v for r in out.collect()} == {0: 59997, 1: 59999}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(k")  # partial below the shuffle
