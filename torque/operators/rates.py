"""Rate audits: which sales have no rate, the base code, the snapshot time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .broadcast import bounded_broadcast


def missing_rates(sales: DataFrame, rates: DataFrame, code_col: str = "currency_name") -> DataFrame:
    """Currency codes of sales that find no rate, with their sale count
    (the test "no null rate after a left join", as an anti join).  Rates are a
    bounded broadcast; the count is combined map-side per code."""
    r = bounded_broadcast(rates.select(F.col("code").alias("__code")), 100_000)
    return (sales.join(r, sales[code_col] == F.col("__code"), "left_anti")
            .groupBy(code_col).agg(F.count(F.lit(1)).alias("n_sales")))
