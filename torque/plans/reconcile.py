"""Reconcile the two flows' outputs by ``sale_id``.

The ETL and ELT flows disagree by design (window column, left vs inner joins,
floor vs exact conversion, validation, rate date).  The reconciliation lists
every sale in either output with where it appears and the difference of the
converted prices: one full outer join on the sale key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(etl: DataFrame, elt: DataFrame) -> DataFrame:
    a = etl.select("sale_id", F.col("sale_price_normalized").cast("double").alias("etl_normalized"),
                   F.lit(True).alias("__a"))
    b = elt.select("sale_id", F.col("sale_price_normalized").cast("double").alias("elt_normalized"),
                   F.lit(True).alias("__b"))
    j = a.join(b, "sale_id", "full_outer")
    status = (F.when(F.col("__a").isNotNull() & F.col("__b").isNotNull(), "both")
              .when(F.col("__a").isNotNull(), "etl_only").otherwise("elt_only"))
    return j.select("sale_id", status.alias("status"), "etl_normalized", "elt_normalized",
                    (F.col("elt_normalized") - F.col("etl_normalized")).alias("normalized_diff"))
