"""Multiset difference, intersection and union by signed counts.

Rows of both sides are counted with signs in one aggregation (combined map-side: a row
that a third of a table holds is one row a task), and each distinct row is given
back by its multiplicity.  Nulls are equal to nulls, as in SQL's set operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of a row that one generated array holds; more are generated in steps.
STEP = 4096


def _counted(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row with its number in a and in b (columns by name)."""
    if set(a.columns) != set(b.columns):
        raise ValueError("both sides must have the same columns")
    rows = a.withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0)).unionByName(
        b.withColumn("__a", F.lit(0)).withColumn("__b", F.lit(1)))
    return rows.groupBy(*a.columns).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))


def _repeated(counted: DataFrame, n: Column, columns: list[str]) -> DataFrame:
    """Each row ``n`` times.  Copies are made in two steps, so no array is longer than ``STEP``
    for up to STEP * STEP copies, and the steps of a hot row can be dealt to several tasks."""
    rows = counted.withColumn("__n", n.cast("bigint")).filter("__n > 0")
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("__n") - 1) / STEP))
    rows = rows.withColumn("__step", F.explode(steps))
    here = F.least(F.lit(STEP).cast("bigint"), F.col("__n") - F.col("__step") * STEP)
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), here))).select(*columns)


def except_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of ``a`` without those of ``b``, each as often as it stands more in ``a``."""
    return _repeated(_counted(a, b), F.col("__a") - F.col("__b"), a.columns)


def intersect_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows in both, each as often as it stands in the side that has it less often."""
    return _repeated(_counted(a, b), F.least("__a", "__b"), a.columns)


def union_max(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows in either, each as often as it stands in the side that has it more often."""
    return _repeated(_counted(a, b), F.greatest("__a", "__b"), a.columns)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(columns, side, n): each distinct row that the sides hold in different number."""
    return (_counted(a, b).filter("__a <> __b")
            .select(*a.columns, F.when(F.col("__a") > F.col("__b"), "left").otherwise("right").alias("side"),
                    F.abs(F.col("__a") - F.col("__b")).alias("n")))
