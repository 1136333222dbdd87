"""Grouping sets, cube and rollup over decomposable measures.

Spark expands every row once for each grouping set before it aggregates.  Here rows
are first aggregated to the finest grain (combined map-side: a hot group is one row
a task), and only those rows are expanded.  Sums, counts, least and greatest values of
groups are those of their parts, and an average is a sum by a count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: measure -> (aggregate of rows, aggregate of partial results)
MEASURES = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
GROUPING_ID = "grouping_id"


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(s) for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def grouping_sets(df: DataFrame, dims: Sequence[str], sets: Sequence[Sequence[str]],
                  measures: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    """(dims, grouping_id, measures): one row for each group of each set.

    ``measures`` maps a column to (``sum``, ``count``, ``min``, ``max`` or ``avg``, column).
    ``grouping_id`` has a bit for each dimension (the first is the highest), 1 where it is
    rolled up, which tells a rolled-up dimension from a null value.  An empty table gives
    no row, the grand total included.  Empty sets of columns are the grand total.
    """
    dims = list(dims)
    if unknown := {d for s in sets for d in s} - set(dims):
        raise ValueError(f"grouping sets name no dimension: {sorted(unknown)}")
    parts: dict[str, tuple[str, str | Column]] = {}
    for name, (fn, c) in measures.items():
        if fn == "avg":
            parts |= {f"__sum_{name}": ("sum", c), f"__n_{name}": ("count", c)}
        else:
            parts[name] = (fn, c)
    grain = df.groupBy(*dims).agg(*[MEASURES[fn][0](c).alias(n) for n, (fn, c) in parts.items()])
    ids = [sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s) for s in sets]
    # A repeated set gives its rows again, as in SQL.
    expanded = grain.withColumn("__set", F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.lit(g).cast("bigint").alias("id"))
                                                             for i, g in enumerate(ids)])))
    bit = {d: F.col("__set.id").bitwiseAND(F.lit(1 << (len(dims) - 1 - i))) == 0 for i, d in enumerate(dims)}
    expanded = expanded.select(*[F.when(bit[d], F.col(d)).alias(d) for d in dims], F.col("__set.id").alias(GROUPING_ID),
                               F.col("__set.at").alias("__at"), *parts)
    out = expanded.groupBy(*dims, GROUPING_ID, "__at").agg(*[MEASURES[fn][1](n).alias(n) for n, (fn, _) in parts.items()])
    values = [(F.try_divide(F.col(f"__sum_{n}").cast("double"), F.col(f"__n_{n}")) if fn == "avg" else F.col(n)).alias(n)
              for n, (fn, _) in measures.items()]
    return out.select(*dims, GROUPING_ID, *values)


def cube(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    return grouping_sets(df, dims, cube_sets(dims), measures)


def rollup(df: DataFrame, dims: Sequence[str], measures: Mapping[str, tuple[str, str | Column]]) -> DataFrame:
    return grouping_sets(df, dims, rollup_sets(dims), measures)
