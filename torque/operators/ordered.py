"""Operators over ordered rows of a key that may hold a third of the table.

A window partitioned by the key would sort such a key in one task.  Here rows are
written in range partitions of (key, order): a hot key lies in many of them, one
after another.  Each block (a key's rows in one partition) is computed by itself,
blocks are summarised to one row each, and what a block takes over from those
before it is carried in by a join on (partition, key).

* :func:`asof_join`: the last row of another table at or before a time;
* :func:`running`: running sums, counts, least and greatest values;
* :func:`top_k`: the first rows of each key, from bounded partial buffers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .broadcast import bounded_broadcast

BLOCK = "__block"
_TIE = "__tie"


def ordered_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df``, written in range partitions of (keys, order), with its partition number.
    Rows that are equal in all of these can be parted too: a row number of no meaning
    is the last sort column."""
    by = [*keys, *order, _TIE]
    return staged(df.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(*by)
                  .withColumn(BLOCK, F.spark_partition_id()), "blocks")


def _inside(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(BLOCK, *keys).orderBy(*order, _TIE).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _blocks_before(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def _no_null(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).isNotNull()
    return cond


def _carried(blocks: DataFrame, summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``blocks`` with what each takes over (``summaries``: a row a block that takes over
    anything, at most one for each border between range partitions and key)."""
    return blocks.join(bounded_broadcast(staged(summaries, "carried")), [BLOCK, *keys], "left")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              take: Sequence[str], tolerance: Column | None = None, exact: bool = True) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` of the same keys whose
    time is at or before its own (``exact=False``: before it).

    One row for each row of ``left``; without a match, or with one further back than
    ``tolerance`` (an interval), the taken columns are null.  Null keys or times match
    nothing.  Of rows of ``right`` with equal keys and time, the one with the greatest taken
    values counts, compared in the order of ``take``.
    """
    keys, values = list(keys), F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(take)])
    known = right.filter(_no_null([*keys, right_time]))
    known = known.groupBy(*keys, F.col(right_time).alias("__t")).agg(F.max(values).alias("__v"))
    whole = _no_null([*keys, left_time])
    l_rows = left.filter(whole).select(*keys, F.col(left_time).alias("__t"), F.lit(1 if exact else 0).alias("__side"),
                                       F.struct(*left.columns).alias("__l"))
    found = F.struct("__t", "__v")
    r_rows = known.select(*keys, "__t", F.lit(0 if exact else 1).alias("__side"), found.alias("__r"))
    both = ordered_blocks(l_rows.unionByName(r_rows, allowMissingColumns=True), keys, ["__t", "__side"])
    inside = F.last("__r", ignorenulls=True).over(_inside(keys, ["__t", "__side"]))
    last = both.groupBy(BLOCK, *keys).agg(F.max_by("__r", "__r.__t").alias("__r"))
    carry = last.withColumn("__before", F.last("__r", ignorenulls=True).over(_blocks_before(keys)))
    carry = carry.filter("__before is not null").select(BLOCK, *keys, "__before")
    match = F.coalesce(F.col("__inside"), F.col("__before"))
    if tolerance is not None:
        match = F.when(match["__t"] >= F.col("__t") - tolerance, match)
    rows = _carried(both.withColumn("__inside", inside).filter("__l is not null"), carry, keys).withColumn("__m", match)
    taken = {c: F.col(f"__m.__v.v{i}") for i, c in enumerate(take)}
    out = rows.select(*[F.col(f"__l.{c}").alias(c) for c in left.columns], *[v.alias(c) for c, v in taken.items()])
    none = left.filter(~whole).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take])
    return out.unionByName(none)


_AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with running aggregates of each key in ``order`` (a total order of its rows),
    the row itself included: ``values`` maps a new column to (``sum``, ``count``, ``min`` or
    ``max``, column).  As in SQL, nulls are passed over and a null key is a key."""
    keys, order = list(keys), list(order)
    blocks = ordered_blocks(df, keys, order)
    exprs = {out: _AGGREGATES[fn](F.col(c)) for out, (fn, c) in values.items()}
    totals = blocks.groupBy(BLOCK, *keys).agg(*[e.alias(f"__t_{out}") for out, e in exprs.items()])
    carry = totals.withColumn("__first", F.row_number().over(Window.partitionBy(*keys).orderBy(BLOCK)) == 1)
    for out, (fn, _) in values.items():
        again = F.sum if fn in ("sum", "count") else _AGGREGATES[fn]
        carry = carry.withColumn(f"__c_{out}", again(f"__t_{out}").over(_blocks_before(keys)))
    # At most one row for each border between range partitions.
    carry = bounded_broadcast(staged(carry.filter("not __first").select(
        F.col(BLOCK).alias("__b"), *[F.col(k).alias(f"__k_{k}") for k in keys], *[f"__c_{o}" for o in values]), "carried"))
    out = blocks
    for name, e in exprs.items():
        out = out.withColumn(f"__i_{name}", e.over(_inside(keys, order)))
    on = F.col(BLOCK) == F.col("__b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    out = out.join(carry, on, "left")

    def both(name: str, fn: str) -> Column:
        here, there = F.col(f"__i_{name}"), F.col(f"__c_{name}")
        if fn == "count":
            return here + F.coalesce(there, F.lit(0))
        if fn == "sum":
            return F.coalesce(here + there, here, there)
        return (F.least if fn == "min" else F.greatest)(here, there)

    return out.select(*df.columns, *[both(n, fn).alias(n) for n, (fn, _) in values.items()])


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key in ``order`` with their ``rank`` from 1.

    Ties beyond ``order`` are broken by the row's own columns, so the result is the same
    however the rows are dealt.  Spark keeps ``k`` rows of a key in every task before
    the shuffle (WindowGroupLimit, for ``k`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``), so a hot key is ``k`` rows a task.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn(rank, number).filter(F.col(rank) <= k)
