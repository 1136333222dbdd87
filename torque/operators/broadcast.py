"""Broadcast behind a proven size bound.

Spark broadcasts a join side when its *estimated* size is under
``spark.sql.autoBroadcastJoinThreshold``; for a filtered scan the estimate is
the whole table, so a handful of changed keys out of a huge table is never
broadcast and the big side gets shuffled.  ``bounded_broadcast`` proves the
bound instead: it counts the rows (each partition stops at ``max_rows + 1``) and
their bytes in one pass, and hints the broadcast only if both are at or under
their bounds.  Above them it hints a merge join: the estimate of a stored table is
the size of its compressed files, so the planner would still broadcast a side whose
rows take the driver ten times that.  The pass runs the side's plan once; of a
written table it reads only columns of varying width.
"""

from __future__ import annotations

import threading
import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest key set we broadcast (rows).  A load broadcasts some tens of them, and all
# pass the driver: one key column of this many rows is a hashed relation of 8 MB.
MAX_BROADCAST_KEY_ROWS = 100_000
MAX_BROADCAST_BYTES = 8 << 20

_FIXED = (T.NumericType, T.BooleanType, T.DatetimeType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.NullType)


def row_bytes(schema: T.StructType) -> Column:
    """The bytes of a row's values: eight for those of fixed width, texts by their length,
    nested values by that of their JSON."""
    total = F.lit(0).cast("bigint")
    for f in schema.fields:
        if isinstance(f.dataType, _FIXED):
            size = F.lit(8)
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(F.col(f"`{f.name}`"))
        else:
            size = F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
        total = total + F.coalesce(size, F.lit(0))
    return total


# Counted sizes of DataFrames checked with ``remember=True``.  A DataFrame's
# plan and file listing are fixed when it is created, so its count cannot
# change; keyed weakly by the object, so nothing outlives the DataFrame.
_COUNTED: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int]]" = weakref.WeakKeyDictionary()
_LOCK = threading.Lock()


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_KEY_ROWS, remember: bool = False) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and MAX_BROADCAST_BYTES bytes (counted).  ``remember`` reuses
    the count for the same DataFrame object (stored dimension tables read by many
    queries of a session)."""
    if max_rows <= 0:
        return False
    with _LOCK:
        seen = _COUNTED.get(df) if remember else None
    # A remembered count is exact when it was within its bound; over its bound
    # it only proves "more than that bound".
    if seen is not None and (seen[0] <= seen[1] or max_rows <= seen[1]):
        n = seen[0]
    else:
        row = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df.schema))).first()
        # Too many bytes count as too many rows.
        n = row[0] if (row[1] or 0) <= MAX_BROADCAST_BYTES else max_rows + 1
        if remember:
            with _LOCK:
                _COUNTED[df] = (n, max_rows)
    return n <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_KEY_ROWS,
                      remember: bool = False) -> DataFrame:
    """``df`` hinted for broadcast when it is small (``is_small``), else for a merge
    join; unchanged if ``max_rows`` is 0."""
    return df if max_rows <= 0 else sized(df, is_small(df, max_rows, remember))


def sized(df: DataFrame, small: bool) -> DataFrame:
    """``df`` hinted for broadcast if it was found small, else for a merge join."""
    return F.broadcast(df) if small else df.hint("merge")
