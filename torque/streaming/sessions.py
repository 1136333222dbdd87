"""Sessions of a stream: event-time windows that end after a gap, with state that expires.

Events of a key belong to one session while each follows the one before within the
gap.  The stream keeps the open sessions only: once the watermark (the latest event
time less the allowed delay) has passed a session's end, it is written and its state
is dropped, and events later than that are dropped by Spark.  Output is append-only
Parquet with the checkpoint's exactly-once commit log, so a restarted query goes on
where it stopped and writes no session twice.

:func:`sessions` is the same aggregation over any DataFrame, batch or stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import staged

START, END = "session_start", "session_end"


def sessions(events: DataFrame, keys: Sequence[str], time: str, gap: str, aggregates: Sequence[Column],
             delay: str | None = None) -> DataFrame:
    """(keys, session_start, session_end, aggregates) of each session; session_end is the
    last event's time and the gap.  Sessions merge in partial aggregation, so a hot key
    leaves each task as its sessions, not its events.  Events without a time have no session."""
    at = F.col(time).cast("timestamp")
    rows = events.filter(F.col(time).isNotNull()).withColumn(time, at)
    if delay is not None:
        rows = rows.withWatermark(time, delay)
    window = F.session_window(time, gap)
    out = rows.groupBy(*keys, window.alias("w")).agg(*aggregates)
    return out.select(*keys, F.col("w.start").alias(START), F.col("w.end").alias(END),
                      *[c for c in out.columns if c not in keys and c != "w"])


def run_session_stream(spark: SparkSession, landing: str, schema: StructType, out: str, checkpoint: str, keys: Sequence[str],
                       time: str, gap: str, delay: str, aggregates: Sequence[Column]) -> None:
    """Read the files that have landed since the last run and append the sessions that have
    ended; open ones stay in the checkpoint's state."""
    source = spark.readStream.schema(schema).parquet(landing)
    query = (sessions(source, keys, time, gap, aggregates, delay).writeStream.format("parquet").outputMode("append")
             .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def closing_event(events: DataFrame, time: str, after: str) -> DataFrame:
    """One event without a key or value, ``after`` the latest one: once it has been read,
    the watermark has passed every session before it."""
    latest = events.agg(F.max(time).alias("t"))
    moved = (F.col("t") + F.expr(f"interval {after}")).cast(events.schema[time].dataType)
    return latest.select(*[(moved if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema.fields])


def sessions_of_landed(spark: SparkSession, events: DataFrame, work: str, keys: Sequence[str], time: str, gap: str, delay: str,
                       aggregates: Sequence[Column], parts: int = 3) -> DataFrame:
    """Land ``events`` in ``parts`` pieces of time, run the stream after each (every run but
    the first is a restart) and once more after a closing event; return the written sessions."""
    landing, out, checkpoint = f"{work}/landing", f"{work}/sessions", f"{work}/checkpoint"
    span = events.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    lo, hi = span.select(F.unix_micros(F.col("lo").cast("timestamp"))).scalar(), span.select(F.unix_micros(F.col("hi").cast("timestamp"))).scalar()
    at = F.unix_micros(F.col(time).cast("timestamp"))
    part = F.least(F.lit(parts - 1), F.floor((at - lo) * F.lit(parts) / (hi - lo + 1)))
    dealt = staged(events.withColumn("__part", part.cast("int")), "dealt-events")
    for i in range(parts):
        dealt.filter(F.col("__part") == i).drop("__part").write.mode("append").parquet(landing)
        run_session_stream(spark, landing, events.schema, out, checkpoint, keys, time, gap, delay, aggregates)
    closing_event(events, time, "3650 days").write.mode("append").parquet(landing)
    run_session_stream(spark, landing, events.schema, out, checkpoint, keys, time, gap, delay, aggregates)
    written = spark.read.parquet(out)
    return written.filter(" and ".join(f"{k} is not null" for k in keys)) if keys else written
