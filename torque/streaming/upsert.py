"""Incremental upsert of a stream of changed rows (the flows' loads, run as a
Structured Streaming job).

Files landing in a folder are read as a file stream; each micro-batch is
merged into a snapshot table by key, newest row winning by an event-time
order, and published as a new version:

* the previous version is resolved from storage, never from a Python variable,
  so a restarted query continues where it stopped;
* each version records the stream and its last batch, and a batch that the
  table already holds is skipped: exactly-once with the checkpoint, whatever
  else has loaded the table before or in between;
* late rows never overwrite newer ones: the merge compares the event-time
  order of the stored row and the incoming row (stricter than arrival order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.broadcast import bounded_broadcast
from ..operators.merge import dedupe_last
from ..session import once
from ..sources.snapshots import SnapshotTable


def merge_latest(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                 order: Sequence[str | Column]) -> DataFrame:
    """Upsert where the row with the greatest ``order`` wins, whether it is the
    stored or the incoming one.  Only the target rows whose key is in the batch
    take part in the comparison (semi join on the batch keys)."""
    keys = list(keys)
    latest = dedupe_last(incoming, keys, order)
    if target is None:
        return latest
    latest = once(latest)
    inc_keys = bounded_broadcast(latest.select(*keys))
    untouched = target.join(inc_keys, keys, "left_anti")
    contenders = target.join(inc_keys, keys, "left_semi").unionByName(latest)
    return untouched.unionByName(dedupe_last(contenders, keys, order))


def upsert_batch(table: SnapshotTable, keys: Sequence[str], order: Sequence[str | Column], stream: str):
    def handle(batch: DataFrame, batch_id: int) -> None:
        held = table.stream_position(stream)
        if held is not None and held >= batch_id:
            return  # a replay after a crash between commit and checkpoint
        table.apply(batch, lambda base, inc: merge_latest(base, inc, keys, order), stream=(stream, batch_id))
    return handle


def start_upsert_stream(spark: SparkSession, landing: str, schema: StructType, table_root: str,
                        checkpoint: str, keys: Sequence[str], order: Sequence[str],
                        files_per_batch: int = 1, available_now: bool = True, buckets: int | None = None,
                        stream: str | None = None):
    """Start the job; returns the ``StreamingQuery``.  ``stream`` names it in the
    table (default: its checkpoint folder)."""
    source = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch)
              .parquet(landing))
    table = SnapshotTable(spark, table_root, keys, buckets)
    writer = (source.writeStream.foreachBatch(upsert_batch(table, keys, order, stream or checkpoint))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def land_in_parts(df: DataFrame, landing: str, part_col: Column, parts: int) -> None:
    """Land a table as ``parts`` folders, one per residue of ``part_col``, in one pass."""
    df.withColumn("part", part_col % parts).write.mode("overwrite").partitionBy("part").parquet(landing)


def stream_latest_per_key(spark: SparkSession, events: DataFrame, work: str, keys: Sequence[str],
                          order: Sequence[str], parts: int = 3, part_col: str = "event_id") -> DataFrame:
    """Land ``events`` in ``parts`` folders, run the upsert stream over their files (a
    third of them a batch) and return the published table."""
    landing = f"{work}/landing"
    land_in_parts(events, landing, F.col(part_col), parts)
    files = -(-len(spark.read.parquet(landing).inputFiles()) // parts)
    q = start_upsert_stream(spark, f"{landing}/*", events.schema, f"{work}/table",
                            f"{work}/checkpoint", keys, order, files_per_batch=files)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return SnapshotTable(spark, f"{work}/table").read()
