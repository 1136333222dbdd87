"""Exchange-rate documents to a rates table (code, rate, updated_at).

A document is the JSON the rates service returns: a base code, the publish
time in unix seconds and a ``conversion_rates`` map.  The map is exploded on
the executors; the driver only learns the document's base code (one value).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


# A rates snapshot is broadcast when it has at most this many codes (there are
# fewer than 200 currency codes; the bound is checked when the snapshot is built).
MAX_BROADCAST_CODES = 100_000


@dataclass(frozen=True)
class RatesSnapshot:
    """A pinned rates table (one row per code), the currency its rates are
    quoted against and its number of codes, counted when it was built."""

    table: DataFrame
    base_code: str
    n_codes: int | None = None
    latest_unix: int | None = None   # newest publish time, when known at build time

    def latest_time(self) -> Column:
        """A1: the snapshot's newest rate time.  A literal when the snapshot
        recorded it (folded into the plan), else a scalar subquery."""
        if self.latest_unix is not None:
            return unix_to_utc_ntz(F.lit(int(self.latest_unix)).cast("bigint"))
        return self.table.select(F.max("updated_at")).scalar()

    def broadcastable(self) -> DataFrame:
        """The table, hinted for broadcast when its counted size is within the
        bound (never on an unchecked size)."""
        if self.n_codes is not None and self.n_codes <= MAX_BROADCAST_CODES:
            return F.broadcast(self.table)
        return self.table


def explode_document(doc: DataFrame) -> DataFrame:
    """Document rows to rate rows.  ``rate`` is always DOUBLE (documents mix
    integral and decimal numbers); the publish time becomes a UTC wall-clock
    TIMESTAMP_NTZ whatever the session time zone."""
    return (doc.select(
                F.explode("conversion_rates").alias("code", "rate"),
                F.col("time_last_update_unix").alias("unix"))
            .select(
                F.col("code"),
                F.col("rate").cast("double").alias("rate"),
                unix_to_utc_ntz(F.col("unix")).alias("updated_at")))


def unix_to_utc_ntz(seconds: Column) -> Column:
    """Unix seconds as a UTC wall-clock TIMESTAMP_NTZ, independent of the
    session time zone."""
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def latest_per_code(rates: DataFrame) -> DataFrame:
    """One row per code: the newest rate when several documents are read
    together (a folder of daily documents).  Bounded by the number of codes."""
    return (rates.groupBy("code")
            .agg(F.max_by("rate", "updated_at").alias("rate"), F.max("updated_at").alias("updated_at")))


def _snapshot(doc: DataFrame) -> RatesSnapshot:
    meta = doc.agg(F.collect_set("base_code").alias("b"), F.max("time_last_update_unix").alias("t")).first()
    bases = meta["b"]
    if len(bases) != 1:
        raise ValueError(f"rates documents must share one base code, got {sorted(bases)}")
    table = latest_per_code(explode_document(doc))
    return RatesSnapshot(table, bases[0], table.count(), meta["t"])


def read_rates_document(spark: SparkSession, path: str) -> RatesSnapshot:
    """Read one or many landed rate documents (a file, folder or glob) as one
    snapshot: the newest rate of each code."""
    doc = (spark.read.schema(schemas.RATES_DOCUMENT)
           .option("multiLine", True).json(path))
    return _snapshot(doc)


def rates_document(spark: SparkSession, base_code: str, unix_time: int,
                   rates: dict[str, float]) -> DataFrame:
    """A rates document given as values, built as a JVM-side one-row relation
    (no Python worker is involved in scanning it)."""
    pairs = [x for code, rate in rates.items() for x in (F.lit(code), F.lit(float(rate)).cast("double"))]
    return spark.range(1).select(
        F.lit(base_code).cast("string").alias("base_code"),
        F.lit(int(unix_time)).cast("bigint").alias("time_last_update_unix"),
        F.create_map(*pairs).alias("conversion_rates"))


def rates_from_mapping(spark: SparkSession, base_code: str, unix_time: int,
                       rates: dict[str, float]) -> RatesSnapshot:
    doc = rates_document(spark, base_code, unix_time, rates)
    return RatesSnapshot(explode_document(doc), base_code, len(rates), int(unix_time))
