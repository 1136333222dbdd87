"""G1, the ETL flow: extract the sales star for a window, convert prices into
the rates' base currency, keep valid rows, upsert ``car_sales_dataset`` and
write the windowed Parquet file.

One lazy plan feeds both sinks; the rule counts are observed during the
write instead of by a second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from .. import schemas
from ..functions.normalize import normalize_currency
from ..functions.windows import Window, parquet_name
from ..operators import quality as Q
from ..operators.star import Tables, sales_wide, to_dataset
from ..session import scratch_path
from ..sources import snapshots
from ..sources.rates import RatesSnapshot


@dataclass
class EtlFrames:
    wide: DataFrame
    normalized: DataFrame
    validated: DataFrame


def etl_frames(t: Tables, rates: RatesSnapshot, window: Window, target_code: str = "USD",
               mode: str = "floor", rules: dict[str, Column] | None = None) -> EtlFrames:
    wide = sales_wide(t, window)
    normalized = normalize_currency(wide, rates, target_code, mode)
    validated = Q.apply_rules(normalized, rules or Q.etl_rules())
    return EtlFrames(wide, normalized, validated)


def etl_dataset(t: Tables, rates: RatesSnapshot, window: Window, **kw) -> DataFrame:
    """The 12 destination columns of the valid rows (what the upsert loads)."""
    return to_dataset(etl_frames(t, rates, window, **kw).validated)


def run_etl(spark: SparkSession, t: Tables, rates: RatesSnapshot, window: Window,
            dest_root: str, target_code: str = "USD", mode: str = "floor",
            buckets: int | None = None) -> dict:
    """Run the flow with writes: upsert into the ``car_sales_dataset`` snapshot
    table and write the 15-column Parquet file named by the window.

    The valid rows are written once to the work folder (with the rule counts
    observed on the way), checked and upserted from there, and the windowed
    file is written from the same rows last: a batch that breaks a constraint
    changes nothing that readers see."""
    frames = etl_frames(t, rates, window, target_code, mode, rules={})
    valid, obs = Q.observed_rules(frames.normalized, Q.etl_rules())
    staged = scratch_path(spark, "etl-valid")
    valid.select(*schemas.NORMALIZED_COLUMNS).write.parquet(staged)
    counts = obs.get
    written = spark.read.parquet(staged)
    incoming = Q.check(to_dataset(written), Q.dataset_constraints(), ["sale_id"], mode="fail")
    table = snapshots.SnapshotTable(spark, f"{dest_root}/car_sales_dataset", ["sale_id"], buckets)
    version = table.merge(incoming)
    path = snapshots.parquet_sink(written, f"{dest_root}/parquet", parquet_name("car_sales_dataset", window))
    return {"parquet": path, "table_version": version, "rule_counts": counts}
