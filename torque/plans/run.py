"""Run both flows in turn over stored source tables (the source project's
entry point): ETL into ``car_sales_dataset`` + windowed Parquet, then ELT into
the destination tables, dimension and fact.

    python -m torque --source-root S --rates R --dest-root D [--year 2025] [--follow]

``--year`` defaults to last calendar year, as the source jobs; pass it to make
a run repeatable.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from ..functions.windows import last_year_window, year_window
from ..sources.rates import RatesSnapshot, read_rates_document
from ..sources.tables import read_source_tables
from .elt import run_elt
from .etl import run_etl


def run_both(spark: SparkSession, source: dict, rates: RatesSnapshot, year: int | None, dest_root: str,
             full_load: bool = False, buckets: int = 64, follow: bool = False) -> dict:
    """``year=None``: last calendar year.  ``follow``: the ELT's fact and dimension follow
    changes of every loaded table (``plans.maintain``), not only of the window's sales."""
    window = last_year_window() if year is None else year_window(year)
    t0 = time.perf_counter()
    etl = run_etl(spark, source, rates, window, f"{dest_root.rstrip('/')}/etl", buckets=buckets)
    t1 = time.perf_counter()
    elt = run_elt(spark, source, rates, window, f"{dest_root.rstrip('/')}/elt", full_load=full_load,
                  buckets=buckets, follow=follow)
    t2 = time.perf_counter()
    return {"window": window.label(), "etl": etl, "elt": elt,
            "etl_sec": round(t1 - t0, 3), "elt_sec": round(t2 - t1, 3)}


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="torque")
    ap.add_argument("--source-root", required=True, help="folder holding one table per source table name")
    ap.add_argument("--rates", required=True, help="rates document(s): file, folder or glob")
    ap.add_argument("--dest-root", required=True, help="shared folder for the destination tables")
    ap.add_argument("--year", type=int, help="calendar year of the window (default: last year)")
    ap.add_argument("--follow", action="store_true",
                    help="keep fact and dimension current with changes of every loaded table")
    ap.add_argument("--full-load", action="store_true", help="first load: copy whole tables")
    ap.add_argument("--buckets", type=int, default=64,
                    help="hash buckets of the large destination tables (~1 GB each)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("torque").getOrCreate()
    from ..session import BASE_CONF
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    out = run_both(spark, read_source_tables(spark, args.source_root), read_rates_document(spark, args.rates),
                   args.year, args.dest_root, args.full_load, args.buckets, args.follow)
    print(json.dumps(out, default=str))
    return out
