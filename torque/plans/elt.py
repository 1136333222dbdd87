"""G2, the ELT flow: copy the rows of seven source tables changed in the
window (and the rates snapshot) into the destination by keyed upsert, then
derive the car dimension and the sales fact inside the destination and
upsert those.

Every load publishes a new snapshot version (``sources.snapshots``), so each
later step reads written files: lineage is cut per table and a lost executor
recomputes at most one step.  A failed step leaves every earlier table at its
new version and every later one at its old version, each table consistent.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..fixtures import SOURCE_COLUMNS
from ..functions.windows import Window, changed_in
from ..operators.star import Tables, dim_car_detail_semi, fact_sales
from ..sources.rates import RatesSnapshot
from ..sources.snapshots import SnapshotTable

# Reference tables first, then the tables that point at them.
LOAD_ORDER = ["brands", "types", "currencies", "cities", "cars", "customers", "car_sales"]
DERIVED = ["dimension_car_detail", "fact_car_sales_dataset"]

# Hash buckets per table: the unit a load rewrites.  Small reference tables
# are one bucket; the large ones are bucketed so a day's changes rewrite only
# the buckets their keys fall in (size for ~1 GB per bucket at scale).
SMALL_TABLES = {"brands", "types", "currencies", "cities", "currency_rates"}


# Tables the flow scans by change window are stored in change-time order.
CHANGE_ORDERED = {"brands", "types", "currencies", "cities", "cars", "customers", "car_sales"}


def table(spark: SparkSession, dest_root: str, name: str, buckets: int | None) -> SnapshotTable:
    return SnapshotTable(spark, f"{dest_root}/{name}", schemas.PRIMARY_KEYS[name],
                         1 if name in SMALL_TABLES else buckets,
                         sort_by=[F.coalesce(F.col("updated_at"), F.col("created_at"))]
                         if name in CHANGE_ORDERED else [])


def extract_changed(df: DataFrame, window: Window) -> DataFrame:
    """P2 + F2: every column of a table, rows whose last change
    (``coalesce(updated_at, created_at)``) lies in the window."""
    return df.filter(changed_in(window))


def destination(spark: SparkSession, dest_root: str) -> dict[str, DataFrame]:
    out = {}
    for name in LOAD_ORDER + ["currency_rates"] + DERIVED:
        df = SnapshotTable(spark, f"{dest_root}/{name}").read()
        if df is not None:
            out[name] = df
    return out


def run_elt(spark: SparkSession, source: Tables, rates: RatesSnapshot, window: Window,
            dest_root: str, full_load: bool = False, buckets: int | None = None,
            parallel_loads: int = 4, follow: bool = False) -> dict[str, int | None]:
    """Run the flow.  ``follow``: fact and dimension are kept equal to a full computation over
    the loaded tables (``maintain``) in place of an upsert of the window's changes.  ``full_load`` copies whole tables instead of the window's
    changes (a first load: the incremental flow only joins dimension rows it
    has loaded, so without it facts of unchanged dimensions are missing)."""
    def load(name: str) -> int | None:
        if name == "currency_rates":
            return table(spark, dest_root, name, buckets).merge(rates.table)
        rows = source[name] if full_load else extract_changed(source[name], window)
        return table(spark, dest_root, name, buckets).merge(rows.select(*SOURCE_COLUMNS[name]))

    # The table loads are independent (each reads its own source and writes its
    # own table), so they are submitted as concurrent Spark jobs from a few
    # driver threads; the dimension and fact wait for all of them.
    names = LOAD_ORDER + ["currency_rates"]
    with ThreadPoolExecutor(max_workers=max(1, parallel_loads)) as pool:
        versions: dict[str, int | None] = dict(zip(names, pool.map(load, names)))

    dest = destination(spark, dest_root)
    if not all(n in dest for n in LOAD_ORDER):
        return versions  # nothing loaded yet for some table: no dimension or fact
    if follow:
        from .maintain import maintain
        return versions | maintain(spark, dest_root, rates.base_code, buckets=buckets)
    n_codes = dest["currency_rates"].count()
    dest_rates = RatesSnapshot(dest["currency_rates"], rates.base_code, n_codes=n_codes)
    dim = dim_car_detail_semi(dest, window)
    versions["dimension_car_detail"] = table(spark, dest_root, "dimension_car_detail", buckets).merge(dim)
    fact = fact_sales(dest, dest_rates, window)
    versions["fact_car_sales_dataset"] = table(spark, dest_root, "fact_car_sales_dataset", buckets).merge(fact)
    return versions
