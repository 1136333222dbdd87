"""Star joins over the sales model: the wide sales extract, the car dimension
and the sales fact.

Tables are passed as a mapping ``name -> DataFrame`` so the same plans run
over the source database (ETL) or over the loaded destination tables (ELT).

Join strategy: the low-cardinality dimensions (currencies, brands, types,
cities) and the rates snapshot are broadcast behind a counted bound, so a
few-valued key (a brand holding a third of the sales) is never a shuffle key.
The fact's cars and customers are under the same bound, beyond it they are merged.
Every other join is left to the planner: static size estimates broadcast a
small side, AQE re-plans from runtime sizes and splits skewed partitions (a car
or customer holding a third of the sales).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.windows import Window, changed_in, event_window
from ..sources.rates import RatesSnapshot
from .broadcast import bounded_broadcast, is_small, sized

Tables = Mapping[str, DataFrame]

# Small reference tables (currencies, brands, types, cities) are broadcast when
# they have at most this many rows.
MAX_DIMENSION_ROWS = 100_000


def _cols(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.select(*[F.col(n).alias(f"{prefix}{n}") for n in names])


def _small(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    """A small reference table, broadcast behind a counted bound (the count is
    remembered for the table object), then projected and prefixed."""
    return _cols(bounded_broadcast(df, MAX_DIMENSION_ROWS, remember=True), prefix, names)


def sales_wide(t: Tables, window: Window | None = None, keep_existence_joins: bool = False) -> DataFrame:
    """J1 + F1 + P1: sales with their car, brand and currency names, every
    dimension LEFT joined, restricted to transactions in the window.

    ``customers`` and ``cities`` add no column and are joined on their primary
    keys, so where those are unique they can neither drop nor repeat a sale: the
    joins are omitted unless ``keep_existence_joins`` (the ``unique_violations``
    query checks the ids of all dimension tables; ``sales_wide_full`` is the
    form with all five joins).
    """
    s = t["car_sales"]
    if window is not None:
        s = s.filter(event_window(window, "transaction_date"))
    s = _cols(s, "s_", ["id", "car_id", "customer_id", "price", "currency_id", "transaction_date"])
    cars = _cols(t["cars"], "c_", ["id", "name", "brand_id"])
    brands = _small(t["brands"], "b_", ["id", "name"])
    cur = _small(t["currencies"], "k_", ["id", "name"])
    j = (s.join(cars, F.col("s_car_id") == F.col("c_id"), "left")
         .join(brands, F.col("c_brand_id") == F.col("b_id"), "left"))
    if keep_existence_joins:
        cust = _cols(t["customers"], "u_", ["id", "address_city_id"])
        city = _small(t["cities"], "y_", ["id"])
        j = (j.join(cust, F.col("s_customer_id") == F.col("u_id"), "left")
             .join(city, F.col("u_address_city_id") == F.col("y_id"), "left"))
    j = j.join(cur, F.col("s_currency_id") == F.col("k_id"), "left")
    return j.select(
        F.col("s_id").alias("sale_id"),
        F.col("b_id").alias("brand_id"),
        F.col("b_name").alias("brand_name"),
        F.col("c_id").alias("car_id"),
        F.col("c_name").alias("car_name"),
        F.col("s_price").alias("sale_price"),
        F.col("s_currency_id").alias("currency_id"),
        F.col("k_name").alias("currency_name"),
        F.col("s_transaction_date").alias("transaction_date"),
    )


# -- car dimension ---------------------------------------------------------

def _latest(car_col: str, brand_col: str) -> Column:
    """The car's value when the car changed at or after the brand (on
    ``coalesce(x, created_at)``), else the brand's.  Returns the raw column, so
    a newer car with a null value yields null: kept as the source defines it."""
    car_key = F.coalesce(F.col(f"c_{car_col}"), F.col("c_created_at"))
    brand_key = F.coalesce(F.col(f"b_{brand_col}"), F.col("b_created_at"))
    return F.when(car_key >= brand_key, F.col(f"c_{car_col}")).otherwise(F.col(f"b_{brand_col}"))


_AUDIT = ["created_at", "updated_at", "deleted_at"]


def _dim_select(j: DataFrame) -> DataFrame:
    return j.select(
        F.col("c_id").alias("id"),
        F.col("c_name").alias("car_name"),
        F.col("b_id").alias("brand_id"),
        F.col("b_name").alias("brand_name"),
        F.col("t_id").alias("type_id"),
        F.col("t_name").alias("type_name"),
        F.col("c_created_at").alias("created_at"),
        _latest("updated_at", "updated_at").alias("updated_at"),
        _latest("deleted_at", "deleted_at").alias("deleted_at"),
    )


def _dim_inputs(t: Tables):
    cars = _cols(t["cars"], "c_", ["id", "name", "brand_id", "type_id", *_AUDIT])
    brands = _small(t["brands"], "b_", ["id", "name", *_AUDIT])
    types = _small(t["types"], "t_", ["id", "name", *_AUDIT])
    return cars, brands, types


def dim_car_detail(t: Tables, window: Window | None) -> DataFrame:
    """G4 = J2 + F3 + E3: cars with brand and type, kept when the car, its
    brand or its type changed in the window (the source query's form: the
    three-way OR is evaluated after both joins).  Without a window: all cars."""
    cars, brands, types = _dim_inputs(t)
    j = (cars.join(brands, F.col("c_brand_id") == F.col("b_id"), "inner")
         .join(types, F.col("c_type_id") == F.col("t_id"), "inner"))
    if window is None:
        return _dim_select(j)
    changed = (changed_in(window, "c_updated_at", "c_created_at")
               | changed_in(window, "b_updated_at", "b_created_at")
               | changed_in(window, "t_updated_at", "t_created_at"))
    return _dim_select(j.filter(changed))


def dim_car_detail_semi(t: Tables, window: Window) -> DataFrame:
    """G4, rewritten for scale.  Brands and types that are broadcast carry a flag
    for their change, so the cars pass each of them once and the filter follows.
    Larger ones: find the changed brand and type ids first (small sets), flag the cars they touch in one pass over ``cars`` (the id sets are
    joined by key, so the cars are not shuffled when the sets are small), keep
    only touched cars, then join the dimension names: only the touched cars
    reach the (possibly shuffled) dimension joins.  Equal to
    ``dim_car_detail`` when brand and type ids are unique (primary keys,
    checked by ``quality.unique_violations``)."""
    cars, brands, types = _dim_inputs(t)
    if all(is_small(t[x], MAX_DIMENSION_ROWS, remember=True) for x in ("brands", "types")):
        brands = brands.withColumn("b_changed", changed_in(window, "b_updated_at", "b_created_at"))
        types = types.withColumn("t_changed", changed_in(window, "t_updated_at", "t_created_at"))
        return _dim_select(cars.join(F.broadcast(brands), F.col("c_brand_id") == F.col("b_id"), "inner")
                           .join(F.broadcast(types), F.col("c_type_id") == F.col("t_id"), "inner")
                           .filter(changed_in(window, "c_updated_at", "c_created_at")
                                   | F.col("b_changed") | F.col("t_changed")))
    # The changed id sets are filters over the dimensions: their estimated
    # size is the whole table, so prove them small before broadcasting.
    cb = bounded_broadcast(brands.filter(changed_in(window, "b_updated_at", "b_created_at"))
                           .select(F.col("b_id").alias("cb_id")))
    ct = bounded_broadcast(types.filter(changed_in(window, "t_updated_at", "t_created_at"))
                           .select(F.col("t_id").alias("ct_id")))
    touched = (cars.join(cb, F.col("c_brand_id") == F.col("cb_id"), "left")
               .join(ct, F.col("c_type_id") == F.col("ct_id"), "left")
               .filter(changed_in(window, "c_updated_at", "c_created_at")
                       | F.col("cb_id").isNotNull() | F.col("ct_id").isNotNull())
               .drop("cb_id", "ct_id"))
    j = (touched.join(brands, F.col("c_brand_id") == F.col("b_id"), "inner")
         .join(types, F.col("c_type_id") == F.col("t_id"), "inner"))
    return _dim_select(j)


# -- sales fact ------------------------------------------------------------

def base_currency_row(rates: RatesSnapshot) -> DataFrame:
    """The one-row relation holding the snapshot's base code, if it is present
    with rate 1 (at most one row: codes are unique in a snapshot)."""
    r = rates.table
    return r.filter((F.col("code") == F.lit(rates.base_code)) & (F.col("rate") == 1)).select(
        F.col("code").alias("base_code"))


def base_code_scalar(base: DataFrame) -> Column:
    """A relation of at most one ``base_code`` row as a scalar subquery
    (NULL when it is empty).  Evaluated once, never joined."""
    return base.select("base_code").scalar()


def base_currency_ordered(rates: DataFrame) -> DataFrame:
    """L1/F9 parity form: the first code, by code, whose rate is 1.  Ordered so
    the answer is deterministic; with several rate-1 codes it may not be the
    real base (use ``RatesSnapshot.base_code``)."""
    return rates.filter(F.col("rate") == 1).select(F.col("code").alias("base_code")).orderBy("base_code").limit(1)


def fact_sales(t: Tables, rates: RatesSnapshot, window: Window | None,
               base: DataFrame | None = None) -> DataFrame:
    """G3 = J3 + J4 + J6 + E2: sales changed in the window (all without one), INNER joined to
    car, brand, currency and rate, priced exactly in the base currency.
    Customers and cities only prove existence, so they are semi-joins (equal to
    the inner joins on unique keys).  The base code is a one-row relation
    joined on true in the source query; here it is a scalar subquery folded
    into the projection (no join at all), and an empty base relation still
    gives an empty fact."""
    s = t["car_sales"] if window is None else t["car_sales"].filter(changed_in(window))
    s = _cols(s, "s_", ["id", "car_id", "customer_id", "price", "currency_id", "transaction_date"])
    cars = _small(t["cars"], "c_", ["id", "name", "brand_id"])
    brands = _small(t["brands"], "b_", ["id", "name"])
    cust = _cols(t["customers"], "u_", ["id", "address_city_id"])
    city = _small(t["cities"], "y_", ["id"])
    cur = _small(t["currencies"], "k_", ["id", "name"])
    rt = _cols(rates.broadcastable(), "r_", ["code", "rate", "updated_at"])
    base = base if base is not None else base_currency_row(rates)
    known_customers = sized(cust.join(city, F.col("u_address_city_id") == F.col("y_id"), "left_semi"),
                            is_small(t["customers"], MAX_DIMENSION_ROWS, remember=True))
    j = (s.join(known_customers, F.col("s_customer_id") == F.col("u_id"), "left_semi")
         .join(cars, F.col("s_car_id") == F.col("c_id"), "inner")
         .join(brands, F.col("c_brand_id") == F.col("b_id"), "inner")
         .join(cur, F.col("s_currency_id") == F.col("k_id"), "inner")
         .join(rt, F.col("k_name") == F.col("r_code"), "inner")
         .withColumn("base_code", base_code_scalar(base))
         .filter(F.col("base_code").isNotNull()))
    return j.select(
        F.col("s_id").alias("sale_id"),
        F.col("b_id").alias("brand_id"),
        F.col("b_name").alias("brand_name"),
        F.col("c_id").alias("car_id"),
        F.col("c_name").alias("car_name"),
        F.col("s_price").alias("sale_price"),
        F.col("s_currency_id").alias("currency_id"),
        F.col("k_name").alias("currency_name"),
        F.try_divide(F.col("s_price").cast("double"), F.col("r_rate")).alias("sale_price_normalized"),
        F.col("base_code").alias("sale_price_normalized_currency"),
        F.col("r_updated_at").alias("exchange_rate_date"),
        F.col("s_transaction_date").alias("transaction_date"),
    )


def to_dataset(df: DataFrame) -> DataFrame:
    """The 12 destination columns in table order."""
    return df.select(*schemas.CAR_SALES_DATASET_COLUMNS)
