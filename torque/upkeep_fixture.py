"""Loads that change every side of the stored fact: rows in the schema of the source
tables, cut from the fixture's views by their ids (FIXTURES.md section 5).

Three loads.  The first holds old brand and car names, misses some cars, customers and a
city, and has an old euro rate; the later ones bring the rest, correct prices and delete
sales and a brand.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixtures import RATE_BASE_CODE, RATE_UNIX_TIME, RATES, Source, ts
from .sources.rates import rates_from_mapping

# Fixed values of the fixture.
OLD_EURO_RATE = 0.9
LATE_CITY, GONE_BRAND, GONE_SALES = 7, 7, 97
HALF_YEAR, LAST_YEAR = "1997-07-01", "1998-01-01"
PRICE_ERROR = 100.0


@dataclass
class Load:
    upserts: dict[str, DataFrame]
    deletes: dict[str, DataFrame] = field(default_factory=dict)


def _old(df: DataFrame, column: str, when: Column) -> DataFrame:
    return df.withColumn(column, F.when(when, F.concat(F.lit("Old "), F.col(column))).otherwise(F.col(column)))


def _rates(src: Source, rates: dict[str, float]) -> DataFrame:
    return rates_from_mapping(src.spark, RATE_BASE_CODE, RATE_UNIX_TIME, rates).table


def upkeep_loads(src: Source) -> list[Load]:
    k = F.col("id")
    sales, cars, brands, customers = src.car_sales, src.cars, src.brands, src.customers
    early, late = F.col("transaction_date") < ts(HALF_YEAR), F.col("transaction_date") < ts(LAST_YEAR)
    wrong = F.when(k % 11 == 0, F.col("price") + PRICE_ERROR).otherwise(F.col("price"))
    old_rates = {c: r for c, r in RATES.items() if c != "KWD"} | {"EUR": OLD_EURO_RATE}
    return [
        Load({"brands": _old(brands, "name", k % 3 == 0), "types": src.types, "currencies": src.currencies,
              "cities": src.cities.filter(k != LATE_CITY), "cars": _old(cars.filter(k % 10 != 3), "name", k % 10 == 4),
              "customers": customers.filter(k % 20 != 5), "car_sales": sales.filter(early).withColumn("price", wrong),
              "currency_rates": _rates(src, old_rates)}),
        Load({"brands": brands.filter(k % 6 == 0), "cars": cars.filter(k % 10 == 4), "customers": customers.filter(k % 40 == 5),
              "car_sales": sales.filter(~early & late), "currency_rates": _rates(src, RATES | {"EUR": OLD_EURO_RATE})}),
        Load({"brands": brands.filter(k % 6 == 3), "cities": src.cities.filter(k == LATE_CITY), "cars": cars.filter(k % 20 == 3),
              "customers": customers.filter(k % 40 == 25), "car_sales": sales.filter(early & (k % 11 == 0)),
              "currency_rates": _rates(src, RATES)},
             {"car_sales": sales.filter(k % GONE_SALES == 0).select("id"), "brands": brands.filter(k == GONE_BRAND).select("id")}),
    ]
