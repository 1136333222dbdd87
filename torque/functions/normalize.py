"""Currency normalisation: convert each sale price into the rates' base currency.

Modes:

* ``floor``  -- floor of price / rate, as DOUBLE (the ETL job's rule: a sale
  worth less than one target unit becomes 0 and later fails validation);
* ``exact``  -- price / rate as DOUBLE (the ELT fact's rule);
* ``decimal`` -- price / rate in exact decimal arithmetic, rounded half-even to
  two places, DECIMAL(12,2) (the destination's money type).

Division is ``try_divide``: a zero rate gives NULL instead of failing the job
under ANSI mode.  ``floor`` of a DOUBLE is BIGINT in Spark and saturates at
2^63-1; amounts of that size need the ``decimal`` mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.rates import RatesSnapshot

MODES = ("floor", "exact", "decimal")


def convert(price: Column, rate: Column, mode: str = "floor") -> Column:
    if mode == "floor":
        return F.floor(F.try_divide(price, rate)).cast("double")
    if mode == "exact":
        return F.try_divide(price.cast("double"), rate.cast("double"))
    if mode == "decimal":
        q = F.try_divide(price.cast("decimal(12,2)"), rate.cast("decimal(18,6)"))
        return F.bround(q, 2).cast("decimal(12,2)")
    raise ValueError(f"unknown normalisation mode {mode!r}; expected one of {MODES}")


def latest_rate_time(rates: DataFrame) -> Column:
    """A1: the newest rate time of the snapshot as a scalar subquery, evaluated
    once and folded into the plan (no collect, no join)."""
    return rates.select(F.max("updated_at")).scalar()


def normalize_currency(sales: DataFrame, rates: RatesSnapshot, target_code: str = "USD",
                       mode: str = "floor", price_col: str = "sale_price",
                       currency_col: str = "currency_name") -> DataFrame:
    """J4 + E1/E2/E10 + P4/P5: join each sale to its rate by currency code
    (unknown codes drop), add the converted price, the target label and the
    snapshot's newest rate time.  Keeps ``code``, ``rate`` and ``updated_at``
    from the join: the 15-column frame the Parquet sink writes.

    The label comes from the rates: converting into a currency other than the
    snapshot's base is refused instead of mislabelled.
    """
    if rates.base_code != target_code:
        raise ValueError(f"rates are quoted against {rates.base_code}, not {target_code}")
    # One row per currency code, counted when the snapshot was built: it is
    # broadcast, so the sales are never shuffled by their (low-cardinality,
    # skewed) currency.
    r = rates.broadcastable().select("code", "rate", "updated_at")
    out = (sales.withColumn("code", F.col(currency_col))
           .join(r, "code", "inner")
           .withColumn("sale_price_normalized", convert(F.col(price_col), F.col("rate"), mode))
           .withColumn("sale_price_normalized_currency", F.lit(target_code))
           .withColumn("exchange_rate_date", rates.latest_time()))
    added = ["code", "rate", "updated_at", "sale_price_normalized",
             "sale_price_normalized_currency", "exchange_rate_date"]
    return out.select(*[c for c in sales.columns if c not in added], *added)
