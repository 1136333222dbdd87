"""Table schemas of the sales data model and the column orders of its outputs."""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()

AUDIT = [
    T.StructField("created_at", TS, False),
    T.StructField("updated_at", TS, True),
    T.StructField("deleted_at", TS, True),
]


def _named_dim() -> T.StructType:
    return T.StructType([T.StructField("id", T.LongType(), False),
                         T.StructField("name", T.StringType(), False), *AUDIT])


BRANDS = _named_dim()
TYPES = _named_dim()
CURRENCIES = _named_dim()
CITIES = _named_dim()

CARS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("brand_id", T.LongType(), False),
    T.StructField("type_id", T.LongType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("currency_id", T.LongType(), False),
    T.StructField("stock", T.IntegerType(), False),
    T.StructField("release_date", T.DateType(), False),
    *AUDIT,
])

CUSTOMERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("address_city_id", T.LongType(), False),
    *AUDIT,
])

CAR_SALES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("car_id", T.LongType(), True),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("currency_id", T.LongType(), True),
    T.StructField("transaction_date", TS, False),
    *AUDIT,
])

# The rates document as it lands from the rates service (other keys unused).
RATES_DOCUMENT = T.StructType([
    T.StructField("base_code", T.StringType(), True),
    T.StructField("time_last_update_unix", T.LongType(), True),
    T.StructField("conversion_rates", T.MapType(T.StringType(), T.DoubleType()), True),
])

RATES = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("rate", T.DoubleType(), True),
    T.StructField("updated_at", TS, True),
])

# Output column orders.
SALES_WIDE_COLUMNS = [
    "sale_id", "brand_id", "brand_name", "car_id", "car_name", "sale_price",
    "currency_id", "currency_name", "transaction_date",
]

# The normalised frame keeps the rates columns of the join (15 columns); this is
# what the Parquet sink writes.
NORMALIZED_COLUMNS = SALES_WIDE_COLUMNS + [
    "code", "rate", "updated_at", "sale_price_normalized",
    "sale_price_normalized_currency", "exchange_rate_date",
]

# Destination table ``car_sales_dataset`` (12 columns, table order) and the
# ELT fact of the same shape.
CAR_SALES_DATASET_COLUMNS = [
    "sale_id", "brand_id", "brand_name", "car_id", "car_name", "sale_price",
    "currency_id", "currency_name", "sale_price_normalized",
    "sale_price_normalized_currency", "exchange_rate_date", "transaction_date",
]

DIM_CAR_DETAIL_COLUMNS = [
    "id", "car_name", "brand_id", "brand_name", "type_id", "type_name",
    "created_at", "updated_at", "deleted_at",
]

# Primary keys of every table the pipelines write.
PRIMARY_KEYS = {
    "brands": ["id"], "types": ["id"], "currencies": ["id"], "cities": ["id"],
    "cars": ["id"], "customers": ["id"], "car_sales": ["id"],
    "currency_rates": ["code"], "dimension_car_detail": ["id"],
    "fact_car_sales_dataset": ["sale_id"], "car_sales_dataset": ["sale_id"],
}
