"""Parameterised scans and named views.

Parameters are always bound (``?`` markers or Column literals), never pasted
into SQL text.  Views get a per-call unique name so concurrent jobs in one
session cannot see each other's frames.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lookup(spark: SparkSession, df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    """Point lookup ``key = ?`` with a bound parameter.  The predicate
    reaches the Parquet scan (row-group skipping on min/max statistics)."""
    cols = ", ".join(f"`{c}`" for c in columns)
    return spark.sql(f"select {cols} from {{t}} where `{key}` = ?", args=[value], t=df)


def sql_over_view(spark: SparkSession, df: DataFrame, name: str, query: str,
                  args: Sequence | None = None) -> DataFrame:
    """S3: register ``df`` as a temp view and run SQL over it (``{view}`` in the
    text is replaced by the view's unique name)."""
    view = f"{name}_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(view)
    return spark.sql(query.replace("{view}", view), args=list(args or []))


def to_arrow_edge(df: DataFrame, max_rows: int):
    """Hand a small result to a local consumer as an Arrow table.  The row
    bound is enforced: larger results must be written, not fetched."""
    limited = df.limit(max_rows + 1)
    table = limited.toArrow()
    if table.num_rows > max_rows:
        raise ValueError(f"result exceeds {max_rows} rows; write it instead of fetching it")
    return table


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """A relational source read in parallel ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=partitions,
                           properties=properties or {})


def constant_row(spark: SparkSession) -> DataFrame:
    """A one-row relation without a table (``select 10, true``)."""
    return spark.range(1).select(F.lit(10).alias("a"), F.lit(True).alias("b"))


# The source database's tables, in load order.
SOURCE_TABLES = ("brands", "types", "currencies", "cities", "cars", "customers", "car_sales")


def read_source_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The seven source tables stored as ``<root>/<table>`` (Parquet by default)
    with the source schema (``schemas.py``).  Lazy: each query prunes columns
    and pushes its filters into these scans."""
    return {t: spark.read.format(fmt).load(f"{root.rstrip('/')}/{t}") for t in SOURCE_TABLES}
