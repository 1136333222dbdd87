"""Checked queries beyond the flows' own operators, each beside its DuckDB SQL: upkeep of
stored tables, digest reconciliation, as-of and interval joins, grouping sets, running
windows, top-k, multisets, sketches and sessions.  ``catalog`` and ``oracles`` take them in.
"""

from __future__ import annotations

import threading
import weakref
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import MERGE_KEY, RATE_BASE_CODE, merge_target, source, ts
from .functions.windows import year_window
from .operators import grouping, multiset, sketches
from .operators.intervals import interval_join
from .operators.ordered import asof_join, running, top_k
from .operators.star import sales_wide
from .plans.digests import reconcile_digest
from .plans.elt import table as elt_table
from .plans.maintain import DIMENSION, FACT, maintain
from .session import scratch_path, staged
from .sources.snapshots import SnapshotTable
from .streaming.sessions import sessions_of_landed
from .upkeep_fixture import Load, upkeep_loads

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# -- upkeep of stored tables -----------------------------------------------------

_KEPT: "weakref.WeakKeyDictionary[SparkSession, dict[str, str]]" = weakref.WeakKeyDictionary()
_LOCK = threading.Lock()
UPKEEP_BUCKETS = 4


def apply_load(spark: SparkSession, root: str, load: Load) -> None:
    # Independent tables: concurrent jobs from a few driver threads, as in the flow.
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda name: elt_table(spark, root, name, UPKEEP_BUCKETS).merge(load.upserts[name]), load.upserts))
    for name, keys in load.deletes.items():
        elt_table(spark, root, name, UPKEEP_BUCKETS).delete(keys)


def upkeep_root(spark: SparkSession, sf: str) -> str:
    """One destination per session and data: three loads, the derived tables maintained after each."""
    with _LOCK:
        roots = _KEPT.setdefault(spark, {})
        if sf not in roots:
            root = scratch_path(spark, "upkeep")
            for load in upkeep_loads(source(spark, sf)):
                apply_load(spark, root, load)
                maintain(spark, root, RATE_BASE_CODE, buckets=UPKEEP_BUCKETS)
            roots[sf] = root
        return roots[sf]


@query("fact_maintained")
def q_fact_maintained(spark, sf):
    """The stored fact after three loads that change every side of it."""
    return SnapshotTable(spark, f"{upkeep_root(spark, sf)}/{FACT.name}").read()


@query("dim_maintained")
def q_dim_maintained(spark, sf):
    return SnapshotTable(spark, f"{upkeep_root(spark, sf)}/{DIMENSION.name}").read()


# -- digest reconciliation --------------------------------------------------------

RECONCILE_BUCKETS = 64


def corrected(df: DataFrame) -> DataFrame:
    """A copy with a few rows changed, a few gone and a few new (FIXTURES.md section 5)."""
    k = F.col(MERGE_KEY)
    changed = df.filter(k % 1499 != 1).withColumn("amount", F.when(k % 997 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    return changed.unionByName(df.filter(k % 1999 == 2).withColumn(MERGE_KEY, k + 1_000_000_000))


@query("reconcile_digest")
def q_reconcile_digest(spark, sf):
    """Two stored copies of the orders, compared by digests; rows are read where those differ."""
    rows = merge_target(source(spark, sf))
    a, b = (SnapshotTable(spark, scratch_path(spark, f"copy-{x}"), [MERGE_KEY], RECONCILE_BUCKETS) for x in "ab")
    a.write(rows)
    b.write(corrected(rows))
    return reconcile_digest(a, b, ["amount", "status"])


# -- ordered rows -------------------------------------------------------------------

def rate_history(sales: DataFrame) -> DataFrame:
    """Rate changes by currency and day, derived from the sales of some days."""
    some = F.dayofyear("transaction_date") % 10 == F.col("currency_id") % 10
    return (sales.filter(some).groupBy("currency_id", F.col("transaction_date").alias("changed_at"))
            .agg(F.max("price").alias("rate")))


@query("asof_rate_sales")
def q_asof_rate_sales(spark, sf):
    """Each sale with the last rate change of its currency at or before it, twenty days back at most."""
    sales = source(spark, sf).car_sales
    history = rate_history(sales).withColumn("rate_date", F.col("changed_at"))
    out = asof_join(sales.select("id", "currency_id", "transaction_date"), history, ["currency_id"], "transaction_date",
                    "changed_at", ["rate", "rate_date"], tolerance=F.expr("interval 20 days"))
    return out.withColumnRenamed("id", "sale_id")


@query("running_sales_by_brand")
def q_running_sales_by_brand(spark, sf):
    """Running totals of every brand's sales in the order of their time."""
    src = source(spark, sf)
    sales = src.car_sales.join(src.cars.select(F.col("id").alias("car"), "brand_id"), F.col("car_id") == F.col("car"), "left")
    rows = sales.select(F.col("id").alias("sale_id"), "brand_id", "transaction_date",
                        F.round(F.col("price") * 100).cast("bigint").alias("cents"))
    return running(rows, ["brand_id"], ["transaction_date", "sale_id"], {
        "total_cents": ("sum", "cents"), "n_sales": ("count", "cents"), "highest": ("max", "cents"), "lowest": ("min", "cents")})


@query("top_sales_per_city")
def q_top_sales_per_city(spark, sf):
    """The five highest sales of each city; of equal prices the smaller id is first."""
    src = source(spark, sf)
    customers = src.customers.select(F.col("id").alias("customer"), F.col("address_city_id").alias("city_id"))
    rows = src.car_sales.join(customers, F.col("customer_id") == F.col("customer")).select("city_id", F.col("id").alias("sale_id"), "price")
    return top_k(rows, ["city_id"], [F.col("price").desc(), F.col("sale_id").asc()], 5)


# -- intervals ------------------------------------------------------------------------

STILL_SOLD = "1999-01-01"


@query("interval_overlap_cars")
def q_interval_overlap_cars(spark, sf):
    """Pairs of cars of one brand and type that were on sale at the same time."""
    cars = source(spark, sf).cars.select("id", "brand_id", "type_id", F.col("created_at").alias("first_day"),
                                         F.coalesce("deleted_at", ts(STILL_SOLD)).alias("last_day"))
    span = ("first_day", "last_day")
    pairs = interval_join(cars, cars, span, span, [("brand_id", "brand_id"), ("type_id", "type_id")], "30 days",
                          F.col("l.id") < F.col("r.id"))
    first, last = F.greatest("l.first_day", "r.first_day"), F.least("l.last_day", "r.last_day")
    return pairs.select(F.col("l.id").alias("car_id"), F.col("r.id").alias("other_car_id"), first.alias("both_from"),
                        last.alias("both_to"))


# -- groups and multisets --------------------------------------------------------------

def _sales_1997(spark, sf):
    wide = sales_wide(source(spark, sf).tables(), year_window(1997))
    return wide.select("brand_name", "currency_name", F.month("transaction_date").alias("month"),
                       F.round(F.col("sale_price") * 100).cast("bigint").alias("cents"))


MEASURES = {"total_cents": ("sum", "cents"), "n_sales": ("count", "cents"), "highest": ("max", "cents"), "lowest": ("min", "cents"),
            "mean_cents": ("avg", "cents")}


@query("sales_cube")
def q_sales_cube(spark, sf):
    return grouping.cube(_sales_1997(spark, sf), ["brand_name", "currency_name", "month"], MEASURES)


@query("sales_rollup")
def q_sales_rollup(spark, sf):
    return grouping.rollup(_sales_1997(spark, sf), ["currency_name", "month", "brand_name"], MEASURES)


def _line_kinds(spark, sf):
    line = source(spark, sf).table("lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber", "l_shipdate")
    before = F.col("l_shipdate") < ts("1998-06-01")
    return [line.filter(x).drop("l_shipdate") for x in (before, ~before)]


@query("sales_except_all")
def q_sales_except_all(spark, sf):
    """Kinds of lines that were shipped more often before June 1998 than from then on, as often."""
    return multiset.except_all(*_line_kinds(spark, sf))


@query("sales_intersect_all")
def q_sales_intersect_all(spark, sf):
    return multiset.intersect_all(*_line_kinds(spark, sf))


# -- sketches ----------------------------------------------------------------------------

DISTINCT, QUANTILES, RANKS = ["l_partkey", "l_orderkey", "l_quantity"], ["l_quantity", "l_extendedprice"], [0.05, 0.25, 0.5, 0.75, 0.95]


@query("sketch_profile")
def q_sketch_profile(spark, sf):
    """A profile of the lines merged from the stored sketches of their monthly loads, held against exact values."""
    line = source(spark, sf).table("lineitem")
    month = F.date_trunc("month", F.col("l_shipdate")).alias("load")
    stored = staged(sketches.sketch_rows(line, [month], DISTINCT, QUANTILES), "sketches")
    estimates = sketches.profile(sketches.merged(stored, DISTINCT, QUANTILES), DISTINCT, QUANTILES, RANKS)
    return sketches.audit(line, staged(estimates, "profile"), DISTINCT, QUANTILES, RANKS)


# -- streaming sessions --------------------------------------------------------------------

SESSION_GAP, SESSION_DELAY = "12 hours", "1 hour"


@query("stream_sessions")
def q_stream_sessions(spark, sf):
    """Sessions of the users' events, from a stream that is restarted twice."""
    events = source(spark, sf).table("events").select("event_id", "ts", "user_id", "value")
    cents = F.round(F.col("value") * 100).cast("bigint")
    out = sessions_of_landed(spark, events, scratch_path(spark, "sessions"), ["user_id"], "ts", SESSION_GAP, SESSION_DELAY,
                             [F.count("event_id").alias("n_events"), F.sum(cents).alias("cents")])
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events", "cents")


# -- DuckDB SQL: key -> (body, fixture views it needs) -----------------------------------------

_MAINTAINED_SALES = """
select s.* from car_sales s where s.transaction_date < timestamp '1998-01-01' and s.id % 97 <> 0"""

SQL: dict[str, tuple[str, list[str]]] = {
    # Full recomputation from the rows that the three loads leave.
    "fact_maintained": (f"""
select s.id as sale_id, b.id as brand_id, b.name as brand_name, c.id as car_id, c.name as car_name, s.price as sale_price,
       s.currency_id, k.name as currency_name, s.price / r.rate as sale_price_normalized,
       'USD' as sale_price_normalized_currency, r.updated_at as exchange_rate_date, s.transaction_date
from ({_MAINTAINED_SALES}) s
join cars c on c.id = s.car_id and c.id % 20 <> 13
join brands b on b.id = c.brand_id and b.id <> 7
join currencies k on k.id = s.currency_id join rates r on r.code = k.name
where s.customer_id in (select u.id from customers u join cities y on y.id = u.address_city_id)""",
                        ["car_sales", "cars", "brands", "currencies", "rates", "customers", "cities"]),
    "dim_maintained": ("""
select c.id, c.name as car_name, b.id as brand_id, b.name as brand_name, y.id as type_id, y.name as type_name, c.created_at,
       if(coalesce(b.updated_at, b.created_at) > coalesce(c.updated_at, c.created_at), b.updated_at, c.updated_at) as updated_at,
       if(coalesce(b.deleted_at, b.created_at) > coalesce(c.deleted_at, c.created_at), b.deleted_at, c.deleted_at) as deleted_at
from cars c join brands b on b.id = c.brand_id join types y on y.id = c.type_id
where c.id % 20 <> 13 and b.id <> 7""", ["cars", "brands", "types"]),
    "reconcile_digest": ("""
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
       case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' else 'changed' end as difference,
       a.amount as amount_a, b.amount as amount_b, a.status as status_a, b.status as status_b
from m_target a full outer join (
    select o_orderkey, if(o_orderkey % 997 = 0, amount + 1, amount) as amount, status from m_target where o_orderkey % 1499 <> 1
    union all
    select o_orderkey + 1000000000, amount, status from m_target where o_orderkey % 1999 = 2) b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.amount is distinct from b.amount""", ["m_target"]),
    "asof_rate_sales": ("""
with history as (
    select currency_id, transaction_date as changed_at, max(price) as rate from car_sales
    where dayofyear(transaction_date) % 10 = currency_id % 10 group by all)
select s.id as sale_id, s.currency_id, s.transaction_date,
       case when h.changed_at >= s.transaction_date - interval 20 day then h.rate end as rate,
       case when h.changed_at >= s.transaction_date - interval 20 day then h.changed_at end as rate_date
from car_sales s asof left join history h on s.currency_id = h.currency_id and s.transaction_date >= h.changed_at""", ["car_sales"]),
    "running_sales_by_brand": ("""
select s.id as sale_id, c.brand_id, s.transaction_date, cents, sum(cents) over w::bigint as total_cents, count(*) over w as n_sales,
       max(cents) over w as highest, min(cents) over w as lowest
from (select *, round(price * 100)::bigint as cents from car_sales) s left join cars c on c.id = s.car_id
window w as (partition by c.brand_id order by s.transaction_date, s.id rows unbounded preceding)""", ["car_sales", "cars"]),
    "top_sales_per_city": ("""
select * from (
    select u.address_city_id as city_id, s.id as sale_id, s.price,
           row_number() over (partition by u.address_city_id order by s.price desc, s.id) as rank
    from car_sales s join customers u on u.id = s.customer_id) where rank <= 5""", ["car_sales", "customers"]),
    "interval_overlap_cars": ("""
with spans as (select id, brand_id, type_id, created_at as first_day, coalesce(deleted_at, timestamp '1999-01-01') as last_day from cars)
select l.id as car_id, r.id as other_car_id, greatest(l.first_day, r.first_day) as both_from, least(l.last_day, r.last_day) as both_to
from spans l join spans r on l.brand_id = r.brand_id and l.type_id = r.type_id and l.id < r.id
where l.first_day <= l.last_day and r.first_day <= r.last_day and l.first_day <= r.last_day and r.first_day <= l.last_day""", ["cars"]),
}

_KINDS = """
with line as (select l_returnflag, l_linestatus, l_quantity, l_linenumber, l_shipdate < timestamp '1998-06-01' as early from lineitem)
select * exclude (early) from line where early {op} select * exclude (early) from line where not early"""
SQL["sales_except_all"] = (_KINDS.format(op="except all"), [])
SQL["sales_intersect_all"] = (_KINDS.format(op="intersect all"), [])

_GROUPED = """
select brand_name, currency_name, month, grouping({dims}) as grouping_id, sum(cents)::bigint as total_cents, count(cents) as n_sales,
       max(cents) as highest, min(cents) as lowest, sum(cents)::double / count(cents) as mean_cents
from (select brand_name, currency_name, month(transaction_date) as month, round(sale_price * 100)::bigint as cents from sales_wide)
group by {kind}({dims})"""
SQL["sales_cube"] = (_GROUPED.format(kind="cube", dims="brand_name, currency_name, month"), ["sales_wide"])
SQL["sales_rollup"] = (_GROUPED.format(kind="rollup", dims="currency_name, month, brand_name"), ["sales_wide"])

_PROFILED = """
select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, {d} as distinct_exact, {dh} as distinct_holds,
       {lo} as min, {hi} as max, {qh} as quantiles_hold from lineitem"""
SQL["sketch_profile"] = (" union all ".join(_PROFILED.format(
    c=c, d=f"count(distinct {c})" if c in DISTINCT else "null::bigint", dh="true" if c in DISTINCT else "null::boolean",
    lo=f"min({c})::double" if c in QUANTILES else "null::double", hi=f"max({c})::double" if c in QUANTILES else "null::double",
    qh="true" if c in QUANTILES else "null::boolean") for c in dict.fromkeys([*DISTINCT, *QUANTILES])), [])

SQL["stream_sessions"] = ("""
select user_id, min(ts) as session_start, max(ts) + interval 12 hour as session_end, count(*) as n_events,
       sum(round(value * 100)::bigint)::bigint as cents
from (select *, sum(opens::int) over (partition by user_id order by ts, event_id) as n
      from (select *, coalesce(ts >= lag(ts) over (partition by user_id order by ts, event_id) + interval 12 hour, true) as opens from events))
group by user_id, n""", [])
