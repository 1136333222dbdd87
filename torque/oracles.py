"""Independent DuckDB SQL for every registered query.

The oracle restates each fixture view and each query in plain SQL over the
driver's tables (``orders``, ``lineitem``, ``customer``, ``part``, ``nation``,
``events``).  It is written from the operators' rules and takes other forms than
the Spark plans (look-ups by id, change flags, full joins, window functions), so a
match checks the rewrites too.  One choice is ours in both: the fact's label is the
base currency USD, where the source takes a code whose rate is 1.
"""

from __future__ import annotations

from . import catalog_derived

# -- fixture views (the source database) -------------------------------------

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = sql
    DEPS[name] = deps or []


cte("car_sales", """
select o.o_orderkey as id,
       l.car_id as car_id,
       o.o_custkey as customer_id,
       cast(o.o_totalprice as double) as price,
       cast(c.c_nationkey % 6 + 1 as bigint) as currency_id,
       o.o_orderdate as transaction_date,
       o.o_orderdate as created_at,
       l.updated_at as updated_at,
       cast(null as timestamp) as deleted_at
from orders o
left join (select l_orderkey, min(l_partkey) as car_id,
                  max(case when l_returnflag = 'R' then l_shipdate end) as updated_at
           from lineitem group by l_orderkey) l on o.o_orderkey = l.l_orderkey
left join customer c on o.o_custkey = c.c_custkey""")

cte("brands", """
select id, name,
       timestamp '1995-01-01' + to_days(cast(id * 10 as integer)) as created_at,
       case when id % 3 = 0 then timestamp '1996-01-01' + to_days(cast(id * 20 as integer)) end as updated_at,
       case when id % 7 = 0 then timestamp '1997-06-01' + to_days(cast(id * 5 as integer)) end as deleted_at
from (select distinct cast(substr(p_brand, 7) as bigint) as id, p_brand as name from part)""")

cte("types", """
select id, name,
       timestamp '1995-01-01' + to_days(cast(id * 30 as integer)) as created_at,
       case when id % 2 = 0 then timestamp '1997-03-01' + to_days(cast(id * 3 as integer)) end as updated_at,
       cast(null as timestamp) as deleted_at
from (select cast(dense_rank() over (order by p_type) as bigint) as id, p_type as name
      from (select distinct p_type from part))""")

cte("cars", """
select p.p_partkey as id, p.p_name as name,
       cast(substr(p.p_brand, 7) as bigint) as brand_id,
       t.id as type_id,
       cast(p.p_retailprice as double) as price,
       cast(p.p_partkey % 4 + 1 as bigint) as currency_id,
       cast(p.p_size as integer) as stock,
       cast(timestamp '1995-01-01' + to_days(cast(p.p_size * 15 as integer)) as date) as release_date,
       timestamp '1995-01-01' + to_days(cast(p.p_size * 15 as integer)) as created_at,
       case when p.p_partkey % 4 = 0 then timestamp '1996-06-01' + to_days(cast(p.p_size * 12 as integer)) end as updated_at,
       case when p.p_partkey % 9 = 0 then timestamp '1997-01-01' + to_days(cast(p.p_size * 7 as integer)) end as deleted_at
from part p left join types t on p.p_type = t.name""", ["types"])

cte("customers", """
select c_custkey as id, c_name as name, cast(c_nationkey as bigint) as address_city_id,
       timestamp '1995-01-01' + to_days(cast(c_custkey % 1000 as integer)) as created_at,
       case when c_custkey % 5 = 0 then timestamp '1997-02-01' + to_days(cast(c_custkey % 300 as integer)) end as updated_at,
       cast(null as timestamp) as deleted_at
from customer""")

cte("cities", """
select cast(n_nationkey as bigint) as id, n_name as name,
       timestamp '1997-01-01' + to_days(cast(n_nationkey * 7 as integer)) as created_at,
       cast(null as timestamp) as updated_at,
       cast(null as timestamp) as deleted_at
from nation""")

cte("currencies", """
select cast(id as bigint) as id, name,
       timestamp '1997-01-01' + to_days(cast(id as integer)) as created_at,
       cast(null as timestamp) as updated_at,
       cast(null as timestamp) as deleted_at
from (values (1, 'USD'), (2, 'EUR'), (3, 'JPY'), (4, 'IDR'), (5, 'KWD'), (6, 'XXX')) v(id, name)""")

cte("rates", """
select code, cast(rate as double) as rate,
       make_timestamp(cast(1772928001 as bigint) * 1000000) as updated_at
from (values ('USD', 1.0), ('EUR', 0.8624), ('JPY', 157.7331), ('IDR', 16937.5056),
             ('KWD', 0.3075), ('BMD', 1.0)) v(code, rate)""")

# The extract of 1997.  Every sale of the window is one row whatever it refers to:
# each name is looked up by its id, and an id without a row gives nulls.
def wide_sales(name: str, first: str, last: str) -> None:
    cte(f"{name}_cars", f"""
select s.*, c.id as found_car, c.name as found_car_name, c.brand_id as car_brand
from (from car_sales where transaction_date between timestamp '{first}' and timestamp '{last}') s
left join cars c on c.id = s.car_id""", ["car_sales", "cars"])
    cte(name, f"""
select x.id as sale_id, x.currency_id, x.transaction_date, x.price as sale_price,
       x.found_car as car_id, x.found_car_name as car_name,
       (select b.id from brands b where b.id = x.car_brand) as brand_id,
       (select b.name from brands b where b.id = x.car_brand) as brand_name,
       (select k.name from currencies k where k.id = x.currency_id) as currency_name
from {name}_cars x""", [f"{name}_cars", "brands", "currencies"])


wide_sales("sales_wide", "1997-01-01", "1997-12-31")

NORMALIZE_SELECT = """
select w.*, r.code, r.rate, r.updated_at,
       {value} as sale_price_normalized,
       'USD' as sale_price_normalized_currency,
       (select max(updated_at) from rates) as exchange_rate_date
from {src} w join rates r on w.currency_name = r.code"""

cte("normalized", NORMALIZE_SELECT.format(
    value="cast(floor(w.sale_price / r.rate) as double)", src="sales_wide"), ["sales_wide", "rates"])

VALID_WHERE = """
where sale_price > 0 and brand_id is not null and car_id is not null
  and currency_id in (1, 2, 3, 4) and sale_price_normalized > 0
  and sale_price_normalized_currency <> ''"""

cte("validated", "select * from normalized" + VALID_WHERE, ["normalized"])

DATASET_COLS = ("sale_id, brand_id, brand_name, car_id, car_name, sale_price, currency_id, "
                "currency_name, sale_price_normalized, sale_price_normalized_currency, "
                "exchange_rate_date, transaction_date")


def with_ctes(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} as ({CTES[n].strip()})" for n in order)
    body = body.strip()
    # A body with views of its own continues the list.
    return f"with {parts},\n{body.removeprefix('with ')}" if body.startswith("with ") else f"with {parts}\n{body}"


# -- per-key SQL ----------------------------------------------------------------

SQL: dict[str, str] = {}


def register(key: str, body: str, *needs: str) -> None:
    SQL[key] = with_ctes(body, *needs)


register("etl_car_sales", f"select {DATASET_COLS} from validated", "validated")
register("sales_wide", "select * from sales_wide", "sales_wide")
register("sales_wide_full", "select * from sales_wide", "sales_wide")
register("normalize_floor", "select * from normalized", "normalized")
register("validate_rules", "select * from validated", "validated")

WINDOW_1997 = "between timestamp '1997-01-01 00:00:00' and timestamp '1997-12-31 00:00:00'"

register("filter_event_window", """
select * from car_sales
where transaction_date >= timestamp '1997-01-01 00:00:00'
  and transaction_date <= timestamp '1997-12-31 00:00:00'""", "car_sales")

register("extract_changed", f"""
select * from car_sales where coalesce(updated_at, created_at) {WINDOW_1997}""", "car_sales")

register("scan_point_lookup", "select id, name from cars where id = 3", "cars")

register("view_roundtrip", """
select sale_id, car_name, sale_price from sales_wide where currency_name = 'EUR'""", "sales_wide")

register("rates_explode", """
select w.sale_id, r.code, r.rate, r.updated_at
from sales_wide w join rates r on w.currency_name = r.code""", "sales_wide", "rates")

register("rates_asof_max", """
select sale_id, (select max(updated_at) from rates) as exchange_rate_date
from sales_wide""", "sales_wide", "rates")

register("base_currency_cross", """
select w.sale_id, w.currency_name, b.code as base_code
from sales_wide w
join (select code from rates where rate = 1 order by code limit 1) b on true""", "sales_wide", "rates")

register("audit_missing_rate", """
select w.currency_name, count(*) as n_sales
from sales_wide w left join rates r on w.currency_name = r.code
where r.rate is null
group by w.currency_name""", "sales_wide", "rates")

register("profile_nulls", """
select count(*) as n_rows,
       count(*) - count(sale_id) as sale_id_nulls,
       count(*) - count(brand_id) as brand_id_nulls,
       count(*) - count(brand_name) as brand_name_nulls,
       count(*) - count(car_id) as car_id_nulls,
       count(*) - count(car_name) as car_name_nulls,
       count(*) - count(sale_price) as sale_price_nulls,
       count(*) - count(currency_id) as currency_id_nulls,
       count(*) - count(currency_name) as currency_name_nulls,
       count(*) - count(transaction_date) as transaction_date_nulls
from sales_wide""", "sales_wide")

RULES = {
    "sale_price_positive": "sale_price > 0",
    "brand_id_present": "brand_id is not null",
    "car_id_present": "car_id is not null",
    "currency_allowed": "currency_id in (1, 2, 3, 4)",
    "normalized_positive": "sale_price_normalized > 0",
    "label_present": "sale_price_normalized_currency <> ''",
}
_ALL = " and ".join(f"coalesce({v}, false)" for v in RULES.values())
register("validate_report", "select count(*) as input_rows, "
         f"count(*) filter (where {_ALL}) as valid_rows, "
         f"count(*) filter (where not ({_ALL})) as rejected_rows, "
         + ", ".join(f"count(*) filter (where not coalesce({v}, false)) as fail_{k}" for k, v in RULES.items())
         + " from normalized", "normalized")

register("window_label", """
select sale_id, strftime(transaction_date, '%Y%m%d') as day_key,
       'car_sales_dataset__19970101-19971231' as file_name
from sales_wide""", "sales_wide")

cte("normalized_exact", NORMALIZE_SELECT.format(value="w.sale_price / r.rate", src="sales_wide"),
    ["sales_wide", "rates"])
register("normalize_exact", "select * from normalized_exact", "normalized_exact")
SQL["rates_document_sales"] = SQL["normalize_exact"]

# Exact decimal quotient rounded half-even to cents, in integer arithmetic.
_DEC = """
select sale_id, sale_price, code, rate,
       cast(cast(q + case when 2 * m > rr or (2 * m = rr and q % 2 = 1) then 1 else 0 end
                 as decimal(18,0)) * 0.01 as decimal(12,2)) as sale_price_normalized
from (select sale_id, sale_price, code, rate, rr, n // rr as q, n % rr as m
      from (select w.sale_id, w.sale_price, r.code, r.rate,
                   cast(round(w.sale_price * 100) as hugeint) * 1000000 as n,
                   cast(round(r.rate * 1000000) as hugeint) as rr
            from sales_wide w join rates r on w.currency_name = r.code))"""
register("normalize_decimal", _DEC, "sales_wide", "rates")

register("json_validate", """
select event_id, json_valid(props_raw) as props_valid,
       case when json_valid(props_raw) then cast(json_extract(props_raw, '$.k') as bigint) end as k
from (select event_id,
             case when event_id % 10 = 0 then substr(props, 1, length(props) - 1) else props end as props_raw
      from events)""")

# The car dimension from each table's own change flag: a car is in the batch when
# it, its brand or its type changed in the window; its change and deletion times
# are those of whichever of car and brand has the later one (creation counts for
# a time that is missing, and the car wins a tie).
def car_dimension(name: str, window: str) -> None:
    for t in ("cars", "brands", "types"):
        cte(f"{name}_{t}", f"""
select *, coalesce(updated_at, created_at) {window} as changed,
       coalesce(updated_at, created_at) as changed_at, coalesce(deleted_at, created_at) as gone_at
from {t}""", [t])
    cte(name, f"""
select * exclude (changed) from (
  select c.id, c.name as car_name, c.created_at, c.changed or b.changed or y.changed as changed,
         b.id as brand_id, b.name as brand_name, y.id as type_id, y.name as type_name,
         if(b.changed_at > c.changed_at, b.updated_at, c.updated_at) as updated_at,
         if(b.gone_at > c.gone_at, b.deleted_at, c.deleted_at) as deleted_at
  from {name}_types y, {name}_brands b, {name}_cars c
  where y.id = c.type_id and b.id = c.brand_id)
where changed""", [f"{name}_{t}" for t in ("cars", "brands", "types")])


car_dimension("dim_car_detail", WINDOW_1997)
register("dim_car_detail", "select * from dim_car_detail", "dim_car_detail")
register("dim_car_detail_semi", "select * from dim_car_detail", "dim_car_detail")

# The fact from the priced sale outward: a sale changed in the window, priced by the
# rate of its currency's code, of a known customer in a known city, then named by
# its car and brand.  The label is the base currency that our rates state (USD); the
# source takes any code whose rate is 1.
def sales_fact(name: str, loaded: str = "") -> None:
    """``loaded``: the suffix of the tables as an incremental load leaves them."""
    t = {x: x + loaded for x in ("car_sales", "cars", "brands", "customers", "cities", "currencies")}
    cte(f"{name}_priced", f"""
select s.id as sale_id, s.car_id, s.customer_id, s.transaction_date, s.price as sale_price,
       s.currency_id, k.name as currency_name, s.price / r.rate as sale_price_normalized,
       r.updated_at as exchange_rate_date
from rates r
join {t["currencies"]} k on k.name = r.code
join {t["car_sales"]} s on s.currency_id = k.id
where coalesce(s.updated_at, s.created_at) {WINDOW_1997}""", ["rates", t["currencies"], t["car_sales"]])
    cte(name, f"""
select p.sale_id, p.sale_price, p.currency_id, p.currency_name, p.sale_price_normalized,
       'USD' as sale_price_normalized_currency, p.exchange_rate_date, p.transaction_date,
       m.car_id, m.car_name, m.brand_id, m.brand_name
from {name}_priced p
join (select c.id as car_id, c.name as car_name, b.id as brand_id, b.name as brand_name
      from {t["cars"]} c join {t["brands"]} b on b.id = c.brand_id) m using (car_id)
where p.customer_id in (select u.id from {t["customers"]} u
                        where u.address_city_id in (select id from {t["cities"]}))""",
        [f"{name}_priced", t["cars"], t["brands"], t["customers"], t["cities"]])


sales_fact("fact_sales")
register("fact_sales", "select * from fact_sales", "fact_sales")


# -- keyed merges: the reference form (one full outer join, presence flag) -----

cte("m_target", """
select o_orderkey,
       case when o_orderkey % 7 <> 0 then o_totalprice end as amount,
       o_orderstatus as status,
       case when o_orderkey % 2 <> 0 then o_orderdate end as first_seen,
       o_orderpriority as priority,
       case when o_orderkey % 2 <> 0 then o_orderpriority end as note
from orders where o_orderdate < timestamp '1998-01-01'""")

cte("m_incoming_all", """
select o_orderkey, o_orderdate,
       case when o_orderkey % 5 <> 0 then o_totalprice * 0.25 end as amount,
       case when o_orderkey % 3 <> 0 then 'U' end as status,
       o_orderdate + interval 30 day as first_seen,
       case when o_orderkey % 3 <> 0 then 'P-' || o_orderstatus end as priority,
       case when o_orderkey % 5 <> 0 then o_orderstatus end as note
from orders""")

cte("m_incoming", """
select * exclude (o_orderdate) from m_incoming_all where o_orderdate >= timestamp '1997-01-01'""", ["m_incoming_all"])

M_COLS = ["o_orderkey", "amount", "status", "first_seen", "priority", "note"]

POLICY_SQL = {
    "REPLACE": "s.{c}",
    "CUMULATIVE": "s.{c} + t.{c}",
    "PROGRESS": "case when t.{c} is null then s.{c} else t.{c} end",
    "SKIP_IF_NULL": "case when s.{c} is not null then s.{c} else t.{c} end",
    "CONCAT": ("case when t.{c} is null then s.{c} when s.{c} is not null "
               "then t.{c} || ', ' || s.{c} else t.{c} end"),
}


def merge_sql(target: str, incoming: str, keys: list[str], t_cols: list[str], s_cols: list[str],
              policies: dict[str, str] | None = None, synced: str | None = None) -> str:
    policies = policies or {}
    hit = f"s.__in"
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    out = []
    for c in t_cols + [c for c in s_cols if c not in t_cols]:
        if c in keys:
            out.append(f"case when {hit} then s.{c} else t.{c} end as {c}")
        elif c in s_cols and c in t_cols:
            upd = POLICY_SQL[policies.get(c, "REPLACE")].format(c=c)
            out.append(f"case when {hit} is null then t.{c} when t.__t is null then s.{c} else {upd} end as {c}")
        elif c in s_cols:
            out.append(f"case when {hit} then s.{c} end as {c}")
        else:
            out.append(f"t.{c} as {c}")
    if synced:
        out.append(f"case when {hit} then {synced} end as synced_at")
    return (f"select {', '.join(out)} from (select *, true as __t from {target}) t "
            f"full outer join (select {', '.join(s_cols)}, true as __in from {incoming}) s on {on}")


RUN_TS = "timestamp '2026-01-01 00:00:00'"

register("merge_replace", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS),
         "m_target", "m_incoming")
register("merge_cumulative", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS,
                                       {"amount": "CUMULATIVE"}), "m_target", "m_incoming")
register("merge_progress", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS,
                                     {"first_seen": "PROGRESS"}), "m_target", "m_incoming")
register("merge_skip_if_null", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS,
                                         {"priority": "SKIP_IF_NULL", "status": "SKIP_IF_NULL"}),
         "m_target", "m_incoming")
register("merge_concat", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS,
                                   {"note": "CONCAT"}), "m_target", "m_incoming")
register("merge_partial_columns", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS,
                                            ["o_orderkey", "status", "amount"], {"amount": "CUMULATIVE"}),
         "m_target", "m_incoming")
register("merge_no_key_append", """
select o_orderkey, amount, status, first_seen, priority, note from m_target
union all
select o_orderkey, null, status, null, null, null from m_incoming""", "m_target", "m_incoming")
register("merge_synced_at", merge_sql("m_target", "m_incoming", ["o_orderkey"], M_COLS, M_COLS,
                                      synced=RUN_TS), "m_target", "m_incoming")
register("merge_initial_load", f"select * exclude (o_orderdate), {RUN_TS} as synced_at from m_incoming_all", "m_incoming_all")

register("update_only", f"""
select t.o_orderkey,
       case when s.o_orderkey is null then t.amount else s.amount + t.amount end as amount,
       t.status,
       case when s.o_orderkey is null then t.first_seen
            when t.first_seen is null then s.first_seen else t.first_seen end as first_seen,
       t.priority,
       case when s.o_orderkey is null then t.note else s.note end as note,
       case when s.o_orderkey is not null then {RUN_TS} end as synced_at
from m_target t left join m_incoming s on t.o_orderkey = s.o_orderkey""", "m_target", "m_incoming")

# Batches that repeat keys: the value that applying the rows one by one leaves.
_BATCH_COLS = ["seq", "amount", "status", "first_seen", "priority", "note"]
_ORDER = "order by " + ", ".join(f"{c} nulls first" for c in _BATCH_COLS)
_FOLD = {
    "REPLACE": "last({c} {o})",
    "CUMULATIVE": "case when count({c}) = count(*) then sum({c}) end",
    "PROGRESS": "first({c} {o}) filter (where {c} is not null)",
    "SKIP_IF_NULL": "last({c} {o}) filter (where {c} is not null)",
    "CONCAT": "string_agg({c}, ', ' {o}) filter (where {c} is not null)",
}
cte("line_batch", """
select l_orderkey as o_orderkey, cast(l_linenumber as bigint) as seq,
       case when l_partkey % 40 <> 0 then l_quantity end as amount,
       case when l_suppkey % 3 <> 0 then l_linestatus end as status,
       case when l_partkey % 2 <> 0 then l_shipdate end as first_seen,
       case when l_suppkey % 4 <> 0 then 'L-' || l_returnflag end as priority,
       case when l_partkey % 3 <> 0 then l_returnflag end as note
from lineitem""")


def folded(name: str, policies: dict[str, str]) -> str:
    cte(f"batch_{name}", "select o_orderkey, " + ", ".join(
        _FOLD[policies.get(c, "REPLACE")].format(c=c, o=_ORDER) + f" as {c}" for c in _BATCH_COLS)
        + " from line_batch group by o_orderkey", ["line_batch"])
    return f"batch_{name}"


for _name, _policies in {
        "cumulative": {"amount": "CUMULATIVE"}, "progress": {"first_seen": "PROGRESS"},
        "skip_if_null": {"priority": "SKIP_IF_NULL", "status": "SKIP_IF_NULL"}, "concat": {"note": "CONCAT"}}.items():
    register(f"merge_{_name}_batch", merge_sql("m_target", folded(_name, _policies), ["o_orderkey"], M_COLS,
                                               ["o_orderkey", *_BATCH_COLS], _policies),
             "m_target", f"batch_{_name}")
folded("update", {"amount": "CUMULATIVE", "first_seen": "PROGRESS"})
register("update_only_batch", f"""
select t.o_orderkey,
       case when s.o_orderkey is null then t.amount else s.amount + t.amount end as amount,
       case when s.o_orderkey is null then t.status else s.status end as status,
       case when s.o_orderkey is null then t.first_seen else coalesce(t.first_seen, s.first_seen) end as first_seen,
       case when s.o_orderkey is null then t.priority else s.priority end as priority,
       case when s.o_orderkey is null then t.note else s.note end as note,
       case when s.o_orderkey is not null then {RUN_TS} end as synced_at
from m_target t left join batch_update s on t.o_orderkey = s.o_orderkey""", "m_target", "batch_update")

register("append_strict_conflicts", """
select s.o_orderkey, count(*) as n, 'exists' as reason
from m_incoming s where exists (select 1 from m_target t where t.o_orderkey = s.o_orderkey)
group by s.o_orderkey
union all
select o_orderkey, count(*) as n, 'repeated' as reason
from m_incoming group by o_orderkey having count(*) > 1""", "m_target", "m_incoming")

cte("line_last", """
select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                                        l_extendedprice desc) as rn
  from lineitem) where rn = 1""")
register("dedupe_last_write", "select * from line_last", "line_last")

cte("line_target", """
select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                                        l_extendedprice desc) as rn
  from lineitem where l_shipdate < timestamp '1998-01-01') where rn = 1""")
cte("line_incoming", """
select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc,
                                        l_extendedprice desc) as rn
  from lineitem where l_shipdate >= timestamp '1997-01-01') where rn = 1""")
register("upsert_composite_key", """
select * from line_target t
where not exists (select 1 from line_incoming s
                  where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
union all select * from line_incoming""", "line_target", "line_incoming")

register("snapshot_upsert_types", """
select t.l_orderkey, cast(t.l_linenumber as bigint) as l_linenumber, t.l_partkey, t.l_suppkey,
       case when s.l_orderkey is null then t.l_quantity else s.l_quantity end as l_quantity,
       t.l_extendedprice, t.l_discount, t.l_tax, t.l_returnflag, t.l_linestatus,
       coalesce(s.l_shipdate, t.l_shipdate) as l_shipdate
from line_last t
left join (select l_orderkey, l_linenumber, max(l_shipdate) as l_shipdate,
                  arg_max(l_quantity + 1, (l_shipdate, l_quantity)) as l_quantity
           from lineitem where l_shipdate >= timestamp '1997-01-01' group by all) s
  on s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber""", "line_last")

register("delete_by_key", """
select * from car_sales
where id not in (select l_orderkey from lineitem where l_returnflag = 'R')""", "car_sales")

register("delete_cascade", """
select id, name, brand_id, type_id from cars
where brand_id not in (select id from brands where deleted_at is not null)""", "cars", "brands")

wide_sales("sales_wide_prev", "1996-07-01", "1997-06-30")
cte("normalized_prev", NORMALIZE_SELECT.format(value="w.sale_price / r.rate", src="sales_wide_prev"),
    ["sales_wide_prev", "rates"])
cte("validated_prev", "select * from normalized_prev" + VALID_WHERE, ["normalized_prev"])
register("etl_upsert_wide", f"""
select {DATASET_COLS} from validated_prev t
where not exists (select 1 from validated s where s.sale_id = t.sale_id)
union all select {DATASET_COLS} from validated""", "validated_prev", "validated")

register("load_table_upsert", f"""
select * from (select * replace (cast(null as timestamp) as updated_at) from car_sales
               where created_at < timestamp '1997-01-01') t
where not exists (select 1 from car_sales s
                  where s.id = t.id and coalesce(s.updated_at, s.created_at) {WINDOW_1997})
union all
select * from car_sales where coalesce(updated_at, created_at) {WINDOW_1997}""", "car_sales")

register("load_table_empty", "select * from car_sales", "car_sales")

car_dimension("dim_car_detail_1996", "between timestamp '1996-01-01' and timestamp '1996-12-31'")
register("dim_car_detail_upsert", """
select * from dim_car_detail_1996 t
where not exists (select 1 from dim_car_detail s where s.id = t.id)
union all select * from dim_car_detail""", "dim_car_detail_1996", "dim_car_detail")


# -- quality reports ---------------------------------------------------------------

_DATASET_RULES = [(c, f"{c} is not null") for c in DATASET_COLS.replace(" ", "").split(",")]
_DATASET_RULES = [(f"{c}_not_null", cond) for c, cond in _DATASET_RULES] + [
    ("sale_price_positive", "sale_price > 0"),
    ("sale_price_normalized_positive", "sale_price_normalized > 0")]
register("constraint_violations", " union all ".join(
    f"select sale_id, '{name}' as constraint_name from normalized where not coalesce({cond}, false)"
    for name, cond in _DATASET_RULES), "normalized")

register("source_constraint_violations", """
select id, 'price_non_negative' as constraint_name, 'cars' as table_name from cars where id % 17 = 0 and price > 0
union all
select id, 'stock_non_negative', 'cars' from cars where id % 19 = 0 and stock >= 0
union all
select id, 'price_non_negative', 'car_sales' from car_sales where id % 17 = 0 and price > 0
""", "cars", "car_sales")

_UNIQUE = [(t, k) for t in ("brands", "types", "customers", "cities", "currencies") for k in ("id", "name")] + [
    ("car_sales", "id"), ("cars", "id")]
register("unique_violations", " union all ".join(
    [f"select '{t}' as table_name, '{k}' as key_columns, cast({k} as varchar) as key_value, "
     f"count(*) as n_rows from {t} group by {k} having count(*) > 1" for t, k in _UNIQUE]
    + ["select 'lineitem' as table_name, 'l_orderkey,l_linenumber' as key_columns, "
       "concat_ws('|', cast(l_orderkey as varchar), cast(l_linenumber as varchar)) as key_value, "
       "count(*) as n_rows from lineitem group by l_orderkey, l_linenumber having count(*) > 1"]),
    "brands", "types", "customers", "cities", "currencies", "car_sales", "cars")

_LOADED = ["brands", "types", "currencies", "cities", "cars", "customers", "car_sales"]
for _t in _LOADED:
    cte(f"{_t}_w", f"select * from {_t} where coalesce(updated_at, created_at) {WINDOW_1997}", [_t])

_FKS = [("cars", "brand_id", "brands"), ("cars", "type_id", "types"), ("cars", "currency_id", "currencies"),
        ("customers", "address_city_id", "cities"), ("car_sales", "car_id", "cars"),
        ("car_sales", "customer_id", "customers"), ("car_sales", "currency_id", "currencies")]
register("fk_violations", " union all ".join(
    f"select '{c}' as child_table, '{fk}' as fk_column, '{p}' as parent_table, "
    f"cast({fk} as bigint) as fk_value, count(*) as n_rows from {c}_w x "
    f"where {fk} is not null and not exists (select 1 from {p}_w y where y.id = x.{fk}) group by {fk}"
    for c, fk, p in _FKS), *[f"{t}_w" for t in _LOADED])

register("apply_defaults", """
select id,
       coalesce(case when id % 11 <> 0 then stock end, 0) as stock,
       coalesce(case when id % 13 <> 0 then created_at end, timestamp '2026-01-01 00:00:00') as created_at
from cars""", "cars")

# -- whole flows ----------------------------------------------------------------------

register("parquet_roundtrip", "select * from validated", "validated")
SQL["etl_run_table"] = SQL["etl_upsert_wide"]
register("elt_fact_full", "select * from fact_sales", "fact_sales")
register("elt_dim_full", "select * from dim_car_detail", "dim_car_detail")

sales_fact("fact_loaded", "_w")
register("elt_fact_incremental", "select * from fact_loaded", "fact_loaded")

register("reconcile_etl_elt", """
select coalesce(a.sale_id, b.sale_id) as sale_id,
       case when a.sale_id is not null and b.sale_id is not null then 'both'
            when a.sale_id is not null then 'etl_only' else 'elt_only' end as status,
       a.sale_price_normalized as etl_normalized,
       b.sale_price_normalized as elt_normalized,
       b.sale_price_normalized - a.sale_price_normalized as normalized_diff
from validated a full outer join fact_sales b on a.sale_id = b.sale_id""", "validated", "fact_sales")

register("stream_upsert_latest", """
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) where rn = 1""")


for _key, (_body, _needs) in catalog_derived.SQL.items():
    register(_key, _body, *_needs)
