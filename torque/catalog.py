"""Registry of the checked queries: key -> callable(spark, sf_dir) -> DataFrame.

Each key exercises one operator (or a whole job) of the sales model over the
driver's test tables; ``oracles.SQL`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog_derived
from .fixtures import (BATCH_ORDER, RATE_BASE_CODE, RATE_UNIX_TIME, RATES, LINE_KEYS, LINE_ORDER, MERGE_KEY, MERGE_RUN_TS, line_batch, merge_incoming,
                       merge_target, negative_prices, returned_order_keys, source, ts)
from .functions.jsonfn import damage_rule, json_check
from .functions.normalize import latest_rate_time, normalize_currency
from .functions.windows import Window as TimeWindow
from .functions.windows import changed_in, day_key, event_window, parquet_name, year_window
from .operators import merge as M
from .operators import quality as Q
from .operators import star
from .operators.rates import missing_rates
from .plans.elt import LOAD_ORDER, destination, extract_changed, run_elt
from .plans.etl import etl_dataset, etl_frames, run_etl
from .plans.reconcile import reconcile
from .session import scratch_path
from .sources.rates import rates_document, read_rates_document
from .sources.snapshots import SnapshotTable
from .sources.tables import lookup, sql_over_view
from .streaming.upsert import stream_latest_per_key

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# The window every check runs on: calendar 1997, both ends 00:00 (closed).
WINDOW = year_window(1997)


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


@query("etl_car_sales")
def etl_car_sales(spark: SparkSession, sf: str) -> DataFrame:
    src = source(spark, sf)
    return etl_dataset(src.tables(), src.rates_snapshot, WINDOW)


@query("sales_wide")
def q_sales_wide(spark, sf):
    src = source(spark, sf)
    return etl_frames(src.tables(), src.rates_snapshot, WINDOW).wide


@query("sales_wide_full")
def q_sales_wide_full(spark, sf):
    """The extract with all five dimension joins."""
    return star.sales_wide(source(spark, sf).tables(), WINDOW, keep_existence_joins=True)


@query("normalize_floor")
def q_normalize_floor(spark, sf):
    src = source(spark, sf)
    return etl_frames(src.tables(), src.rates_snapshot, WINDOW).normalized


@query("validate_rules")
def q_validate_rules(spark, sf):
    src = source(spark, sf)
    return etl_frames(src.tables(), src.rates_snapshot, WINDOW, rules=Q.etl_rules()).validated


# -- sources, filters, scalar expressions -------------------------------------


def _wide(spark, sf):
    src = source(spark, sf)
    return src, star.sales_wide(src.tables(), WINDOW)


@query("filter_event_window")
def q_filter_event_window(spark, sf):
    return source(spark, sf).car_sales.filter(event_window(WINDOW, "transaction_date"))


@query("extract_changed")
def q_extract_changed(spark, sf):
    return source(spark, sf).car_sales.filter(changed_in(WINDOW))


@query("scan_point_lookup")
def q_scan_point_lookup(spark, sf):
    return lookup(spark, source(spark, sf).cars, "id", 3, ["id", "name"])


@query("view_roundtrip")
def q_view_roundtrip(spark, sf):
    _, wide = _wide(spark, sf)
    return sql_over_view(spark, wide, "sales_data_df",
                         "select sale_id, car_name, sale_price from {view} where currency_name = ?", ["EUR"])


@query("rates_explode")
def q_rates_explode(spark, sf):
    src, wide = _wide(spark, sf)
    r = src.rates_snapshot.broadcastable()
    return wide.join(r, wide.currency_name == r.code, "inner").select("sale_id", "code", "rate", "updated_at")


@query("rates_document_sales")
def q_rates_document_sales(spark, sf):
    """Sales converted with rates read back from a landed JSON document."""
    src, wide = _wide(spark, sf)
    landed = scratch_path(spark, "rates")
    rates_document(spark, RATE_BASE_CODE, RATE_UNIX_TIME, RATES).coalesce(1).write.json(landed)
    return normalize_currency(wide, read_rates_document(spark, landed), mode="exact")


@query("rates_asof_max")
def q_rates_asof_max(spark, sf):
    src, wide = _wide(spark, sf)
    return wide.select("sale_id", latest_rate_time(src.rates).alias("exchange_rate_date"))


@query("base_currency_cross")
def q_base_currency_cross(spark, sf):
    src, wide = _wide(spark, sf)
    base = star.base_code_scalar(star.base_currency_ordered(src.rates))
    return (wide.withColumn("base_code", base).filter(F.col("base_code").isNotNull())
            .select("sale_id", "currency_name", "base_code"))


@query("audit_missing_rate")
def q_audit_missing_rate(spark, sf):
    src, wide = _wide(spark, sf)
    return missing_rates(wide, src.rates)


@query("profile_nulls")
def q_profile_nulls(spark, sf):
    _, wide = _wide(spark, sf)
    return Q.null_profile(wide)


@query("validate_report")
def q_validate_report(spark, sf):
    src = source(spark, sf)
    return Q.rule_report(etl_frames(src.tables(), src.rates_snapshot, WINDOW).normalized, Q.etl_rules())


@query("window_label")
def q_window_label(spark, sf):
    _, wide = _wide(spark, sf)
    return wide.select("sale_id", day_key("transaction_date").alias("day_key"),
                       F.lit(parquet_name("car_sales_dataset", WINDOW)).alias("file_name"))


@query("normalize_exact")
def q_normalize_exact(spark, sf):
    src, wide = _wide(spark, sf)
    return normalize_currency(wide, src.rates_snapshot, mode="exact")


@query("normalize_decimal")
def q_normalize_decimal(spark, sf):
    src, wide = _wide(spark, sf)
    return (normalize_currency(wide, src.rates_snapshot, mode="decimal")
            .select("sale_id", "sale_price", "code", "rate", "sale_price_normalized"))


@query("json_validate")
def q_json_validate(spark, sf):
    ev = source(spark, sf).table("events")
    damaged = ev.select("event_id", damage_rule(F.col("event_id"), F.col("props")).alias("props_raw"))
    return json_check(damaged, "props_raw", {"k": "bigint"}).select("event_id", "props_valid", "k")


# -- car dimension and sales fact --------------------------------------------

@query("dim_car_detail")
def q_dim_car_detail(spark, sf):
    return star.dim_car_detail(source(spark, sf).tables(), WINDOW)


@query("dim_car_detail_semi")
def q_dim_car_detail_semi(spark, sf):
    return star.dim_car_detail_semi(source(spark, sf).tables(), WINDOW)


@query("fact_sales")
def q_fact_sales(spark, sf):
    src = source(spark, sf)
    return star.fact_sales(src.tables(), src.rates_snapshot, WINDOW)


# -- keyed merges -----------------------------------------------------------------


def _merge_inputs(spark, sf):
    src = source(spark, sf)
    return merge_target(src), merge_incoming(src)


@query("merge_replace")
def q_merge_replace(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY])


@query("merge_cumulative")
def q_merge_cumulative(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY], {"amount": M.CUMULATIVE})


@query("merge_progress")
def q_merge_progress(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY], {"first_seen": M.PROGRESS})


@query("merge_skip_if_null")
def q_merge_skip_if_null(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY], {"priority": M.SKIP_IF_NULL, "status": M.SKIP_IF_NULL})


@query("merge_concat")
def q_merge_concat(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY], {"note": M.CONCAT})


@query("merge_partial_columns")
def q_merge_partial_columns(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s.select(MERGE_KEY, "status", "amount"), [MERGE_KEY], {"amount": M.CUMULATIVE})


@query("merge_no_key_append")
def q_merge_no_key_append(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s.select(MERGE_KEY, "status"), [])


@query("merge_synced_at")
def q_merge_synced_at(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.merge(t, s, [MERGE_KEY], synced_at=ts(MERGE_RUN_TS))


@query("merge_initial_load")
def q_merge_initial_load(spark, sf):
    s = merge_incoming(source(spark, sf), first=None)
    return M.merge(None, s, [MERGE_KEY], synced_at=ts(MERGE_RUN_TS))


@query("update_only")
def q_update_only(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.update_only(t, s.select(MERGE_KEY, "amount", "note", "first_seen"), [MERGE_KEY],
                         {"amount": M.CUMULATIVE, "note": M.CONCAT, "first_seen": M.PROGRESS},
                         synced_at=ts(MERGE_RUN_TS))


# Batches that repeat keys: the rows of a key apply one after another.


def _batch_merge(spark, sf, policies):
    src = source(spark, sf)
    return M.merge(merge_target(src), line_batch(src), [MERGE_KEY], policies, dedupe_order=BATCH_ORDER)


@query("merge_cumulative_batch")
def q_merge_cumulative_batch(spark, sf):
    return _batch_merge(spark, sf, {"amount": M.CUMULATIVE})


@query("merge_progress_batch")
def q_merge_progress_batch(spark, sf):
    return _batch_merge(spark, sf, {"first_seen": M.PROGRESS})


@query("merge_skip_if_null_batch")
def q_merge_skip_if_null_batch(spark, sf):
    return _batch_merge(spark, sf, {"priority": M.SKIP_IF_NULL, "status": M.SKIP_IF_NULL})


@query("merge_concat_batch")
def q_merge_concat_batch(spark, sf):
    return _batch_merge(spark, sf, {"note": M.CONCAT})


@query("update_only_batch")
def q_update_only_batch(spark, sf):
    src = source(spark, sf)
    return M.update_only(merge_target(src), line_batch(src), [MERGE_KEY],
                         {"amount": M.CUMULATIVE, "note": M.CONCAT, "first_seen": M.PROGRESS},
                         synced_at=ts(MERGE_RUN_TS), dedupe_order=BATCH_ORDER)


@query("snapshot_upsert_types")
def q_snapshot_upsert_types(spark, sf):
    """A stored table with bigint keys takes a batch with int keys; opened with another
    bucket count it refuses."""
    line = source(spark, sf).table("lineitem")
    root = scratch_path(spark, "typed")
    rows = M.dedupe_last(line.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint")), LINE_KEYS, LINE_ORDER)
    SnapshotTable(spark, root, LINE_KEYS, 8).write(rows)
    batch = (line.filter(F.col("l_shipdate") >= ts("1997-01-01"))
             .select(F.col("l_orderkey").cast("int").alias("l_orderkey"), "l_linenumber", "l_shipdate",
                     (F.col("l_quantity") + 1).alias("l_quantity")))
    SnapshotTable(spark, root).merge(batch, dedupe_order=["l_shipdate", "l_quantity"])
    try:
        SnapshotTable(spark, root, LINE_KEYS, 4)
    except ValueError:
        return SnapshotTable(spark, root).read()
    raise AssertionError("another bucket count must be refused")


@query("append_strict_conflicts")
def q_append_strict_conflicts(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return M.strict_conflicts(t, s, [MERGE_KEY])


@query("dedupe_last_write")
def q_dedupe_last_write(spark, sf):
    return M.dedupe_last(source(spark, sf).table("lineitem"), LINE_KEYS,
                         [F.col(c) for c in LINE_ORDER])


@query("upsert_composite_key")
def q_upsert_composite_key(spark, sf):
    li = source(spark, sf).table("lineitem")
    t = M.dedupe_last(li.filter(F.col("l_shipdate") < ts("1998-01-01")), LINE_KEYS, LINE_ORDER)
    s = li.filter(F.col("l_shipdate") >= ts("1997-01-01"))
    return M.merge(t, s, LINE_KEYS, dedupe_order=LINE_ORDER)


@query("delete_by_key")
def q_delete_by_key(spark, sf):
    src = source(spark, sf)
    return M.delete_by_key(src.car_sales, returned_order_keys(src), ["id"])


@query("delete_cascade")
def q_delete_cascade(spark, sf):
    src = source(spark, sf)
    gone = src.brands.filter(F.col("deleted_at").isNotNull()).select("id")
    _, cars = M.delete_cascade(src.brands, src.cars, gone, "id", "brand_id")
    return cars.select("id", "name", "brand_id", "type_id")


PREV_WINDOW = TimeWindow(datetime(1996, 7, 1), datetime(1997, 6, 30))


@query("etl_upsert_wide")
def q_etl_upsert_wide(spark, sf):
    src = source(spark, sf)
    t = etl_dataset(src.tables(), src.rates_snapshot, PREV_WINDOW, mode="exact")
    s = etl_dataset(src.tables(), src.rates_snapshot, WINDOW)
    return M.merge(t, s, ["sale_id"])


@query("load_table_upsert")
def q_load_table_upsert(spark, sf):
    src = source(spark, sf)
    cs = src.car_sales
    t = cs.filter(F.col("created_at") < ts("1997-01-01")).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    return M.load_table(t, cs.filter(changed_in(WINDOW)), ["id"])


@query("load_table_empty")
def q_load_table_empty(spark, sf):
    src = source(spark, sf)
    cs = src.car_sales
    return M.load_table(cs, cs.filter(changed_in(year_window(2030))), ["id"])


@query("dim_car_detail_upsert")
def q_dim_car_detail_upsert(spark, sf):
    tables = source(spark, sf).tables()
    return M.merge(star.dim_car_detail(tables, year_window(1996)),
                   star.dim_car_detail_semi(tables, WINDOW), ["id"])


# -- quality reports ----------------------------------------------------------------


@query("constraint_violations")
def q_constraint_violations(spark, sf):
    src = source(spark, sf)
    normalized = etl_frames(src.tables(), src.rates_snapshot, WINDOW).normalized
    return Q.violations(star.to_dataset(normalized), Q.dataset_constraints(), ["sale_id"])


@query("source_constraint_violations")
def q_source_constraint_violations(spark, sf):
    """Rows of the sources that their CHECK constraints refuse."""
    tables = source(spark, sf).tables()
    return reduce(DataFrame.unionByName, [
        Q.violations(negative_prices(tables[t]), rules, ["id"]).withColumn("table_name", F.lit(t))
        for t, rules in Q.source_constraints().items()])


# Every id and name that the DDL declares unique; the join rewrites rely on the ids.
UNIQUE_CHECKS = [(t, [k]) for t in ("brands", "types", "customers", "cities", "currencies") for k in ("id", "name")] + [
    ("car_sales", ["id"]), ("cars", ["id"])]


@query("unique_violations")
def q_unique_violations(spark, sf):
    src = source(spark, sf)
    tables = src.tables()
    reports = [Q.unique_violations(tables[t], keys, t) for t, keys in UNIQUE_CHECKS]
    reports.append(Q.unique_violations(src.table("lineitem"), LINE_KEYS, "lineitem"))
    return reduce(DataFrame.unionByName, reports)


# (child table, foreign key, parent table, parent key), as declared in the DDL.
FOREIGN_KEYS = [("cars", "brand_id", "brands", "id"), ("cars", "type_id", "types", "id"),
                ("cars", "currency_id", "currencies", "id"),
                ("customers", "address_city_id", "cities", "id"),
                ("car_sales", "car_id", "cars", "id"), ("car_sales", "customer_id", "customers", "id"),
                ("car_sales", "currency_id", "currencies", "id")]


@query("fk_violations")
def q_fk_violations(spark, sf):
    """Foreign keys left dangling by an incremental load of the 1997 changes
    (the rows the ELT fact silently drops)."""
    src = source(spark, sf).tables()
    dest = {t: extract_changed(src[t], WINDOW) for t in LOAD_ORDER}
    return reduce(DataFrame.unionByName, [
        Q.fk_violations(dest[c], fk, dest[p], pk, c, p) for c, fk, p, pk in FOREIGN_KEYS])


@query("apply_defaults")
def q_apply_defaults(spark, sf):
    cars = source(spark, sf).cars
    gappy = cars.select(
        "id",
        F.when(F.col("id") % 11 != 0, F.col("stock")).alias("stock"),
        F.when(F.col("id") % 13 != 0, F.col("created_at")).alias("created_at"))
    return Q.apply_defaults(gappy, {"stock": F.lit(0), "created_at": ts(MERGE_RUN_TS)})


# -- whole flows (these write snapshot tables under the work folder) -------------

@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf):
    src = source(spark, sf)
    out = run_etl(spark, src.tables(), src.rates_snapshot, WINDOW, scratch_path(spark, "etl"))
    return spark.read.parquet(out["parquet"])


@query("etl_run_table")
def q_etl_run_table(spark, sf):
    src = source(spark, sf)
    root = scratch_path(spark, "etl")
    run_etl(spark, src.tables(), src.rates_snapshot, PREV_WINDOW, root, mode="exact")
    run_etl(spark, src.tables(), src.rates_snapshot, WINDOW, root)
    return SnapshotTable(spark, f"{root}/car_sales_dataset", ["sale_id"]).read()


_ELT_RUNS: "weakref.WeakKeyDictionary[SparkSession, dict[tuple, str]]" = weakref.WeakKeyDictionary()


def _elt(spark, sf, full_load: bool):
    """One ELT run per (session, data, mode): its written destination serves
    every key that reads it."""
    runs = _ELT_RUNS.setdefault(spark, {})
    key = (sf.rstrip("/"), full_load)
    if key not in runs:
        src = source(spark, sf)
        root = scratch_path(spark, "elt")
        run_elt(spark, src.tables(), src.rates_snapshot, WINDOW, root, full_load=full_load)
        runs[key] = root
    return destination(spark, runs[key])


@query("elt_fact_full")
def q_elt_fact_full(spark, sf):
    return _elt(spark, sf, True)["fact_car_sales_dataset"]


@query("elt_dim_full")
def q_elt_dim_full(spark, sf):
    return _elt(spark, sf, True)["dimension_car_detail"]


@query("elt_fact_incremental")
def q_elt_fact_incremental(spark, sf):
    return _elt(spark, sf, False)["fact_car_sales_dataset"]


@query("reconcile_etl_elt")
def q_reconcile_etl_elt(spark, sf):
    src = source(spark, sf)
    etl = etl_dataset(src.tables(), src.rates_snapshot, WINDOW)
    elt = star.fact_sales(src.tables(), src.rates_snapshot, WINDOW)
    return reconcile(etl, elt)


# -- streaming ---------------------------------------------------------------------------


@query("stream_upsert_latest")
def q_stream_upsert_latest(spark, sf):
    events = source(spark, sf).table("events")
    return stream_latest_per_key(spark, events, scratch_path(spark, "stream"), ["user_id"], ["ts", "event_id"])


QUERIES.update(catalog_derived.QUERIES)
