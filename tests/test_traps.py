"""The semantic traps of the sales flows, on literal rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from torque.functions.normalize import convert, normalize_currency
from torque.functions.windows import changed_in, changed_in_coalesce, event_window, year_window
from torque.operators import merge as M
from torque.operators import quality as Q
from torque.operators import star
from torque.sources.rates import rates_from_mapping, read_rates_document
from torque.sources.tables import constant_row, to_arrow_edge


def ts(s):
    return datetime.fromisoformat(s)


def test_window_end_is_day_start_unless_exclusive(spark):
    df = spark.createDataFrame([(1, ts("1997-12-31 00:00:00")), (2, ts("1997-12-31 10:00:00")),
                                (3, ts("1997-01-01 00:00:00")), (4, None)], "id int, t timestamp_ntz")
    closed = {r.id for r in df.filter(event_window(year_window(1997), "t")).collect()}
    half_open = {r.id for r in df.filter(event_window(year_window(1997, end_exclusive=True), "t")).collect()}
    assert closed == {1, 3}          # a sale later on 31 December falls out; null drops
    assert half_open == {1, 2, 3}


def test_change_window_rewrite_equals_coalesce(spark):
    df = spark.createDataFrame([
        (1, ts("1996-05-01"), ts("1997-03-01")), (2, ts("1997-05-01"), None),
        (3, ts("1997-05-01"), ts("1998-02-01")), (4, ts("1995-01-01"), None)],
        "id int, created_at timestamp_ntz, updated_at timestamp_ntz")
    w = year_window(1997)
    a = {r.id for r in df.filter(changed_in(w)).collect()}
    b = {r.id for r in df.filter(changed_in_coalesce(w)).collect()}
    assert a == b == {1, 2}


def test_floor_then_validate_drops_sub_unit_sales(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0), (2, 157.0, 157.7331), (3, 200.0, 0.8624)],
                               "id int, price double, rate double")
    out = {r.id: (r.f, r.e) for r in df.select(
        "id", convert(F.col("price"), F.col("rate"), "floor").alias("f"),
        convert(F.col("price"), F.col("rate"), "exact").alias("e")).collect()}
    assert out[1][0] == 0.0 and out[1][1] == 0.5
    assert out[2][0] == 0.0
    assert out[3][0] == 231.0


def test_integral_rates_divide_as_double(spark):
    df = spark.createDataFrame([(7, 2)], "price bigint, rate bigint")
    assert df.select(convert(F.col("price"), F.col("rate"), "exact").alias("x")).first().x == 3.5


def test_zero_rate_is_null_not_an_error(spark):
    df = spark.createDataFrame([(10.0, 0.0)], "price double, rate double")
    r = df.select(*[convert(F.col("price"), F.col("rate"), m).alias(m) for m in ("floor", "exact", "decimal")]).first()
    assert r.floor is None and r.exact is None and r.decimal is None


def test_decimal_mode_rounds_half_even(spark):
    # quotients 2.345, 2.355, 0.333..: the tie goes to the even cent
    df = spark.createDataFrame([(4.69, 2.0), (4.71, 2.0), (1.0, 3.0)], "price double, rate double")
    got = [r.d for r in df.select(convert(F.col("price"), F.col("rate"), "decimal").alias("d")).collect()]
    assert [str(x) for x in got] == ["2.34", "2.36", "0.33"]


def test_nan_passes_greater_than_zero_but_not_finite_rules(spark):
    df = spark.createDataFrame([(float("nan"),)], "sale_price double")
    assert df.filter(F.col("sale_price") > 0).count() == 1
    assert df.filter(~F.isnan("sale_price")).count() == 0


def _rates(spark, rates, base="USD"):
    return rates_from_mapping(spark, base, 1772928001, rates)


def test_base_currency_is_ambiguous_by_rate(spark):
    r = _rates(spark, {"USD": 1.0, "BMD": 1.0, "EUR": 0.86})
    assert star.base_currency_ordered(r.table).first().base_code == "BMD"
    assert star.base_currency_row(r).first().base_code == "USD"


def test_label_must_match_rates_base(spark):
    sales = spark.createDataFrame([(1, 10.0, "EUR")], "sale_id int, sale_price double, currency_name string")
    with pytest.raises(ValueError):
        normalize_currency(sales, _rates(spark, {"USD": 1.0, "EUR": 0.8}), target_code="EUR")


def test_unknown_code_drops_in_normalize(spark):
    sales = spark.createDataFrame([(1, 10.0, "EUR"), (2, 10.0, "XXX")],
                                  "sale_id int, sale_price double, currency_name string")
    out = normalize_currency(sales, _rates(spark, {"USD": 1.0, "EUR": 0.5}))
    assert [r.sale_id for r in out.collect()] == [1]
    assert out.first().sale_price_normalized == 20.0
    assert out.first().exchange_rate_date == datetime(2026, 3, 8, 0, 0, 1)


def test_rates_document_from_json_file(spark, tmp_path):
    doc = {"result": "success", "time_last_update_unix": 1772928001, "base_code": "USD",
           "conversion_rates": {"USD": 1, "EUR": 0.8624, "BBD": 2.0000}}
    p = tmp_path / "rates.json"
    p.write_text(json.dumps(doc, indent=1))
    snap = read_rates_document(spark, str(p))
    assert snap.base_code == "USD"
    got = {r.code: (r.rate, r.updated_at) for r in snap.table.collect()}
    assert got["USD"][0] == 1.0 and got["BBD"][0] == 2.0
    assert got["EUR"][1] == datetime(2026, 3, 8, 0, 0, 1)


def test_dimension_dates_keep_raw_null(spark):
    t = {
        "cars": spark.createDataFrame(
            [(1, "c", 1, 1, ts("1997-05-01"), None, None)],
            "id bigint, name string, brand_id bigint, type_id bigint, created_at timestamp_ntz, "
            "updated_at timestamp_ntz, deleted_at timestamp_ntz"),
        "brands": spark.createDataFrame(
            [(1, "b", ts("1995-01-01"), ts("1996-01-01"), ts("1996-06-01"))],
            "id bigint, name string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz"),
        "types": spark.createDataFrame(
            [(1, "t", ts("1995-01-01"), None, None)],
            "id bigint, name string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz"),
    }
    w = year_window(1997)
    r = star.dim_car_detail(t, w).first()
    # the car is newer than the brand, so its own (null) dates are returned,
    # and a brand deleted before the car existed reads as not deleted
    assert r.updated_at is None and r.deleted_at is None
    assert rows(star.dim_car_detail(t, w)) == rows(star.dim_car_detail_semi(t, w))


def test_rule_split_partitions_input(spark):
    df = spark.createDataFrame([
        (1, 1, 1, 10.0, 1, 5.0, "USD"), (2, None, 1, 10.0, 1, 5.0, "USD"),
        (3, 1, 1, 0.0, 5, 0.0, ""), (4, 1, None, None, None, None, None)],
        "sale_id int, brand_id int, car_id int, sale_price double, currency_id int, "
        "sale_price_normalized double, sale_price_normalized_currency string")
    valid, rejected = Q.split_rules(df, Q.etl_rules())
    assert valid.count() + rejected.count() == df.count()
    assert [r.sale_id for r in valid.collect()] == [1]
    rep = Q.rule_report(df, Q.etl_rules()).first()
    assert (rep.input_rows, rep.valid_rows, rep.rejected_rows) == (4, 1, 3)
    assert rep.fail_currency_allowed == 2 and rep.fail_label_present == 2
    failed = {r.sale_id: set(r.failed_rules) for r in rejected.collect()}
    assert failed[3] == {"sale_price_positive", "currency_allowed", "normalized_positive", "label_present"}


def test_check_fail_mode_raises(spark):
    df = spark.createDataFrame([(1, -1.0)], "sale_id int, sale_price double")
    with pytest.raises(ValueError):
        Q.check(df, {"sale_price_positive": F.col("sale_price") > 0}, ["sale_id"], mode="fail")
    assert Q.check(df, {"sale_price_positive": F.col("sale_price") > 0}, ["sale_id"],
                   mode="quarantine").count() == 0


def test_observed_rules_count_during_write(spark):
    df = spark.createDataFrame([(1, 1, 1, 10.0, 1, 5.0, "USD"), (2, None, 1, 10.0, 1, 5.0, "USD")],
                               "sale_id int, brand_id int, car_id int, sale_price double, currency_id int, "
                               "sale_price_normalized double, sale_price_normalized_currency string")
    valid, obs = Q.observed_rules(df, Q.etl_rules())
    valid.write.format("noop").mode("overwrite").save()
    assert obs.get["input_rows"] == 2 and obs.get["valid_rows"] == 1 and obs.get["fail_brand_id_present"] == 1


def test_fk_and_unique_reports(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id bigint")
    child = spark.createDataFrame([(1, 1), (2, 3), (3, 3), (4, None)], "id bigint, p bigint")
    fk = Q.fk_violations(child, "p", parent, "id", "child", "parent").collect()
    assert [(r.fk_value, r.n_rows) for r in fk] == [(3, 2)]
    u = Q.unique_violations(parent, ["id"], "parent").collect()
    assert [(r.key_value, r.n_rows) for r in u] == [("2", 2)]


def test_constant_row_and_arrow_edge(spark):
    assert tuple(constant_row(spark).first()) == (10, True)
    assert to_arrow_edge(spark.range(5), 10).num_rows == 5
    with pytest.raises(ValueError):
        to_arrow_edge(spark.range(50), 10)


def test_jdbc_source_in_process(spark, tmp_path):
    """S4 against an embedded, in-process Derby database (no server, no
    port); skipped where no Derby driver is on the classpath."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    try:
        spark.range(25).selectExpr("id", "cast(id * 2 as bigint) as v").write.jdbc(
            url, "t", mode="overwrite", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no embedded JDBC database available: {type(e).__name__}")
    from torque.sources.tables import read_jdbc
    df = read_jdbc(spark, url, "t", "id", 0, 25, 4, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 25


def test_folder_of_rate_documents_keeps_newest_rate_per_code(spark, tmp_path):
    for day, (unix, eur) in enumerate([(1772841601, 0.85), (1772928001, 0.8624)]):
        doc = {"time_last_update_unix": unix, "base_code": "USD", "conversion_rates": {"USD": 1, "EUR": eur}}
        (tmp_path / f"d{day}.json").write_text(json.dumps(doc))
    snap = read_rates_document(spark, str(tmp_path))
    got = {r.code: (r.rate, r.updated_at) for r in snap.table.collect()}
    assert got == {"USD": (1.0, datetime(2026, 3, 8, 0, 0, 1)), "EUR": (0.8624, datetime(2026, 3, 8, 0, 0, 1))}


def test_deletes_do_not_flow_through_the_change_window(spark):
    """A row whose only change is ``deleted_at`` keeps its old change time, so
    an incremental load never sees the delete."""
    df = spark.createDataFrame([(1, ts("1996-03-01"), None, ts("1997-05-01"))],
                               "id int, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz")
    assert df.filter(changed_in(year_window(1997))).count() == 0


def test_parquet_file_keeps_rates_columns_table_does_not(spark):
    from conftest import SF_SMALL
    from torque.catalog import WINDOW
    from torque.fixtures import source
    from torque.plans.etl import etl_dataset, etl_frames
    from torque import schemas
    src = source(spark, SF_SMALL)
    frames = etl_frames(src.tables(), src.rates_snapshot, WINDOW)
    assert frames.validated.columns == schemas.NORMALIZED_COLUMNS and len(frames.validated.columns) == 15
    assert etl_dataset(src.tables(), src.rates_snapshot, WINDOW).columns == schemas.CAR_SALES_DATASET_COLUMNS


def test_currency_rule_is_a_parameter(spark):
    df = spark.createDataFrame([(1, 1, 1, 10.0, 5, 5.0, "USD")],
                               "sale_id int, brand_id int, car_id int, sale_price double, currency_id int, "
                               "sale_price_normalized double, sale_price_normalized_currency string")
    assert Q.apply_rules(df, Q.etl_rules()).count() == 0
    assert Q.apply_rules(df, Q.etl_rules(allowed_currency_ids=[5])).count() == 1


def test_json_quarantine_and_serialise(spark):
    from torque.functions.jsonfn import json_check, split_valid, to_json_text
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": 6'), (3, None)], "id int, props string")
    valid, bad = split_valid(df, "props")
    assert sorted(r.id for r in valid.collect()) == [1, 3]     # NULL is allowed
    assert [r.id for r in bad.collect()] == [2]
    got = {r.id: (r.props_valid, r.k) for r in json_check(df, "props", {"k": "bigint"}).collect()}
    assert got == {1: (True, 5), 2: (False, None), 3: (None, None)}
    s = spark.range(1).select(to_json_text(F.struct(F.lit(1).alias("a"), F.lit("x").alias("b"))).alias("j"))
    assert s.first().j == '{"a":1,"b":"x"}'


def test_last_year_window_of_a_given_day():
    from datetime import datetime

    from torque.functions.windows import last_year_window
    w = last_year_window(datetime(2026, 3, 1))
    assert (w.start, w.end) == (datetime(2025, 1, 1), datetime(2025, 12, 31))


def test_null_keys_survive_deduplication(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4)], "k bigint, v int")
    assert rows(M.dedupe_last(df, ["k"], ["v"])) == [(1, 4), (None, 1), (None, 2)]


def test_rows_of_a_batch_apply_in_order(spark):
    target = spark.createDataFrame([(1, 1.0, "a", None, "x")], "k bigint, amount double, note string, first string, last string")
    batch = spark.createDataFrame(
        [(1, 5.0, "b", None, "y", 1), (1, 7.0, None, "p", None, 2), (1, 0.0, "c", "q", None, 3), (2, 2.0, None, None, None, 1),
         (2, None, "d", "r", "z", 2)], "k bigint, amount double, note string, first string, last string, n int")
    policies = {"amount": M.CUMULATIVE, "note": M.CONCAT, "first": M.PROGRESS, "last": M.SKIP_IF_NULL}
    out = M.merge(target, batch, ["k"], policies, dedupe_order=["n"]).drop("n")
    assert rows(out) == [(1, 13.0, "a, b, c", "p", "y"), (2, None, "d", "r", "z")]
    with pytest.raises(ValueError):
        M.merge(target, batch, ["k"], policies)
    with pytest.raises(ValueError):
        M.update_only(target, batch.drop("n"), ["k"])
