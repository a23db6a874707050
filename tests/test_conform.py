"""Type narrowing verdicts, null columns, parsing, categories (FIXTURES.md §3-4)."""

from __future__ import annotations

import math

from tripaudit.config import DEFAULT_ROLES
from tripaudit.operators import conform as C
from tripaudit.plans.profile import build_plan


def _verdicts(spark, rows, schema, pairs):
    roles = DEFAULT_ROLES.with_(narrow_targets=pairs, columns_to_drop=(), categorical_columns=())
    plan = build_plan(spark.createDataFrame(rows, schema), roles)
    return [(v.column, v.target, v.verdict) for v in plan.casts]


def test_float_loss_keeps_column(spark):
    out = _verdicts(spark, [(1e39,), (1.0,)], "x double", (("x", "float32"),))
    assert out == [("x", "float32", "kept_loss")]
    out = _verdicts(spark, [(0.1,), (None,), (float("inf"),)], "x double", (("x", "float32"),))
    assert out == [("x", "float32", "converted")]


def test_int16_verdicts(spark):
    assert _verdicts(spark, [(70000.0,)], "x double", (("x", "int16"),))[0][2] == "kept_loss"
    assert _verdicts(spark, [(1.5,)], "x double", (("x", "int16"),))[0][2] == "kept_loss"
    assert _verdicts(spark, [(1.0,), (None,)], "x double", (("x", "int16"),))[0][2] == "failed"
    assert _verdicts(spark, [(12.0,), (300.0,)], "x double", (("x", "int16"),))[0][2] == "converted"


def test_int8_verdicts(spark):
    assert _verdicts(spark, [(300.0,)], "x double", (("x", "Int8"),))[0][2] == "failed"
    assert _verdicts(spark, [(1.5,)], "x double", (("x", "Int8"),))[0][2] == "failed"
    assert _verdicts(spark, [(1.0,), (None,)], "x double", (("x", "Int8"),))[0][2] == "converted"
    assert _verdicts(spark, [(1.0,)], "x double", (("y", "Int8"),))[0][2] == "skipped"
    assert _verdicts(spark, [("a",)], "x string", (("x", "Int8"),))[0][2] == "failed"


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),)], "x double")
    plan = build_plan(df, DEFAULT_ROLES.with_(narrow_targets=(("x", "Int8"),), columns_to_drop=(), categorical_columns=()))
    assert plan.dropped_all_null == ("x",)


def test_lineitem_verdicts_match_fixture_notes(spark):
    from tripaudit.results.conform import LINEITEM_PAIRS
    from tripaudit.sources.fixture import read_table

    roles = DEFAULT_ROLES.with_(narrow_targets=LINEITEM_PAIRS, columns_to_drop=(), categorical_columns=())
    plan = build_plan(read_table(spark, "/root/testdata/sf0.01", "lineitem"), roles)
    got = {(v.column, v.target): v.verdict for v in plan.casts}
    assert got[("l_quantity", "Int8")] == "converted"
    assert got[("l_extendedprice", "Int8")] == "failed"
    assert got[("l_extendedprice", "int16")] == "kept_loss"
    assert got[("l_orderkey", "int16")] == "converted"
    assert got[("l_extendedprice", "float32")] == "converted"
    assert got[("l_not_a_column", "Int8")] == "skipped"


def test_parse_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("bad",), (None,)], "tpep_pickup_datetime string")
    out = C.parse_timestamps(df)
    assert dict(out.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    vals = [r[0] for r in out.collect()]
    assert vals[1] is None and vals[2] is None and vals[0].hour == 10


def test_drop_steps_and_empty_frame(spark):
    df = spark.createDataFrame([(1, None, "N", 2.0)], "VendorID int, ehail_x double, store_and_fwd_flag string, fare_amount double")
    out, plan = C.conform(df)
    assert out.columns == ["fare_amount"]
    assert plan.dropped_by_name == ("VendorID", "store_and_fwd_flag")
    assert plan.dropped_all_null == ("ehail_x",)
    empty = spark.createDataFrame([], "a double, fare_amount double")
    out, plan = C.conform(empty)
    assert out.columns == ["a", "fare_amount"]  # 0 rows: schema kept


def test_cardinality_ratio(spark):
    rows = [(float(i % 7),) for i in range(60000)]
    plan = build_plan(spark.createDataFrame(rows, "payment_type double"), DEFAULT_ROLES)
    cat = plan.categories[0]
    assert cat.n_distinct == 7 and cat.verdict == "categorical"
    assert math.isclose(cat.ratio, 7 / 60000)
    rows = [(float(i % 7),) for i in range(1000)]
    plan = build_plan(spark.createDataFrame(rows, "payment_type double"), DEFAULT_ROLES)
    assert plan.categories[0].verdict == "kept"


def test_category_codes(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (7,), (2,)], "payment_type tinyint")
    codes = {r["payment_type"]: r["code"] for r in C.category_codes(df, "payment_type").collect()}
    assert codes == {1: 0, 2: 1, None: -1, 7: 2}
    enc = C.encode_categories(df, "payment_type", C.category_codes(df, "payment_type"), 100)
    assert sorted(r["payment_type_code"] for r in enc.collect()) == [-1, 0, 1, 1, 2]


def test_fixture_plan_and_footprint(spark):
    from tripaudit.chain import conformed_trips, plan_for, trips

    sf = "/root/testdata/sf0.01"
    plan = plan_for(spark, sf)
    assert all(v.verdict == "converted" for v in plan.casts)
    assert plan.dropped_all_null == ("airport_fee",)
    rep = C.footprint_report(spark, trips(spark, sf), conformed_trips(spark, sf)).collect()[0]
    assert rep["rows"] == 60000 and rep["columns"] == 21
    assert rep["after_mb"] < rep["before_mb"] and rep["reduction_percent"] > 40


def test_parse_timestamps_with_formats(spark):
    roles = DEFAULT_ROLES.with_(datetime_formats=("MM/dd/yyyy HH:mm",))
    df = spark.createDataFrame([("01/15/2024 10:30",), ("2024-01-16 11:00:00",), ("junk",)], "tpep_pickup_datetime string")
    vals = [r[0] for r in C.parse_timestamps(df, roles).collect()]
    assert (vals[0].day, vals[0].hour, vals[0].minute) == (15, 10, 30)
    assert (vals[1].day, vals[1].hour) == (16, 11)
    assert vals[2] is None


def test_optimize_returns_frame_and_report(spark):
    from tripaudit.chain import trips

    src = trips(spark, "/root/testdata/sf0.001")
    out, rep = C.optimize(spark, src)
    assert rep["rows"] == src.count() and rep["columns"] == len(out.columns) == 21
    assert rep["types_before"]["passenger_count"] == "double" and rep["types_after"]["passenger_count"] == "tinyint"
    assert "VendorID" not in rep["types_after"] and rep["verdicts"]["fare_amount"] == "converted"
    assert 0 < rep["after_mb"] < rep["before_mb"]
