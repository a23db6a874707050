"""Edge rows of every derived column and flag (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from tripaudit.operators.features import FEATURE_COLUMNS, add_features, feature_manifest

TS = T.TimestampNTZType()


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def _one(df, col):
    return [r[col] for r in df.orderBy("id").collect()]


def test_duration_and_time_parts(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("lpep_pickup_datetime", TS), T.StructField("lpep_dropoff_datetime", TS)]
    )
    rows = [
        (1, dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30)),  # wall clock across DST
        (2, dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 9, 57)),  # negative kept
        (3, dt.datetime(2024, 1, 1, 10, 0), None),
        (4, None, dt.datetime(2024, 1, 1, 10, 0)),
    ]
    out = add_features(_frame(spark, rows, schema))
    assert _one(out, "trip_duration_min") == [120.0, -3.0, None, None]
    assert _one(out, "pickup_dayofweek")[:3] == [6, 0, 0]  # 2024-03-10 Sunday, 2024-01-01 Monday
    assert _one(out, "pickup_hour") == [1, 10, 10, None]
    assert _one(out, "pickup_year")[0] == 2024
    assert dict(out.dtypes)["pickup_year"] == "smallint"
    assert dict(out.dtypes)["pickup_hour"] == "tinyint"


def test_tpep_names_are_used_when_lpep_absent(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("tpep_pickup_datetime", TS), T.StructField("tpep_dropoff_datetime", TS)]
    )
    out = add_features(_frame(spark, [(1, dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 30))], schema))
    assert _one(out, "trip_duration_min") == [30.0]


def test_expected_fare_and_discrepancy(spark):
    schema = "id int, fare_amount float, extra float, tip_amount float, mta_tax float"
    rows = [(1, 10.0, 1.0, 2.0, 0.0), (2, None, 0.5, 0.5, 0.5)]
    out = add_features(spark.createDataFrame(rows, schema))
    assert _one(out, "expected_fare") == [13.0, 1.5]
    assert _one(out, "fare_discrepancy") == [3.0, None]


def test_expected_fare_without_components_is_zero(spark):
    out = add_features(spark.createDataFrame([(1,)], "id int"))
    assert _one(out, "expected_fare") == [0.0]
    assert "fare_discrepancy" not in out.columns


def test_speed_edges(spark):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("lpep_pickup_datetime", TS),
         T.StructField("lpep_dropoff_datetime", TS), T.StructField("trip_distance", T.FloatType())]
    )
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    rows = [
        (1, t0, t0, 1.0),  # 1 mile in 0 min -> inf -> 0
        (2, t0, t0, 0.0),  # 0/0 -> 0
        (3, t0, t0 + dt.timedelta(minutes=3), None),  # null distance -> 0
        (4, t0, None, 1.0),  # null duration -> 0
        (5, t0, t0 - dt.timedelta(minutes=3), 1.0),  # -20 mph
        (6, t0, t0 + dt.timedelta(minutes=30), 10.0),
    ]
    out = add_features(_frame(spark, rows, schema))
    assert _one(out, "avg_speed_mph") == [0.0, 0.0, 0.0, 0.0, -20.0, 20.0]


def test_zone_flags(spark):
    rows = [(1, 0, 1), (2, 264, 263), (3, 265, 265), (4, None, None), (5, 1, 1), (6, 263, 100)]
    out = add_features(spark.createDataFrame(rows, "id int, PULocationID smallint, DOLocationID smallint"))
    assert _one(out, "is_invalid_PULocation") == [1, 1, 1, 1, 0, 0]
    assert _one(out, "is_invalid_DOLocation") == [0, 0, 1, 1, 0, 0]
    assert _one(out, "is_same_zone") == [0, 0, 1, 0, 1, 0]


def test_fractional_zone_is_invalid(spark):
    out = add_features(spark.createDataFrame([(1, 1.5, 2.0)], "id int, PULocationID double, DOLocationID double"))
    assert _one(out, "is_invalid_PULocation") == [1]
    assert _one(out, "is_invalid_DOLocation") == [0]


def test_passenger_and_ratecode(spark):
    rows = [(1, None, None), (2, 0, 0), (3, 2, 99), (4, 1, 6)]
    out = add_features(spark.createDataFrame(rows, "id int, passenger_count tinyint, RatecodeID tinyint"))
    assert _one(out, "passenger_count") == [0, 0, 2, 1]
    assert _one(out, "is_zero_passenger") == [1, 1, 0, 0]
    assert _one(out, "RatecodeID") == [0, 0, 99, 6]
    assert _one(out, "is_invalid_ratecodeID") == [1, 1, 1, 0]


def test_payment_flags(spark):
    schema = "id int, payment_type tinyint, tip_amount float, fare_amount float, total_amount float"
    rows = [
        (1, None, 1.0, 5.0, 5.0),
        (2, 0, 0.0, 5.0, 5.0),
        (3, 7, 0.0, 5.0, 5.0),
        (4, 2, 1.0, 5.0, 5.0),
        (5, 2, 0.0, 5.0, 5.0),
        (6, 1, 1.0, 5.0, 5.0),
        (7, 3, 0.0, 5.0, 5.0),
        (8, 6, 0.0, 5.0, 5.0),
        (9, 3, 0.0, 0.0, 0.0),
        (10, 3, 0.0, -1.0, -1.0),
    ]
    out = add_features(spark.createDataFrame(rows, schema))
    assert _one(out, "is_invalid_payment") == [1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert _one(out, "is_cash_with_tip") == [0, 0, 0, 1, 0, 0, 0, 0, 0, 0]
    assert _one(out, "is_free_but_charged") == [0, 0, 0, 0, 0, 0, 1, 1, 0, 0]


def test_missing_inputs_skip_rules_without_error(spark):
    from tripaudit.chain import featured_trips

    feat = featured_trips(spark, "/root/testdata/sf0.001")
    base = [c for c in feat.columns if c not in FEATURE_COLUMNS]
    conformed = feat.select(*base)
    for dropped in ("lpep_pickup_datetime", "trip_distance", "fare_amount", "payment_type", "total_amount", "PULocationID"):
        out = add_features(conformed.drop(dropped))
        out.limit(5).collect()
        manifest = feature_manifest(conformed.drop(dropped).columns)
        assert any(status == "skipped" for _, status, _, _ in manifest)


def test_chain_is_idempotent(spark):
    from tripaudit.chain import featured_trips

    feat = featured_trips(spark, "/root/testdata/sf0.001")
    again = add_features(feat)
    cols = [c for c in feat.columns]
    assert feat.select(*cols).exceptAll(again.select(*cols)).count() == 0


@pytest.mark.parametrize("col", ["is_invalid_PULocation", "is_same_zone", "is_free_but_charged"])
def test_flags_are_zero_or_one(spark, col):
    from tripaudit.chain import featured_trips

    vals = {r[0] for r in featured_trips(spark, "/root/testdata/sf0.001").select(col).distinct().collect()}
    assert vals <= {0, 1}


def test_duration_is_wall_clock_in_any_session_zone(spark):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("lpep_pickup_datetime", TS), T.StructField("lpep_dropoff_datetime", TS)])
    rows = [(1, dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30)), (2, dt.datetime(2024, 11, 3, 0, 30), dt.datetime(2024, 11, 3, 2, 30))]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = add_features(_frame(spark, rows, schema))
        assert _one(out, "trip_duration_min") == [120.0, 120.0]
        assert _one(out, "pickup_hour") == [1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rule_report_lists_skipped_outputs(spark):
    from tripaudit.chain import conformed_trips
    from tripaudit.operators.features import rule_report

    conf = conformed_trips(spark, "/root/testdata/sf0.001").drop("tip_amount", "lpep_dropoff_datetime")
    rep = {r["output"]: r for r in rule_report(spark, conf.columns, add_features(conf)).collect()}
    assert rep["is_cash_with_tip"]["status"] == "skipped" and rep["is_cash_with_tip"]["missing"] == "tip_amount"
    assert rep["trip_duration_min"]["status"] == "skipped" and rep["trip_duration_min"]["missing"] == "dropoff"
    assert rep["avg_speed_mph"]["status"] == "skipped"
    assert rep["pickup_hour"]["status"] == "applied" and rep["pickup_hour"]["n_non_null"] > 0
    assert rep["is_same_zone"]["n_nonzero"] > 0


def test_nan_counts_as_missing_without_conform(spark):
    rows = [(1, float("nan"), 2.0, float("nan"))]
    out = add_features(spark.createDataFrame(rows, "id int, fare_amount double, extra double, passenger_count double"))
    assert _one(out, "expected_fare") == [2.0]
    assert _one(out, "passenger_count") == [0.0]
    assert _one(out, "is_zero_passenger") == [1]
