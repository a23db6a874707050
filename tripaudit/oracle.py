"""DuckDB SQL that recomputes each registered result from the given tables.

Used only as a correctness oracle (the driver runs it next to the Spark
query). ``TRIPS`` rebuilds the ``trips`` view from ``lineitem``, ``CONFORMED``
applies the narrowing verdicts that hold for that view, ``FEAT`` adds the
derived columns.
"""

from __future__ import annotations

TRIPS = """
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS q, l_shipdate,
         l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31 + l_linenumber * 17 AS h
  FROM lineitem
),
li2 AS (
  SELECT *,
    l_shipdate + INTERVAL '1' SECOND * (h % 86400) AS pu,
    CASE WHEN h % 97 = 0 THEN 0 WHEN h % 101 = 0 THEN -(h % 600)
         WHEN h % 499 = 0 THEN 84000 ELSE 60 + h % 5400 END AS secs,
    CASE WHEN h % 53 = 0 THEN -q WHEN h % 1511 = 0 THEN CAST(320 AS DOUBLE)
         ELSE q * 1.5 + 3 END AS fare_base,
    CAST((h % 3) * 0.5 AS DOUBLE) AS extra_v,
    CASE WHEN h % 2003 = 0 OR h % 3022 = 0 THEN CAST(64 AS DOUBLE)
         WHEN h % 4 = 0 THEN q * 0.25 ELSE CAST(0 AS DOUBLE) END AS tip_v
  FROM li
),
trips AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    1 + h % 2 AS VendorID,
    CASE WHEN h % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    1 + h % 2 AS trip_type,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    CAST(NULL AS DOUBLE) AS airport_fee,
    pu AS lpep_pickup_datetime,
    pu + INTERVAL '1' SECOND * secs AS lpep_dropoff_datetime,
    CASE WHEN h % 23 = 0 THEN NULL WHEN h % 29 = 0 THEN CAST(0 AS DOUBLE)
         WHEN h % 401 = 0 THEN CAST(8 AS DOUBLE) ELSE CAST(1 + h % 6 AS DOUBLE) END AS passenger_count,
    CASE WHEN h % 23 = 0 THEN NULL WHEN h % 211 = 0 THEN CAST(99 AS DOUBLE)
         ELSE CAST(1 + h % 6 AS DOUBLE) END AS RatecodeID,
    1 + h % 265 AS PULocationID,
    CASE WHEN h % 13 = 0 THEN 1 + h % 265 ELSE 1 + (l_partkey * 13 + l_suppkey) % 265 END AS DOLocationID,
    CASE WHEN h % 23 = 0 THEN NULL WHEN h % 307 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(1 + (h + l_linenumber) % 6 AS DOUBLE) END AS payment_type,
    CASE WHEN h % 1009 = 0 THEN CAST(80000 AS DOUBLE) WHEN h % 37 = 0 THEN CAST(0 AS DOUBLE)
         ELSE q * 0.25 END AS trip_distance,
    CASE WHEN h % 59 = 0 THEN NULL ELSE fare_base END AS fare_amount,
    extra_v AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    tip_v AS tip_amount,
    CASE WHEN h % 20 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN h % 23 = 0 THEN NULL WHEN h % 5 = 0 THEN CAST(2.75 AS DOUBLE)
         ELSE CAST(0 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01 00:00:00' THEN CAST(0.75 AS DOUBLE) END AS cbd_congestion_fee,
    (CASE WHEN h % 59 = 0 THEN CAST(0 AS DOUBLE) ELSE fare_base END) + extra_v + 1.5 + tip_v
      + CASE WHEN h % 71 = 0 THEN CAST(5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS total_amount
  FROM li2
)"""

CONFORMED = """
conformed AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    lpep_pickup_datetime, lpep_dropoff_datetime,
    CAST(passenger_count AS TINYINT) AS passenger_count,
    CAST(RatecodeID AS TINYINT) AS RatecodeID,
    CAST(PULocationID AS SMALLINT) AS PULocationID,
    CAST(DOLocationID AS SMALLINT) AS DOLocationID,
    CAST(payment_type AS TINYINT) AS payment_type,
    CAST(trip_distance AS FLOAT) AS trip_distance,
    CAST(fare_amount AS FLOAT) AS fare_amount,
    CAST(extra AS FLOAT) AS extra,
    CAST(mta_tax AS FLOAT) AS mta_tax,
    CAST(tip_amount AS FLOAT) AS tip_amount,
    CAST(tolls_amount AS FLOAT) AS tolls_amount,
    CAST(improvement_surcharge AS FLOAT) AS improvement_surcharge,
    CAST(congestion_surcharge AS FLOAT) AS congestion_surcharge,
    CAST(cbd_congestion_fee AS FLOAT) AS cbd_congestion_fee,
    CAST(total_amount AS FLOAT) AS total_amount
  FROM trips
)"""

_Z = "CAST(0 AS FLOAT)"

FEAT = f"""
f1 AS (
  SELECT * REPLACE (
      CAST(coalesce(passenger_count, 0) AS TINYINT) AS passenger_count,
      CAST(coalesce(RatecodeID, 0) AS TINYINT) AS RatecodeID),
    CAST(CAST(epoch_us(lpep_dropoff_datetime) - epoch_us(lpep_pickup_datetime) AS DOUBLE)
         / 1000000.0 / 60.0 AS FLOAT) AS trip_duration_min,
    CAST(hour(lpep_pickup_datetime) AS TINYINT) AS pickup_hour,
    CAST(isodow(lpep_pickup_datetime) - 1 AS TINYINT) AS pickup_dayofweek,
    CAST(month(lpep_pickup_datetime) AS TINYINT) AS pickup_month,
    CAST(year(lpep_pickup_datetime) AS SMALLINT) AS pickup_year,
    CAST(coalesce(fare_amount, {_Z}) + coalesce(extra, {_Z}) + coalesce(mta_tax, {_Z})
       + coalesce(tip_amount, {_Z}) + coalesce(tolls_amount, {_Z}) + coalesce(improvement_surcharge, {_Z})
       + coalesce(congestion_surcharge, {_Z}) + coalesce(cbd_congestion_fee, {_Z}) AS FLOAT) AS expected_fare
  FROM conformed
),
f2 AS (
  SELECT *,
    CAST(abs(fare_amount - expected_fare) AS FLOAT) AS fare_discrepancy,
    CAST(CAST(trip_duration_min AS DOUBLE) / 60.0 AS FLOAT) AS dur_h
  FROM f1
),
feat AS (
  SELECT * EXCLUDE (dur_h, spd),
    CAST(CASE WHEN spd IS NULL OR isnan(spd) OR isinf(spd) THEN 0 ELSE spd END AS FLOAT) AS avg_speed_mph,
    CAST(NOT coalesce(PULocationID BETWEEN 1 AND 263 AND PULocationID = floor(PULocationID), false) AS TINYINT) AS is_invalid_PULocation,
    CAST(NOT coalesce(DOLocationID BETWEEN 1 AND 263 AND DOLocationID = floor(DOLocationID), false) AS TINYINT) AS is_invalid_DOLocation,
    CAST(coalesce(PULocationID = DOLocationID, false) AS TINYINT) AS is_same_zone,
    CAST(passenger_count = 0 AS TINYINT) AS is_zero_passenger,
    CAST(NOT coalesce(RatecodeID IN (1, 2, 3, 4, 5, 6), false) AS TINYINT) AS is_invalid_ratecodeID,
    CAST(NOT coalesce(payment_type IN (1, 2, 3, 4, 5, 6), false) AS TINYINT) AS is_invalid_payment,
    CAST(coalesce(payment_type = 2 AND tip_amount > 0, false) AS TINYINT) AS is_cash_with_tip,
    CAST(coalesce(payment_type IN (3, 6) AND total_amount > 0, false) AS TINYINT) AS is_free_but_charged
  FROM (
    SELECT *,
      CAST(CASE WHEN dur_h IS NULL OR dur_h = 0 THEN NULL
                ELSE CAST(trip_distance AS DOUBLE) / CAST(dur_h AS DOUBLE) END AS FLOAT) AS spd
    FROM f2
  )
)"""

BASE = "WITH " + ",".join([TRIPS, CONFORMED, FEAT]) + "\n"


def with_base(body: str, trips: str | None = None) -> str:
    """The base tables and ``body``; ``trips`` is a SELECT over trips_raw that takes the place of the view."""
    if trips is None:
        return BASE + body
    raw = TRIPS.replace("trips AS (", "trips_raw AS (", 1)
    return "WITH " + ",".join([raw, f"\ntrips AS ({trips})", CONFORMED, FEAT]) + "\n" + body


# --------------------------------------------------------------------------
# conformance oracles
# --------------------------------------------------------------------------
TRIPS_SCHEMA = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("VendorID", "bigint"), ("store_and_fwd_flag", "string"), ("trip_type", "bigint"),
    ("ehail_fee", "double"), ("airport_fee", "double"),
    ("lpep_pickup_datetime", "timestamp_ntz"), ("lpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"), ("RatecodeID", "double"), ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"), ("payment_type", "double"), ("trip_distance", "double"),
    ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"), ("tip_amount", "double"),
    ("tolls_amount", "double"), ("improvement_surcharge", "double"), ("congestion_surcharge", "double"),
    ("cbd_congestion_fee", "double"), ("total_amount", "double"),
)
LINEITEM_SCHEMA = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)
DEFAULT_SIZE = {"bigint": 8, "int": 4, "smallint": 2, "tinyint": 1, "double": 8, "float": 4, "timestamp_ntz": 8}
TARGET_TYPE = {"Int8": "tinyint", "int16": "smallint", "float32": "float"}


def verdict_sql(col: str, target: str) -> str:
    """SQL CASE giving converted / kept_loss / failed for one (column, target)."""
    x = f"CAST({col} AS DOUBLE)"
    if target == "float32":
        back = f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
        ok = (f"coalesce(bool_and({x} IS NULL OR {back} = {x} OR (abs({back}) < CAST('inf' AS DOUBLE) "
              f"AND abs({x} - {back}) <= 1e-6 + 1e-4 * abs({back}))), true)")
        return f"CASE WHEN {ok} THEN 'converted' ELSE 'kept_loss' END"
    lo, hi = (-128, 127) if target == "Int8" else (-32768, 32767)
    ok = f"coalesce(bool_and({x} IS NULL OR ({x} BETWEEN {lo} AND {hi} AND {x} = floor({x}))), true)"
    if target == "Int8":
        return f"CASE WHEN {ok} THEN 'converted' ELSE 'failed' END"
    finite = f"coalesce(bool_and({x} IS NULL OR abs({x}) < CAST('inf' AS DOUBLE)), true)"
    return (f"CASE WHEN count({col}) < count(*) OR NOT {finite} THEN 'failed' "
            f"WHEN {ok} THEN 'converted' ELSE 'kept_loss' END")


def cast_verdicts_sql(table: str, schema: tuple, pairs: tuple) -> str:
    types = dict(schema)
    parts = []
    for col, target in pairs:
        if col not in types:
            parts.append(f"SELECT '{table}' AS tbl, '{col}' AS \"column\", '{target}' AS target, "
                         f"CAST(NULL AS VARCHAR) AS type_before, CAST(NULL AS VARCHAR) AS type_after, 'skipped' AS verdict")
            continue
        v = verdict_sql(col, target)
        before = types[col]
        parts.append(
            f"SELECT '{table}' AS tbl, '{col}' AS \"column\", '{target}' AS target, '{before}' AS type_before, "
            f"CASE WHEN v = 'converted' THEN '{TARGET_TYPE[target]}' ELSE '{before}' END AS type_after, v AS verdict "
            f"FROM (SELECT {v} AS v FROM {table})"
        )
    return "\nUNION ALL ".join(parts)
