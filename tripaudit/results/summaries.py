"""Registered results: derived columns (F1-F19) and sanity summaries (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..chain import conformed_trips, featured_trips
from ..operators import summaries as S
from ..operators.features import FEATURE_COLUMNS, add_features, rule_report
from ..sources.fixture import KEYS

from . import register, presentable, sql_col, KEYS_SQL


def _feature_query(name: str, columns: tuple[str, ...], rules: tuple[str, ...]):
    """One rule (and the rules it reads) applied to the conformed trips, lazily:
    the plan is the rule's projection over a scan of its input columns."""
    cols_sql = ", ".join(sql_col(c) for c in columns)

    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        feat = add_features(conformed_trips(spark, sf_dir), only=rules)
        return presentable(feat.select(*KEYS, *columns))

    register(name, O.with_base(f"SELECT {KEYS_SQL}, {cols_sql} FROM feat"))(fn)


_feature_query("trip_duration", ("lpep_pickup_datetime", "lpep_dropoff_datetime", "trip_duration_min"), ("trip_duration",))
_feature_query("time_features", ("pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_year"), ("time_features",))
_feature_query("expected_fare", ("expected_fare",), ("expected_fare",))
_feature_query("fare_discrepancy", ("fare_amount", "expected_fare", "fare_discrepancy"), ("expected_fare", "fare_discrepancy"))
_feature_query("avg_speed", ("trip_distance", "trip_duration_min", "avg_speed_mph"), ("trip_duration", "avg_speed"))
_feature_query("zone_flags", ("PULocationID", "DOLocationID", "is_invalid_PULocation", "is_invalid_DOLocation", "is_same_zone"), ("zone_flags",))
_feature_query("zero_passenger", ("passenger_count", "is_zero_passenger"), ("zero_passenger",))
_feature_query("ratecode_flag", ("RatecodeID", "is_invalid_ratecodeID"), ("ratecode_flag",))
_feature_query(
    "payment_flags",
    ("payment_type", "tip_amount", "total_amount", "is_invalid_payment", "is_cash_with_tip", "is_free_but_charged"),
    ("payment_flags",),
)


@register("trip_features", O.with_base("SELECT * REPLACE (CAST(payment_type AS DOUBLE) AS payment_type) FROM feat"))
def q_trip_features(spark, sf_dir):
    """the chain's output table (conformed trips + all derived columns),
    written once by ``featured_trips``; the single rules above show their plans."""
    return presentable(featured_trips(spark, sf_dir))


@register("trips_by_hour", O.with_base(
    "SELECT pickup_hour, count(trip_duration_min) AS n_trips FROM feat "
    "WHERE pickup_hour IS NOT NULL GROUP BY pickup_hour ORDER BY pickup_hour"))
def q_trips_by_hour(spark, sf_dir):
    return S.trips_by_hour(featured_trips(spark, sf_dir))


@register("fare_by_weekday", O.with_base(
    "SELECT pickup_dayofweek, "
    "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][pickup_dayofweek + 1] AS day_name, "
    "round(avg(CAST(fare_amount AS DOUBLE)), 6) AS avg_fare FROM feat "
    "WHERE pickup_dayofweek IS NOT NULL GROUP BY pickup_dayofweek ORDER BY pickup_dayofweek"))
def q_fare_by_weekday(spark, sf_dir):
    return S.fare_by_weekday(featured_trips(spark, sf_dir))


@register("null_counts", O.with_base(
    "SELECT 'trip_duration_min' AS \"column\", CAST(count_if(trip_duration_min IS NULL) AS BIGINT) AS n_null FROM feat "
    "UNION ALL SELECT 'avg_speed_mph', CAST(count_if(avg_speed_mph IS NULL) AS BIGINT) FROM feat "
    "UNION ALL SELECT 'fare_discrepancy', CAST(count_if(fare_discrepancy IS NULL) AS BIGINT) FROM feat"))
def q_null_counts(spark, sf_dir):
    return S.null_counts(featured_trips(spark, sf_dir))


@register("negative_durations", O.with_base(
    "SELECT CAST(count_if(trip_duration_min < 0) AS BIGINT) AS n_negative FROM feat"))
def q_negative_durations(spark, sf_dir):
    return S.negative_durations(featured_trips(spark, sf_dir))


_FLAGS = ("is_invalid_PULocation", "is_invalid_DOLocation", "is_same_zone", "is_zero_passenger",
          "is_invalid_ratecodeID", "is_invalid_payment", "is_cash_with_tip", "is_free_but_charged")


@register("flag_domains", O.with_base(
    "SELECT flag, value, count(*) AS n_rows FROM (UNPIVOT (SELECT " + ", ".join(_FLAGS) + " FROM feat) "
    "ON " + ", ".join(_FLAGS) + " INTO NAME flag VALUE value) GROUP BY flag, value"))
def q_flag_domains(spark, sf_dir):
    return S.flag_domains(featured_trips(spark, sf_dir))


_RULE_OF = {
    "trip_duration_min": "trip_duration", "pickup_hour": "time_features", "pickup_dayofweek": "time_features",
    "pickup_month": "time_features", "pickup_year": "time_features", "expected_fare": "expected_fare",
    "fare_discrepancy": "fare_discrepancy", "avg_speed_mph": "avg_speed", "is_invalid_PULocation": "zone_flags",
    "is_invalid_DOLocation": "zone_flags", "is_same_zone": "zone_flags", "is_zero_passenger": "zero_passenger",
    "is_invalid_ratecodeID": "ratecode_flag", "is_invalid_payment": "payment_flags",
    "is_cash_with_tip": "payment_flags", "is_free_but_charged": "payment_flags",
}


def _rules_sql() -> str:
    parts = [
        f"SELECT '{_RULE_OF[o]}' AS rule, '{o}' AS output, 'applied' AS status, '' AS missing, "
        f"count({o}) AS n_non_null, CAST(count(*) FILTER (WHERE {o} <> 0) AS BIGINT) AS n_nonzero FROM feat"
        for o in FEATURE_COLUMNS
    ]
    return O.with_base(" UNION ALL ".join(parts))


_GONE = ("passenger_count", "trip_distance", "PULocationID", "total_amount")
_SKIPPED = {
    "is_zero_passenger": "passenger_count", "avg_speed_mph": "trip_distance", "is_invalid_PULocation": "PULocationID",
    "is_invalid_DOLocation": "PULocationID", "is_same_zone": "PULocationID", "is_free_but_charged": "total_amount",
}


def _guards_sql() -> str:
    parts = []
    for o in FEATURE_COLUMNS:
        if o in _SKIPPED:
            parts.append(f"SELECT '{_RULE_OF[o]}' AS name, '{o}' AS output, 'skipped' AS status, '{_SKIPPED[o]}' AS missing, CAST(0 AS BIGINT) AS n_non_null, CAST(0 AS BIGINT) AS n_nonzero")
        else:
            parts.append(
                f"SELECT '{_RULE_OF[o]}' AS name, '{o}' AS output, 'applied' AS status, '' AS missing, count({o}) AS n_non_null, CAST(count(*) FILTER (WHERE {o} <> 0) AS BIGINT) AS n_nonzero FROM feat"
            )
    gone = [("bivariate", "trip_distance"), ("anomalies", "trip_distance,total_amount,avg_speed_mph,passenger_count")]
    parts += [f"SELECT '{n}', '', 'skipped', '{m}', CAST(0 AS BIGINT), CAST(0 AS BIGINT)" for n, m in gone]
    return O.with_base(" UNION ALL ".join(parts))


@register("guards", _guards_sql())
def q_guards(spark, sf_dir):
    """Rules, EDA and anomaly sections over trips that lack some columns."""
    from ..report import anomaly_tables, eda_tables

    short = conformed_trips(spark, sf_dir).drop(*_GONE)
    featured = add_features(short)
    rules = rule_report(spark, short.columns, featured).withColumnRenamed("rule", "name")
    skipped = eda_tables(spark, featured).skipped + anomaly_tables(spark, featured).skipped
    sections = spark.createDataFrame([(n, "", "skipped", m, 0, 0) for n, m in skipped], "name string, output string, status string, missing string, n_non_null bigint, n_nonzero bigint")
    return rules.union(sections)


@register("skipped_rules", _rules_sql())
def q_skipped_rules(spark, sf_dir):
    from ..chain import conformed_trips

    return rule_report(spark, conformed_trips(spark, sf_dir).columns, featured_trips(spark, sf_dir))
