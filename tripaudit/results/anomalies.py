"""Registered results: anomaly checks."""

from __future__ import annotations

from .. import oracle as O
from ..chain import featured_trips, numeric_profile
from ..config import DEFAULT_ROLES as R
from ..operators import anomalies as A
from ..operators import summaries as S
from ..session import session_key
from . import KEYS_SQL, register

_DAYS = "['" + "','".join(R.day_names) + "']"


_FENCES: dict = {}


def flagged(spark, sf_dir):
    feat = featured_trips(spark, sf_dir)
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _FENCES:  # data-derived constant, computed once per session
        _FENCES[key] = A.duration_fences(spark, feat, R, stats=numeric_profile(spark, sf_dir))
    return A.add_anomaly_flags(feat, _FENCES[key], R)


FLAGGED_SQL = (
    O.BASE.rstrip("\n")
    + ",\nfen AS (SELECT quantile_cont(CAST(trip_duration_min AS DOUBLE), 0.25) AS q1, "
    "quantile_cont(CAST(trip_duration_min AS DOUBLE), 0.75) AS q3 FROM feat),\n"
    "fl AS (SELECT feat.*,\n"
    f"  CAST(coalesce(CAST(trip_distance AS DOUBLE) > {R.max_distance}, false) AS TINYINT) AS flag_impossible_distance,\n"
    f"  CAST(coalesce(CAST(avg_speed_mph AS DOUBLE) > {R.max_speed}, false) AS TINYINT) AS flag_impossible_speed,\n"
    f"  CAST(coalesce(CAST(trip_duration_min AS DOUBLE) < q1 - {R.box_whis} * (q3 - q1) "
    f"OR CAST(trip_duration_min AS DOUBLE) > q3 + {R.box_whis} * (q3 - q1), false) AS TINYINT) AS flag_extreme_duration,\n"
    "  CAST(coalesce(fare_amount < 0 OR total_amount < 0, false) AS TINYINT) AS flag_negative_money,\n"
    f"  CAST(coalesce(CAST(fare_discrepancy AS DOUBLE) > {R.discrepancy_bands[1]}, false) AS TINYINT) AS flag_high_discrepancy,\n"
    f"  CAST(coalesce(CAST(tip_amount AS DOUBLE) > {R.max_tip}, false) AS TINYINT) AS flag_extreme_tip,\n"
    f"  CAST(coalesce(passenger_count BETWEEN {R.passenger_outlier[0]} AND {R.passenger_outlier[1]}, false) AS TINYINT) AS flag_passenger_outlier,\n"
    f"  CAST(coalesce(CAST(trip_distance AS DOUBLE) < {R.idle_distance} AND CAST(trip_duration_min AS DOUBLE) >= {R.idle_duration}, false) AS TINYINT) AS flag_idle_long_trip\n"
    "  FROM feat, fen),\n"
    "cl AS (SELECT *, NOT (flag_impossible_distance = 1 OR flag_impossible_speed = 1 OR flag_extreme_duration = 1 "
    "OR flag_negative_money = 1) AS clean FROM fl)\n"
)


def _sql(body: str) -> str:
    return FLAGGED_SQL + body


@register("anomaly_flags", _sql(f"SELECT {KEYS_SQL}, " + ", ".join(A.ANOMALY_FLAGS) + " FROM fl"))
def q_anomaly_flags(spark, sf_dir):
    from ..sources.fixture import KEYS

    return flagged(spark, sf_dir).select(*KEYS, *A.ANOMALY_FLAGS)


@register("anomaly_overlap", _sql(
    "SELECT CAST(count(*) FILTER (WHERE flag_impossible_distance = 1) AS BIGINT) AS n_distance, CAST(count(*) FILTER (WHERE flag_impossible_speed = 1) AS BIGINT) AS n_speed, "
    "CAST(count(*) FILTER (WHERE flag_impossible_distance = 1 AND flag_impossible_speed = 1) AS BIGINT) AS n_both FROM fl"))
def q_anomaly_overlap(spark, sf_dir):
    return A.anomaly_overlap(flagged(spark, sf_dir))


@register("discrepancy_bands", _sql(
    f"SELECT CASE WHEN fare_discrepancy IS NULL THEN 'missing' WHEN fare_discrepancy < {R.discrepancy_bands[0]} THEN 'near_zero' "
    f"WHEN fare_discrepancy <= {R.discrepancy_bands[1]} THEN 'mid' ELSE 'high' END AS band, count(*) AS n_rows, "
    f"CAST(count(*) FILTER (WHERE fare_amount BETWEEN 10 AND 50) AS BIGINT) AS n_fare_10_50, CAST(count(*) FILTER (WHERE fare_amount >= {R.high_fare}) AS BIGINT) AS n_fare_high "
    "FROM fl GROUP BY band"))
def q_discrepancy_bands(spark, sf_dir):
    return A.discrepancy_bands(flagged(spark, sf_dir))


@register("tip_anomalies", _sql(
    "SELECT flag_extreme_tip AS extreme_tip, is_cash_with_tip AS cash_with_tip, count(*) AS n_rows FROM fl "
    "GROUP BY flag_extreme_tip, is_cash_with_tip"))
def q_tip_anomalies(spark, sf_dir):
    return A.tip_anomalies(flagged(spark, sf_dir))


@register("demand_profile", O.with_base(
    "SELECT pickup_hour, n_trips, round(n_trips / sum(n_trips) OVER (), 6) AS share, "
    "CAST(row_number() OVER (ORDER BY n_trips ASC, pickup_hour ASC) AS INTEGER) AS rank_low, "
    "CAST(row_number() OVER (ORDER BY n_trips DESC, pickup_hour ASC) AS INTEGER) AS rank_high, "
    "CAST(row_number() OVER (ORDER BY n_trips ASC, pickup_hour ASC) <= 3 AS TINYINT) AS is_dead_hour, "
    "CAST(row_number() OVER (ORDER BY n_trips DESC, pickup_hour ASC) <= 2 AS TINYINT) AS is_peak_hour "
    "FROM (SELECT pickup_hour, count(trip_duration_min) AS n_trips FROM feat WHERE pickup_hour IS NOT NULL GROUP BY pickup_hour)"))
def q_demand_profile(spark, sf_dir):
    return A.demand_profile(S.trips_by_hour(featured_trips(spark, sf_dir)))


@register("fare_by_weekday_clean", _sql(
    f"SELECT pickup_dayofweek, {_DAYS}[pickup_dayofweek + 1] AS day_name, "
    "round(avg(CAST(fare_amount AS DOUBLE)), 6) AS avg_fare, "
    "round(avg(CASE WHEN clean THEN CAST(fare_amount AS DOUBLE) END), 6) AS avg_fare_clean, "
    "count(*) AS n_trips, CAST(count(*) FILTER (WHERE clean) AS BIGINT) AS n_clean FROM cl WHERE pickup_dayofweek IS NOT NULL GROUP BY pickup_dayofweek"))
def q_fare_by_weekday_clean(spark, sf_dir):
    return A.fare_by_weekday_clean(flagged(spark, sf_dir))


def _corr_sql() -> str:
    parts = []
    for name, x, y in A.CORR_PAIRS:
        xd, yd = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS pair, round(corr({xd}, {yd}), 6) AS corr_all, "
            f"round(corr(CASE WHEN clean THEN {xd} END, CASE WHEN clean THEN {yd} END), 6) AS corr_clean FROM cl"
        )
    return _sql(" UNION ALL ".join(parts))


@register("pair_correlations", _corr_sql())
def q_pair_correlations(spark, sf_dir):
    return A.pair_correlations(flagged(spark, sf_dir))


def _ranking_sql() -> str:
    parts = [
        f"SELECT {p} AS priority, '{name}' AS rule, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS n_rows, round(CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) / count(*), 6) AS share FROM fl"
        for p, name, cond in A.RANKED_RULES
    ]
    return _sql(" UNION ALL ".join(parts))


@register("anomaly_ranking", _ranking_sql())
def q_anomaly_ranking(spark, sf_dir):
    return A.anomaly_ranking(flagged(spark, sf_dir))
