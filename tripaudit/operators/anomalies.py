"""Checks the reports describe in prose (R1-R12), as data.

Row-level anomaly flags are a projection (R1-R8); the tables are one
aggregate each over the flagged trips. The only data-dependent constant is
the duration fence (Tukey, from the exact quartiles of ``quantiles.py``),
computed once and passed as a literal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT_ROLES, TripRoles
from ..functions.exprs import flag
from .distributions import numeric_long, numeric_stats
from .quantiles import exact_quantiles

ANOMALY_FLAGS = (
    "flag_impossible_distance",
    "flag_impossible_speed",
    "flag_extreme_duration",
    "flag_negative_money",
    "flag_high_discrepancy",
    "flag_extreme_tip",
    "flag_passenger_outlier",
    "flag_idle_long_trip",
)


@dataclass(frozen=True)
class Fences:
    lo: float | None
    hi: float | None


def duration_fences(spark: SparkSession, df: DataFrame, roles: TripRoles = DEFAULT_ROLES, stats: dict | None = None) -> Fences:
    """Tukey fences of ``trip_duration_min`` (q1 - w*IQR, q3 + w*IQR), exact quartiles."""
    col = "trip_duration_min"
    st = (stats or numeric_stats(df, (col,)))[col]
    if not st["n"]:
        return Fences(None, None)
    long = numeric_long(df, (col,))
    bounds = {col: (st["n"], st["min"], st["max"])}
    approx = None
    if st.get("approx") is not None:  # brackets for (0.25, 0.5, 0.75): keep those of 0.25 and 0.75
        a = st["approx"]
        approx = {col: [a[0], a[1], a[4], a[5]]}
    q = exact_quantiles(spark, long, (0.25, 0.75), bounds, approx=approx)[col]
    iqr = q[0.75] - q[0.25]
    return Fences(q[0.25] - roles.box_whis * iqr, q[0.75] + roles.box_whis * iqr)


def add_anomaly_flags(df: DataFrame, fences: Fences, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """R1-R8 as 0/1 TINYINT columns (unknown -> 0)."""
    dist, fare, total = F.col("trip_distance"), F.col("fare_amount"), F.col("total_amount")
    dur, speed = F.col("trip_duration_min"), F.col("avg_speed_mph")
    lo7, hi9 = roles.passenger_outlier
    if fences.lo is None:
        extreme = F.lit(False)
    else:
        extreme = (dur < F.lit(fences.lo)) | (dur > F.lit(fences.hi))
    return df.withColumns(
        {
            "flag_impossible_distance": flag(dist > roles.max_distance),
            "flag_impossible_speed": flag(speed > roles.max_speed),
            "flag_extreme_duration": flag(extreme),
            "flag_negative_money": flag((fare < 0) | (total < 0)),
            "flag_high_discrepancy": flag(F.col("fare_discrepancy") > roles.discrepancy_bands[1]),
            "flag_extreme_tip": flag(F.col("tip_amount") > roles.max_tip),
            "flag_passenger_outlier": flag(F.col("passenger_count").between(lo7, hi9)),
            "flag_idle_long_trip": flag((dist < roles.idle_distance) & (dur >= roles.idle_duration)),
        }
    )


def is_clean() -> F.Column:
    """No impossible distance/speed, no extreme duration, no negative money."""
    bad = (
        (F.col("flag_impossible_distance") == 1)
        | (F.col("flag_impossible_speed") == 1)
        | (F.col("flag_extreme_duration") == 1)
        | (F.col("flag_negative_money") == 1)
    )
    return ~bad


def anomaly_overlap(flagged: DataFrame) -> DataFrame:
    """R2: distance and speed anomalies and how many rows carry both."""
    d, s = F.col("flag_impossible_distance") == 1, F.col("flag_impossible_speed") == 1
    return flagged.agg(
        F.count_if(d).alias("n_distance"), F.count_if(s).alias("n_speed"), F.count_if(d & s).alias("n_both")
    )


def discrepancy_bands(flagged: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """Rows per discrepancy band, with the fare bands the bivariate prose names."""
    lo, hi = roles.discrepancy_bands
    d, fare = F.col("fare_discrepancy"), F.col("fare_amount")
    band = (
        F.when(d.isNull(), F.lit("missing"))
        .when(d < lo, F.lit("near_zero"))
        .when(d <= hi, F.lit("mid"))
        .otherwise(F.lit("high"))
    )
    return flagged.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(fare.between(10, 50)).alias("n_fare_10_50"),
        F.count_if(fare >= roles.high_fare).alias("n_fare_high"),
    )


def tip_anomalies(flagged: DataFrame) -> DataFrame:
    """Extreme tip x cash-with-tip, 2 x 2 counts."""
    return flagged.groupBy(
        F.col("flag_extreme_tip").alias("extreme_tip"), F.col("is_cash_with_tip").alias("cash_with_tip")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def demand_profile(by_hour: DataFrame, dead: int = 3, peak: int = 2) -> DataFrame:
    """Share per hour and the lowest / highest hours.

    Input is the 24-row result of ``trips_by_hour``; the ranking window runs
    over those 24 rows only.
    """
    w_all = Window.partitionBy()
    low = Window.orderBy(F.col("n_trips").asc(), F.col("pickup_hour").asc())
    high = Window.orderBy(F.col("n_trips").desc(), F.col("pickup_hour").asc())
    return by_hour.select(
        "pickup_hour",
        "n_trips",
        F.round(F.col("n_trips") / F.sum("n_trips").over(w_all), 6).alias("share"),
        F.row_number().over(low).alias("rank_low"),
        F.row_number().over(high).alias("rank_high"),
    ).withColumns(
        {
            "is_dead_hour": (F.col("rank_low") <= dead).cast("tinyint"),
            "is_peak_hour": (F.col("rank_high") <= peak).cast("tinyint"),
        }
    )


def fare_by_weekday_clean(flagged: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """Mean fare per weekday over all trips and over clean trips."""
    from .summaries import day_name

    fare = F.col("fare_amount").cast("double")
    clean = is_clean()
    return (
        flagged.where(F.col("pickup_dayofweek").isNotNull())
        .groupBy("pickup_dayofweek")
        .agg(
            F.round(F.avg(fare), 6).alias("avg_fare"),
            F.round(F.avg(F.when(clean, fare)), 6).alias("avg_fare_clean"),
            F.count(F.lit(1)).alias("n_trips"),
            F.count_if(clean).alias("n_clean"),
        )
        .select("pickup_dayofweek", day_name(F.col("pickup_dayofweek"), roles).alias("day_name"), "avg_fare", "avg_fare_clean", "n_trips", "n_clean")
    )


CORR_PAIRS = (
    ("distance_fare", "trip_distance", "fare_amount"),
    ("duration_distance", "trip_duration_min", "trip_distance"),
    ("fare_discrepancy", "fare_amount", "fare_discrepancy"),
)


def pair_correlations(flagged: DataFrame) -> DataFrame:
    """Pearson correlation per pair, all rows and clean rows, one pass."""
    clean = is_clean()
    aggs = []
    for name, x, y in CORR_PAIRS:
        xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
        aggs.append(F.corr(xd, yd).alias(f"{name}__all"))
        aggs.append(F.corr(F.when(clean, xd), F.when(clean, yd)).alias(f"{name}__clean"))
    wide = flagged.agg(*aggs)
    rows = [
        F.struct(F.lit(name).alias("pair"), F.round(F.col(f"{name}__all"), 6).alias("corr_all"), F.round(F.col(f"{name}__clean"), 6).alias("corr_clean"))
        for name, _, _ in CORR_PAIRS
    ]
    return wide.select(F.inline(F.array(*rows)))


RANKED_RULES = (
    (1, "distance_speed", "(flag_impossible_distance = 1 OR flag_impossible_speed = 1)"),
    (2, "negative_money", "flag_negative_money = 1"),
    (3, "fare_discrepancy", "flag_high_discrepancy = 1"),
    (4, "extreme_duration", "flag_extreme_duration = 1"),
    (5, "extreme_tip", "flag_extreme_tip = 1"),
)


def anomaly_ranking(flagged: DataFrame) -> DataFrame:
    """Rows per problem, in the priority order of the written summary."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.count_if(F.expr(cond)).alias(f"r{p}") for p, _, cond in RANKED_RULES]
    wide = flagged.agg(*aggs)
    rows = [
        F.struct(
            F.lit(p).alias("priority"),
            F.lit(name).alias("rule"),
            F.col(f"r{p}").alias("n_rows"),
            F.round(F.col(f"r{p}") / F.col("__n"), 6).alias("share"),
        )
        for p, name, _ in RANKED_RULES
    ]
    return wide.select(F.inline(F.array(*rows))).orderBy("priority")
