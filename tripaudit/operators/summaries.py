"""Sanity checks and temporal summaries (A1-A5).

Each is one aggregate over the featured trips: a global aggregate (partial
per task, one tiny final merge) or a group-by on a key with at most 24
values, so the shuffle carries a handful of rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_ROLES, TripRoles
from .features import flag_columns

CHECKED_FOR_NULLS = ("trip_duration_min", "avg_speed_mph", "fare_discrepancy")


def _q(name: str):
    return F.col(f"`{name}`")


def null_counts(df: DataFrame, columns: tuple[str, ...] = CHECKED_FOR_NULLS) -> DataFrame:
    """A1: nulls per column, one pass, unpivoted to (column, n_null)."""
    cols = [c for c in columns if c in df.columns]
    wide = df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null").select("column", F.col("n_null").cast("bigint"))


def negative_durations(df: DataFrame) -> DataFrame:
    """A2: number of trips whose duration is below zero."""
    return df.agg(F.count_if(F.col("trip_duration_min") < 0).cast("bigint").alias("n_negative"))


def flag_domains(df: DataFrame) -> DataFrame:
    """A3: the values each ``is_*`` column takes, with counts (must be {0, 1})."""
    flags = flag_columns(df)
    long = df.select(*flags).unpivot([], flags, "flag", "value")
    return long.groupBy("flag", "value").agg(F.count(F.lit(1)).alias("n_rows"))


def trips_by_hour(df: DataFrame) -> DataFrame:
    """A4: non-null durations per pickup hour; rows without an hour dropped."""
    return (
        df.where(F.col("pickup_hour").isNotNull())
        .groupBy("pickup_hour")
        .agg(F.count("trip_duration_min").alias("n_trips"))
        .orderBy("pickup_hour")
    )


def day_name(col, roles: TripRoles = DEFAULT_ROLES):
    """Monday = 0 ... Sunday = 6 -> name, through a literal map."""
    m = F.create_map(*[x for i, n in enumerate(roles.day_names) for x in (F.lit(i), F.lit(n))])
    return F.element_at(m, col.cast("int"))


def fare_by_weekday(df: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """A5: mean fare per pickup weekday (NULL fares ignored), in weekday order."""
    return (
        df.where(F.col("pickup_dayofweek").isNotNull())
        .groupBy("pickup_dayofweek")
        .agg(F.round(F.avg(F.col("fare_amount").cast("double")), 6).alias("avg_fare"))
        .select("pickup_dayofweek", day_name(F.col("pickup_dayofweek"), roles).alias("day_name"), "avg_fare")
        .orderBy("pickup_dayofweek")
    )
