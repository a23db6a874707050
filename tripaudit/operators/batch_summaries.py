"""A1-A5 kept up batch by batch (S5: batches are independently processable).

A file's summary state is a small table of counts and sums; the table's
summaries are their merge. States are kept by file, so a file that is ingested
again, after a failure or because it was replaced, counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_ROLES, TripRoles
from .features import flag_columns
from .summaries import CHECKED_FOR_NULLS, day_name

STATE = ("summary", "key", "value", "n", "total")


def _entry(summary: str, key, value, n, total=None):
    none = F.lit(None)
    return F.struct(
        F.lit(summary).alias("summary"), F.lit(key).cast("string").alias("key"), (none if value is None else value).cast("int").alias("value"),
        n.cast("bigint").alias("n"), (none if total is None else total).cast("double").alias("total"),
    )


def summary_states(df: DataFrame, source: str) -> DataFrame:
    """(source, summary, key, value, n, total) of featured trips.

    Two aggregates: by hour and weekday (at most 200 groups a file), and by
    flag value; partial aggregation keeps a large file off single tasks.
    """
    s = F.col(f"`{source}`")
    nulls = [c for c in CHECKED_FOR_NULLS if c in df.columns]
    cube = df.groupBy(s.alias(source), "pickup_hour", "pickup_dayofweek").agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in nulls], F.count_if(F.col("trip_duration_min") < 0).alias("negative"), F.count("trip_duration_min").alias("trips"),
        F.count("fare_amount").alias("fares"), F.sum(F.col("fare_amount").cast("double")).alias("fare"),
    )
    hour, day = F.col("pickup_hour"), F.col("pickup_dayofweek")
    entries = [_entry("nulls", c, None, F.col(f"null_{c}")) for c in nulls] + [_entry("negative", None, None, F.col("negative"))]
    entries += [_entry("hour", None, hour, F.col("trips")), _entry("weekday", None, day, F.col("fares"), F.col("fare"))]
    timed = cube.select(source, F.inline(F.array(*entries)))
    flags = flag_columns(df)
    long = df.select(s.alias(source), *flags).unpivot([source], flags, "key", "value")
    flagged = long.groupBy(source, "key", "value").agg(F.count(F.lit(1)).alias("n"))
    states = timed.unionByName(flagged.select(source, F.lit("flag").alias("summary"), "key", F.col("value").cast("int").alias("value"), "n", F.lit(None).cast("double").alias("total")))
    return states.groupBy(source, "summary", "key", "value").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def merged_summaries(states: DataFrame) -> DataFrame:
    """The states of all files as one."""
    return states.groupBy("summary", "key", "value").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def null_counts(merged: DataFrame) -> DataFrame:
    """A1 of merged states."""
    return merged.where("summary = 'nulls'").select(F.col("key").alias("column"), F.col("n").alias("n_null"))


def negative_durations(merged: DataFrame) -> DataFrame:
    """A2 of merged states."""
    return merged.where("summary = 'negative'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_negative"))


def flag_domains(merged: DataFrame) -> DataFrame:
    """A3 of merged states."""
    return merged.where("summary = 'flag'").select(F.col("key").alias("flag"), "value", F.col("n").alias("n_rows"))


def trips_by_hour(merged: DataFrame) -> DataFrame:
    """A4 of merged states."""
    return merged.where("summary = 'hour' AND value IS NOT NULL").select(F.col("value").alias("pickup_hour"), F.col("n").alias("n_trips")).orderBy("pickup_hour")


def fare_by_weekday(merged: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """A5 of merged states."""
    mean = F.round(F.try_divide("total", "n"), 6)
    rows = merged.where("summary = 'weekday' AND value IS NOT NULL")
    return rows.select(F.col("value").alias("pickup_dayofweek"), day_name(F.col("value"), roles).alias("day_name"), mean.alias("avg_fare")).orderBy("pickup_dayofweek")
