"""Read -> conform -> derive, for a scale-factor directory of given tables.

The ``trips`` view is derived from ``lineitem`` and written once per session
as a Parquet table under the shared folder: that plays the part of the
monthly trip files landing in storage (and keeps the generated code of later
stages small). Profiling runs once on it; the conformed and featured trips
are then written once as the engine's output table, and every summary reads
only the columns it needs from that table (column pruning at the scan).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession

from .config import DEFAULT_ROLES, TripRoles
from .operators.conform import apply_plan
from .operators.distributions import numeric_stat_exprs, numeric_stats, stats_from_row
from .operators.features import add_features
from .plans.profile import ConformPlan, build_plan, distinct_aggregates, plan_from_profile, profile_aggregates
from .session import ON_RELEASE, scratch_path, session_key
from .sources.fixture import read_table, sources_of_trips, trips_from_lineitem

_LOCK = threading.RLock()  # one writer per table even if results are built from several threads
_PLANS: dict[tuple, ConformPlan] = {}
_TABLES: dict[tuple, DataFrame] = {}
_STATS: dict[tuple, dict] = {}
ON_RELEASE.extend((_TABLES.clear, _STATS.clear))


def ensure_parallel(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    Large inputs already come in many splits and are left alone; a small file
    with one row group would otherwise keep every later stage on one core.
    """
    sc = df.sparkSession.sparkContext
    want = sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def _materialize(spark: SparkSession, key: tuple, name: str, build, observe=None) -> DataFrame:
    """Write ``build()`` once under the shared folder and keep the read handle.

    ``observe(df) -> (df, callback)`` may attach aggregates that are collected
    as observed metrics of that same write (no extra pass).
    """
    with _LOCK:
        if key not in _TABLES:
            path = scratch_path(spark, name)
            df = build()
            done = None
            if observe is not None:
                df, done = observe(df)
            df.write.mode("overwrite").parquet(path)
            if done is not None:
                done()
            _TABLES[key] = spark.read.parquet(path)
        return _TABLES[key]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ``trips`` table for a scale-factor directory (written once).

    The conformance profile of the default roles is observed while it is
    written; only the exact distinct count of the categorical columns needs
    its own (single-column) scan.
    """
    key = ("trips", session_key(spark), sf_dir.rstrip("/"))
    pkey = (session_key(spark), sf_dir.rstrip("/"), DEFAULT_ROLES)
    box: dict = {}

    def observe(df):
        obs = Observation(f"conform_profile_{len(_TABLES)}")
        watched = df.observe(obs, *profile_aggregates(df, DEFAULT_ROLES))

        def done():
            box["row"] = obs.get

        return watched, done

    built = _materialize(
        spark, key, "trips", lambda: trips_from_lineitem(ensure_parallel(read_table(spark, sf_dir, "lineitem"))), observe
    )
    with _LOCK:
        if "row" in box and pkey not in _PLANS:
            row = dict(box["row"])
            d = distinct_aggregates(built, DEFAULT_ROLES)
            if d:
                row.update(built.agg(*d).collect()[0].asDict())
            _PLANS[pkey] = plan_from_profile(built, DEFAULT_ROLES, row)
    return built


def trip_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``trips`` is made from, with the pickup times: rows for ``trips_from_lineitem`` to widen where they are written."""
    return sources_of_trips(ensure_parallel(read_table(spark, sf_dir, "lineitem")))


def plan_for(spark: SparkSession, sf_dir: str, roles: TripRoles = DEFAULT_ROLES) -> ConformPlan:
    key = (session_key(spark), sf_dir.rstrip("/"), roles)
    df = trips(spark, sf_dir)
    with _LOCK:
        if key not in _PLANS:
            _PLANS[key] = build_plan(df, roles)
        return _PLANS[key]


def conformed_trips(spark: SparkSession, sf_dir: str, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    plan = plan_for(spark, sf_dir, roles)
    return apply_plan(trips(spark, sf_dir), plan, roles)


def featured_trips(spark: SparkSession, sf_dir: str, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """Conformed trips plus the derived columns, written once, read pruned.

    The numeric profile of the EDA columns (count, min, max, stddev and
    approximate quartile brackets) is observed during that same write, so
    the distribution summaries need no separate statistics pass.
    """
    key = ("featured", session_key(spark), sf_dir.rstrip("/"), roles)

    def observe(df):
        cols = [c for c in roles.eda_numeric if c in df.columns]
        obs = Observation(f"numeric_profile_{len(_STATS)}")
        watched = df.observe(obs, *numeric_stat_exprs(cols))

        def done():
            _STATS[key] = stats_from_row(cols, obs.get)

        return watched, done

    df = _materialize(spark, key, "featured", lambda: add_features(conformed_trips(spark, sf_dir, roles), roles), observe)
    if key not in _STATS:  # table written by an earlier call without observation
        _STATS[key] = numeric_stats(df, roles.eda_numeric)
    return df


def numeric_profile(spark: SparkSession, sf_dir: str, roles: TripRoles = DEFAULT_ROLES) -> dict:
    """Per EDA column: n, min, max, sd, approximate quartile brackets."""
    featured_trips(spark, sf_dir, roles)
    return _STATS[("featured", session_key(spark), sf_dir.rstrip("/"), roles)]


__all__ = ["trips", "trip_sources", "plan_for", "conformed_trips", "featured_trips", "numeric_profile", "ensure_parallel"]
