"""Registered results: monthly files, audit, reads, sampling, streaming.

The monthly files are derived from the given tables: the ``trips`` view is
exported once per session into monthly files under the shared folder
(``export_monthly``: one distributed write), and the file operators run on
that export.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from .. import oracle as O
from ..chain import _LOCK, plan_for, trip_sources, trips
from ..config import DEFAULT_ROLES as R
from ..session import ON_RELEASE, scratch_path, session_key
from ..sources import files as FS
from ..sources.fixture import trips_from_lineitem
from ..sources.sample import sample_rows
from ..operators.batch_summaries import merged_summaries
from ..operators.conform import REJECTS, apply_plan
from ..operators.features import add_features
from ..operators.summaries import CHECKED_FOR_NULLS
from ..sources.sink import export_monthly, read_trips, write_trips
from ..streaming import ledger as L
from ..streaming.ingest import FILE_KEY, ingest_files, run_incremental_ingest, take_outstanding
from . import register

PICKUP = "lpep_pickup_datetime"
_EXPORTS: dict = {}
ON_RELEASE.append(_EXPORTS.clear)

_NAME_SQL = "printf('green_tripdata_%d-%02d.parquet', year(lpep_pickup_datetime), month(lpep_pickup_datetime))"


def monthly(spark, sf_dir) -> FS.MonthlyLayout:
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _EXPORTS:
            tag = hashlib.sha1(key[1].encode()).hexdigest()[:8]
            root = scratch_path(spark, f"monthly-{tag}")
            _EXPORTS[key] = export_monthly(trip_sources(spark, sf_dir), root, PICKUP, R, trips_from_lineitem)
        return _EXPORTS[key]


def _names(spark, sf_dir) -> list[str]:
    return [r["file_name"] for r in FS.periods_in_data(trips(spark, sf_dir), PICKUP, R).collect()]


@register("period_files", O.with_base(
    f"SELECT DISTINCT 'green' AS taxi_type, CAST(year(lpep_pickup_datetime) AS INTEGER) AS year, "
    f"CAST(month(lpep_pickup_datetime) AS INTEGER) AS month, {_NAME_SQL} AS file_name FROM trips"))
def q_period_files(spark, sf_dir):
    return FS.periods_in_data(trips(spark, sf_dir), PICKUP, R)


def _audit_periods(spark, sf_dir) -> list[str]:
    yr = trips(spark, sf_dir).agg(F.min(F.year(PICKUP)).alias("a"), F.max(F.year(PICKUP)).alias("b")).collect()[0]
    roles = R.with_(year_start=int(yr["a"]), year_end=int(yr["b"]))
    return [roles.file_name(y, m) for y, m in roles.periods()]


@register("file_audit", O.with_base(
    "SELECT printf('green_tripdata_%d-%02d.parquet', y, m) AS file_name, p.n IS NOT NULL AS \"exists\", false AS is_file, "
    "CAST(CASE WHEN p.n IS NOT NULL THEN 26 ELSE 0 END AS INTEGER) AS n_columns, "
    "CASE WHEN p.n IS NOT NULL THEN 'ok' ELSE 'missing' END AS status, CAST(NULL AS VARCHAR) AS error "
    "FROM (SELECT unnest(range(CAST(min(year(lpep_pickup_datetime)) AS BIGINT), CAST(max(year(lpep_pickup_datetime)) AS BIGINT) + 1)) AS y FROM trips) ys "
    "CROSS JOIN (SELECT unnest(range(1, 13)) AS m) ms "
    "LEFT JOIN (SELECT year(lpep_pickup_datetime) AS py, month(lpep_pickup_datetime) AS pm, count(*) AS n FROM trips GROUP BY 1, 2) p "
    "ON p.py = ys.y AND p.pm = ms.m"))
def q_file_audit(spark, sf_dir):
    layout = monthly(spark, sf_dir)
    checks = FS.audit_files(spark, layout, _audit_periods(spark, sf_dir))
    return FS.audit_frame(spark, checks).drop("path", "bytes")  # engine-specific, not compared


_SCHEMA_VALUES = ", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(O.TRIPS_SCHEMA))


@register("file_columns", O.with_base(
    f"SELECT f.file_name, CAST(s.position AS INTEGER) AS position, s.\"column\", s.type FROM "
    f"(SELECT DISTINCT {_NAME_SQL} AS file_name FROM trips) f CROSS JOIN (VALUES {_SCHEMA_VALUES}) AS s(position, \"column\", type)"))
def q_file_columns(spark, sf_dir):
    layout = monthly(spark, sf_dir)
    return FS.columns_frame(spark, FS.audit_files(spark, layout, _names(spark, sf_dir)))


_FIRST_MONTH_SQL = "(SELECT min(strftime(lpep_pickup_datetime, '%Y-%m')) FROM trips)"


@register("read_month", O.with_base(
    f"SELECT * FROM trips WHERE strftime(lpep_pickup_datetime, '%Y-%m') = {_FIRST_MONTH_SQL}"))
def q_read_month(spark, sf_dir):
    layout = monthly(spark, sf_dir)
    first = trips(spark, sf_dir).agg(F.min(PICKUP).alias("t")).collect()[0]["t"]
    return FS.read_month(spark, layout, first.year, first.month, R)


@register("read_all_periods", O.with_base(f"SELECT *, {_NAME_SQL} AS source_file FROM trips"))
def q_read_all_periods(spark, sf_dir):
    return FS.read_all(spark, monthly(spark, sf_dir), _names(spark, sf_dir), R)


@register("load_counts", O.with_base(
    f"SELECT {_NAME_SQL} AS source_file, count(*) AS n_rows, CAST(26 AS INTEGER) AS n_columns FROM trips GROUP BY 1"))
def q_load_counts(spark, sf_dir):
    layout = monthly(spark, sf_dir)
    checks = FS.audit_files(spark, layout, _names(spark, sf_dir))
    return FS.load_counts(FS.read_checked(spark, layout, checks), checks)


_UNKNOWN = "l_orderkey % 37 = 0"


@register("unknown_period_counts", O.with_base(
    f"SELECT CASE WHEN {_UNKNOWN} THEN 'green_tripdata_unknown.parquet' ELSE {_NAME_SQL} END AS source_file, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE NOT {_UNKNOWN}) AS n_pickups FROM trips GROUP BY 1"))
def q_unknown_period_counts(spark, sf_dir):
    """Trips of which some have no pickup time: exported, listed and read back whole."""
    def lost(df):
        return df.withColumn(PICKUP, F.when(~F.expr(_UNKNOWN), F.col(PICKUP)))

    df = lost(trips(spark, sf_dir))
    layout = export_monthly(lost(trip_sources(spark, sf_dir)), scratch_path(spark, "unknown"), PICKUP, R, lambda li: lost(trips_from_lineitem(li)))
    names = [r["file_name"] for r in FS.periods_in_data(df, PICKUP, R).select("file_name").collect()]
    return FS.read_all(spark, layout, names, R).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), F.count(PICKUP).alias("n_pickups"))


@register("file_listing", O.with_base(f"SELECT DISTINCT {_NAME_SQL} AS file_name, true AS has_parts, true AS has_bytes, true AS dated FROM trips"))
def q_file_listing(spark, sf_dir):
    """Names and presence; the bytes, parts and times themselves differ from run to run."""
    listing = FS.file_listing(spark, monthly(spark, sf_dir))
    return listing.select("file_name", (F.col("n_parts") > 0).alias("has_parts"), (F.col("bytes") > 0).alias("has_bytes"), F.col("modified").isNotNull().alias("dated"))


@register("written_trips", O.with_base(f"SELECT {_NAME_SQL} AS source_file, count(*) AS n_rows, CAST(sum(pickup_month) AS BIGINT) AS sum_month FROM feat GROUP BY 1"))
def q_written_trips(spark, sf_dir):
    """The trip table after three runs: two that hold different files, and the first once more."""
    layout, names = monthly(spark, sf_dir), sorted(_names(spark, sf_dir))
    path = scratch_path(spark, "written")
    for part in (names[::2], names[1::2], names[::2]):
        if part:
            raw = FS.read_all(spark, layout, part, R)
            write_trips(add_features(apply_plan(raw, plan_for(spark, sf_dir), R), R), path, by_file=True)
    return read_trips(spark, path).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("pickup_month").cast("bigint")).alias("sum_month"))


_SAMPLE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@register("row_sample", O.with_base(
    "SELECT * FROM trips ORDER BY md5(concat_ws('|', '42', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in _SAMPLE_KEYS) + ")) LIMIT 3"))
def q_row_sample(spark, sf_dir):
    return sample_rows(trips(spark, sf_dir), 3, seed=42, keys=_SAMPLE_KEYS)


_DRIFT = "year(lpep_pickup_datetime) = 1996 AND month(lpep_pickup_datetime) = 3"
_HALF = "l_orderkey % 7 = 0"
_CASH = "l_orderkey % 5 = 0"


def _drifting(spark, sf_dir, columns):
    """The monthly export, but for one month: that lacks a column, has passengers as whole numbers and other ``columns``."""
    df = trips(spark, sf_dir)
    root = scratch_path(spark, "drifting")
    export_monthly(trip_sources(spark, sf_dir).where(f"NOT ({_DRIFT})"), root, PICKUP, R, trips_from_lineitem)
    odd = df.where(_DRIFT).drop("cbd_congestion_fee").withColumns({"passenger_count": F.col("passenger_count").cast("bigint"), **columns})
    odd.write.parquet(f"{root}/file={R.file_name(1996, 3)}")
    return df, FS.MonthlyLayout(root)


def _ingested(spark, sf_dir):
    """At least four batches over the monthly files, in one of which some zones are no whole numbers."""
    key = ("ingested", session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _EXPORTS:
            df, layout = _drifting(spark, sf_dir, {"PULocationID": F.col("PULocationID").cast("double") + F.when(F.expr(_HALF), 0.5).otherwise(0.0)})
            sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
            files = FS.file_listing(spark, layout).agg(F.sum("n_parts")).first()[0]
            run_incremental_ingest(
                spark, layout.root, df.schema, plan_for(spark, sf_dir), sink, ckpt, R, max_files_per_trigger=max(1, files // 4), timeout_s=1800, summaries=f"{sink}-summaries"
            )
            _EXPORTS[key] = sink
    return _EXPORTS[key]


_ZONE = f"CASE WHEN {_DRIFT} AND {_HALF} THEN NULL ELSE PULocationID END"


@register("incremental_ingest", O.with_base(
    "SELECT * REPLACE (CAST(payment_type AS DOUBLE) AS payment_type, CAST(PULocationID AS DOUBLE) AS PULocationID, CASE WHEN " + _DRIFT + " THEN NULL ELSE cbd_congestion_fee END AS cbd_congestion_fee), "
    + _NAME_SQL + " AS source_file FROM feat", trips=f"SELECT * REPLACE ({_ZONE} AS PULocationID) FROM trips_raw"))
def q_incremental_ingest(spark, sf_dir):
    return spark.read.parquet(_ingested(spark, sf_dir)).drop(FILE_KEY, REJECTS).withColumns({c: F.col(c).cast("double") for c in ("payment_type", "PULocationID")})


@register("ingest_rejects", O.with_base(
    f"SELECT 'PULocationID' AS \"column\", CAST(PULocationID + 0.5::DOUBLE AS VARCHAR) AS value, count(*) AS n_rows FROM trips WHERE {_DRIFT} AND {_HALF} GROUP BY 2"))
def q_ingest_rejects(spark, sf_dir):
    """The values that the declared types could not hold, as text."""
    found = spark.read.parquet(_ingested(spark, sf_dir)).where(F.col(REJECTS).isNotNull()).select(F.explode(REJECTS).alias("column", "value"))
    return found.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))


_FLAGS = ("is_invalid_PULocation", "is_invalid_DOLocation", "is_same_zone", "is_zero_passenger", "is_invalid_ratecodeID", "is_invalid_payment", "is_cash_with_tip", "is_free_but_charged")


@register("ingested_summaries", O.with_base(
    " UNION ALL ".join(
        [f"SELECT 'nulls' AS summary, '{c}' AS key, CAST(NULL AS DOUBLE) AS value, count(*) FILTER ({c} IS NULL) AS n, CAST(NULL AS DOUBLE) AS total FROM feat" for c in CHECKED_FOR_NULLS]
        + ["SELECT 'negative', NULL, NULL, count(*) FILTER (trip_duration_min < 0), NULL FROM feat",
           "SELECT 'hour', NULL, pickup_hour, count(trip_duration_min), NULL FROM feat GROUP BY pickup_hour",
           "SELECT 'weekday', NULL, pickup_dayofweek, count(fare_amount), round(sum(CAST(fare_amount AS DOUBLE)), 2) FROM feat GROUP BY pickup_dayofweek"]
        + [f"SELECT 'flag', '{f}', {f}, count(*), NULL FROM feat GROUP BY {f}" for f in _FLAGS]
    ), trips=f"SELECT * REPLACE ({_ZONE} AS PULocationID) FROM trips_raw"))
def q_ingested_summaries(spark, sf_dir):
    """A1-A5 merged from the states that each ingested batch left."""
    merged = merged_summaries(spark.read.parquet(f"{_ingested(spark, sf_dir)}-summaries"))
    return merged.select("summary", "key", F.col("value").cast("double").alias("value"), "n", F.round("total", 2).alias("total"))


@register("read_drifting_periods", O.with_base(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, passenger_count, CASE WHEN {_DRIFT} AND {_CASH} THEN 'cash' ELSE CAST(payment_type AS VARCHAR) END AS payment_type, "
    f"CASE WHEN {_DRIFT} THEN NULL ELSE cbd_congestion_fee END AS cbd_congestion_fee, {_NAME_SQL} AS source_file FROM trips"))
def q_read_drifting_periods(spark, sf_dir):
    """Payment types are numbers in most months and text in one: all of them are kept, as text."""
    df, layout = _drifting(spark, sf_dir, {"payment_type": F.when(F.expr(_CASH), "cash").otherwise(F.col("payment_type").cast("string"))})
    back = FS.read_all(spark, layout, _names(spark, sf_dir), R)
    return back.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "passenger_count", "payment_type", "cbd_congestion_fee", "source_file")


def _replace_files(df, folder: str, files: int) -> None:
    """So many Parquet files of fixed names in a folder, over what was there; rows are dealt over tasks."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    written = scratch_path(spark, "replaced")
    df.repartition(files).write.parquet(written)
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    parts = sorted((s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(written)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for i, part in enumerate(parts):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/all-{i:05d}.parquet")
        fs.delete(path, False)
        fs.rename(part, path)


#: Rows that a replaced file of the ledger's result has at least, where it is one of several.
_REPLACED_ROWS = 100_000


@register("ingest_ledger", O.with_base(
    f"SELECT {_NAME_SQL} AS source_file, 'taken' AS state, {_NAME_SQL} = '{R.file_name(1996, 1)}' AS again, CAST(count(*) AS BIGINT) AS ledger_rows, CAST(count(*) AS BIGINT) AS n_rows FROM trips GROUP BY 1 "
    f"UNION ALL SELECT '{R.unknown_file_name()}', 'rejected', false, 0, 0"))
def q_ingest_ledger(spark, sf_dir):
    """A file that is gone when it is read and comes back, one that is replaced by a longer one, and one that is broken."""
    df, plan = trips(spark, sf_dir), plan_for(spark, sf_dir)
    root, sink, ledger = (scratch_path(spark, f"ledger-{n}") for n in ("files", "sink", "entries"))
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    late, replaced = (f"{root}/file={R.file_name(1996, m)}" for m in (1, 2))
    in_february = "year(lpep_pickup_datetime) = 1996 AND month(lpep_pickup_datetime) = 2"
    export_monthly(trip_sources(spark, sf_dir).where(f"NOT ({in_february})"), root, PICKUP, R, trips_from_lineitem)
    half = df.where(in_february).where(_HALF)
    files = max(1, half.count() // _REPLACED_ROWS)
    _replace_files(half, replaced, files)
    broken = fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/file={R.unknown_file_name()}/part.parquet"))
    broken.writeBytes("this is no table")
    broken.close()
    layout = FS.MonthlyLayout(root)
    listed = FS.part_listing(spark, layout).select("path", "length", F.col("modificationTime").alias("modified")).collect()
    away = jvm.org.apache.hadoop.fs.Path(f"{root}-away")
    fs.rename(jvm.org.apache.hadoop.fs.Path(late), away)
    ingest_files(spark, layout, listed, df.schema, plan, sink, ledger, "first", R)
    fs.rename(away, jvm.org.apache.hadoop.fs.Path(late))
    _replace_files(df.where(in_february), replaced, files)
    take_outstanding(spark, layout, df.schema, plan, sink, ledger, R)
    entries = L.current(L.read_ledger(spark, ledger)).groupBy("source_file").agg(
        F.max("state").alias("state"), (F.max("attempt") > 1).alias("again"), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("ledger_rows")
    )
    rows = spark.read.parquet(sink).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    return entries.join(rows, "source_file", "left").na.fill(0, ["n_rows"])
