"""Registered results: conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import oracle as O
from ..chain import conformed_trips, plan_for, trips
from ..config import DEFAULT_ROLES
from ..operators import conform as C
from ..operators.conform import parse_timestamp
from ..operators.features import add_features
from ..operators.formats import chosen_formats, format_uses, uses_frame
from ..plans.profile import build_plan, normalise_nan
from ..plans.store import plan_from_profiles, read_plan, read_profiles, update_profiles, write_plan
from ..session import scratch_path
from ..sources.files import period_file
from ..sources.fixture import KEYS, read_table, with_string_times
from ..sources.sink import SOURCE
from . import KEYS_SQL, presentable, register

DROPPED = ", ".join(DEFAULT_ROLES.columns_to_drop)


@register("drop_columns", O.with_base(f"SELECT * EXCLUDE ({DROPPED}) FROM trips"))
def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_columns(normalise_nan(trips(spark, sf_dir)))


@register("drop_null_columns", O.with_base(f"SELECT * EXCLUDE ({DROPPED}, airport_fee) FROM trips"))
def q_drop_null_columns(spark, sf_dir):
    plan = plan_for(spark, sf_dir)
    return C.drop_null_columns(C.drop_columns(normalise_nan(trips(spark, sf_dir))), plan)


_TS_SQL = (
    "TRY_CAST(CASE WHEN l_orderkey % 31 = 0 THEN 'not a time' "
    "ELSE strftime(lpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS tpep_pickup_datetime, "
    "TRY_CAST(strftime(lpep_dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS tpep_dropoff_datetime"
)


@register("parse_timestamps", O.with_base(f"SELECT {KEYS_SQL}, {_TS_SQL} FROM trips"))
def q_parse_timestamps(spark, sf_dir):
    df = with_string_times(trips(spark, sf_dir))
    return C.parse_timestamps(df).select(*KEYS, "tpep_pickup_datetime", "tpep_dropoff_datetime")


_BAD = "l_orderkey % 31 = 0"


@register("string_pickups", O.with_base(
    f"SELECT {KEYS_SQL}, CASE WHEN NOT ({_BAD}) THEN trip_duration_min END AS trip_duration_min, "
    f"CAST(CASE WHEN NOT ({_BAD}) THEN pickup_hour END AS DOUBLE) AS pickup_hour, CAST(CASE WHEN NOT ({_BAD}) THEN pickup_dayofweek END AS DOUBLE) AS pickup_dayofweek FROM feat"))
def q_string_pickups(spark, sf_dir):
    """Pickup and dropoff times as text, some of it bad: parsed, and null in what derives from them."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    df = trips(spark, sf_dir).withColumns({
        "lpep_pickup_datetime": F.when(F.expr(_BAD), F.lit("not a time")).otherwise(F.date_format("lpep_pickup_datetime", fmt)),
        "lpep_dropoff_datetime": F.date_format("lpep_dropoff_datetime", fmt),
    })
    feat = add_features(C.parse_timestamps(df), only=("trip_duration", "time_features"))
    return presentable(feat.select(*KEYS, "trip_duration_min", "pickup_hour", "pickup_dayofweek"), ("pickup_hour", "pickup_dayofweek"))


_HALF = "l_orderkey % 2 = 0"
_ODD_PASSENGERS = "CASE WHEN l_orderkey % 7 = 1 THEN 1.5 WHEN l_orderkey % 11 = 1 THEN 300.0 ELSE passenger_count END"


@register("guarded_casts", O.with_base(
    f"SELECT {KEYS_SQL}, CASE WHEN p IN (1.5, 300.0) THEN NULL ELSE CAST(p AS DOUBLE) END AS passenger_count, "
    f"CASE WHEN p = 1.5 THEN '1.5' WHEN p = 300.0 THEN '300.0' END AS rejected FROM (SELECT *, {_ODD_PASSENGERS} AS p FROM trips WHERE NOT ({_HALF}))"))
def q_guarded_casts(spark, sf_dir):
    """A plan made from one half of the data meets values in the other half that do not fit it."""
    df = trips(spark, sf_dir)
    plan = build_plan(df.where(_HALF))
    other = df.where(f"NOT ({_HALF})").withColumn("passenger_count", F.expr(_ODD_PASSENGERS).cast("double"))
    out = C.apply_plan(other, plan, rejects=C.REJECTS)
    return presentable(out.select(*KEYS, "passenger_count", F.col(C.REJECTS)["passenger_count"].alias("rejected")), ("passenger_count",))


@register("wide_category_codes",
    "SELECT l_partkey * 100003 + l_orderkey AS value, CAST(dense_rank() OVER (ORDER BY l_partkey * 100003 + l_orderkey) - 1 AS INTEGER) AS code, count(*) AS n_rows "
    "FROM lineitem GROUP BY l_partkey * 100003 + l_orderkey")
def q_wide_category_codes(spark, sf_dir):
    """Codes of a column with about as many values as rows (over 65,536 from sf0.1 on)."""
    df = read_table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 100003 + F.col("l_orderkey")).alias("value"))
    return C.category_codes(df, "value")


# (column, target) pairs probed on lineitem and on trips: every verdict arm
LINEITEM_PAIRS = (
    ("l_quantity", "Int8"),
    ("l_extendedprice", "Int8"),
    ("l_extendedprice", "int16"),
    ("l_orderkey", "int16"),
    ("l_extendedprice", "float32"),
    ("l_discount", "float32"),
    ("l_linenumber", "Int8"),
    ("l_partkey", "int16"),
    ("l_tax", "Int8"),
    ("l_not_a_column", "Int8"),
)
TRIPS_PAIRS = (
    ("passenger_count", "Int8"),
    ("passenger_count", "int16"),
    ("RatecodeID", "int16"),
    ("PULocationID", "Int8"),
    ("fare_amount", "int16"),
    ("trip_distance", "Int8"),
    ("total_amount", "float32"),
)


def _verdict_rows(spark, df, table, pairs):
    roles = DEFAULT_ROLES.with_(narrow_targets=pairs, columns_to_drop=(), categorical_columns=())
    plan = build_plan(df, roles)
    return C.cast_verdicts_frame(spark, plan).select(F.lit(table).alias("tbl"), "*")


@register(
    "cast_verdicts",
    "WITH " + O.TRIPS + "\n"
    + O.cast_verdicts_sql("lineitem", O.LINEITEM_SCHEMA, LINEITEM_PAIRS)
    + "\nUNION ALL " + O.cast_verdicts_sql("trips", O.TRIPS_SCHEMA, TRIPS_PAIRS),
)
def q_cast_verdicts(spark, sf_dir):
    a = _verdict_rows(spark, read_table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_PAIRS)
    b = _verdict_rows(spark, trips(spark, sf_dir), "trips", TRIPS_PAIRS)
    return a.unionByName(b)


def _narrowed_sql() -> str:
    targets = dict(DEFAULT_ROLES.narrow_targets)
    parts = []
    for c, t in O.TRIPS_SCHEMA:
        if c in DEFAULT_ROLES.columns_to_drop:
            parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS type_before, CAST(NULL AS VARCHAR) AS type_after, 'dropped_by_name' AS verdict")
            continue
        inner = O.verdict_sql(c, targets[c]) if c in targets else "'unchanged'"
        after = f"'{O.TARGET_TYPE[targets[c]]}'" if c in targets else f"'{t}'"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS type_before, CASE WHEN v = 'dropped_all_null' THEN NULL "
            f"WHEN v = 'converted' THEN {after} ELSE '{t}' END AS type_after, v AS verdict "
            f"FROM (SELECT CASE WHEN count({c}) = 0 AND count(*) > 0 THEN 'dropped_all_null' ELSE {inner} END AS v FROM trips)"
        )
    return "WITH " + O.TRIPS + "\n" + "\nUNION ALL ".join(parts)


@register("narrowed_types", _narrowed_sql())
def q_narrowed_types(spark, sf_dir):
    plan = plan_for(spark, sf_dir)
    before = trips(spark, sf_dir)
    return C.type_changes(spark, before, conformed_trips(spark, sf_dir), plan)


@register("cardinality_ratio", O.with_base(
    "SELECT 'payment_type' AS \"column\", count(DISTINCT payment_type) AS n_distinct, count(*) AS n_rows, "
    "count(DISTINCT payment_type) / count(*) AS ratio, "
    "CASE WHEN count(DISTINCT payment_type) / count(*) < 0.005 THEN 'categorical' ELSE 'kept' END AS verdict "
    "FROM conformed"))
def q_cardinality_ratio(spark, sf_dir):
    return C.cardinality_frame(spark, plan_for(spark, sf_dir))


@register("category_codes", O.with_base(
    "SELECT CAST(payment_type AS DOUBLE) AS payment_type, "
    "CAST(CASE WHEN payment_type IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY payment_type) - 1 END AS INTEGER) AS code, "
    "n_rows FROM (SELECT payment_type, count(*) AS n_rows FROM conformed GROUP BY payment_type)"))
def q_category_codes(spark, sf_dir):
    plan = plan_for(spark, sf_dir)
    return presentable(C.category_codes(conformed_trips(spark, sf_dir), "payment_type", plan))


CONFORMED_TYPES = dict(
    [(c, t) for c, t in O.TRIPS_SCHEMA]
    + [(c, O.TARGET_TYPE[t]) for c, t in DEFAULT_ROLES.narrow_targets]
)
CONFORMED_COLUMNS = [c for c, _ in O.TRIPS_SCHEMA if c not in DEFAULT_ROLES.columns_to_drop and c != "airport_fee"]


def _bytes_sql(c: str, t: str) -> str:
    if t == "string":
        return f"CAST(coalesce(sum(strlen({c})), 0) AS BIGINT)"
    return f"CAST(count(*) * {O.DEFAULT_SIZE[t]} AS BIGINT)"


def _footprint_sql() -> str:
    parts = []
    for i, (c, t) in enumerate(O.TRIPS_SCHEMA):
        if c in CONFORMED_COLUMNS:
            ta = CONFORMED_TYPES[c]
            after = f"'{ta}' AS type_after, {_bytes_sql(c, ta)} AS bytes_after"
        else:
            after = "CAST(NULL AS VARCHAR) AS type_after, CAST(0 AS BIGINT) AS bytes_after"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type_before, "
            f"{_bytes_sql(c, t)} AS bytes_before, {after} FROM trips"
        )
    return "WITH " + O.TRIPS + "\n" + "\nUNION ALL ".join(parts)


@register("column_footprint", _footprint_sql())
def q_column_footprint(spark, sf_dir):
    return C.column_footprint(spark, trips(spark, sf_dir), conformed_trips(spark, sf_dir))


def _report_sql() -> str:
    before = " + ".join(_bytes_sql(c, t) for c, t in O.TRIPS_SCHEMA)
    after = " + ".join(_bytes_sql(c, CONFORMED_TYPES[c]) for c in CONFORMED_COLUMNS)
    return (
        "WITH " + O.TRIPS + ",\nsizes AS (SELECT CAST(" + before + " AS DOUBLE) / 1048576 AS b, CAST(" + after
        + " AS DOUBLE) / 1048576 AS a, count(*) AS n FROM trips)\n"
        "SELECT round(b, 2) AS before_mb, round(a, 2) AS after_mb, "
        "round(CASE WHEN b > 0 THEN (1 - a / b) * 100 ELSE 0 END, 2) AS reduction_percent, "
        f"n AS rows, CAST({len(CONFORMED_COLUMNS)} AS BIGINT) AS columns FROM sizes"
    )


@register("footprint_report", _report_sql())
def q_footprint_report(spark, sf_dir):
    return C.footprint_report(spark, trips(spark, sf_dir), conformed_trips(spark, sf_dir))


_NULLABLE = ("passenger_count", "RatecodeID", "payment_type")


@register("conformed_trips", O.with_base(
    "SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NULLABLE) + ") FROM conformed"))
def q_conformed_trips(spark, sf_dir):
    return presentable(conformed_trips(spark, sf_dir), _NULLABLE)


# D3: texts in several formats, some of which two of them read differently, and some that none reads
_TEXTS = (
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S", "l_orderkey % 5 IN (0, 1)"),
    ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S", "l_orderkey % 5 = 2"),
    ("dd.MM.yyyy HH:mm", "%d.%m.%Y %H:%M", "l_orderkey % 5 = 3"),
)
_DAY_FIRST = ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S")
_MIXED_SQL = (
    "mixed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE " + " ".join(f"WHEN {when} THEN strftime(lpep_pickup_datetime, '{c}')" for _, c, when in _TEXTS)
    + " WHEN l_linenumber = 1 THEN 'no time' END AS t FROM trips)"
)


def _mixed_times(spark, sf_dir):
    df = trips(spark, sf_dir)
    text = F.when(F.expr("l_orderkey % 5 = 4 AND l_linenumber = 1"), "no time")
    for fmt, _, when in _TEXTS:
        text = text.when(F.expr(when), F.date_format("lpep_pickup_datetime", fmt))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("t"))


def _uses(spark, sf_dir):
    df = _mixed_times(spark, sf_dir)
    return df, format_uses(df, ("t",), tuple(f for f, _, _ in _TEXTS) + (_DAY_FIRST[0],))


@register("timestamp_formats", O.with_base("").rstrip() + ",\n" + _MIXED_SQL + ",\n" + "read AS (SELECT t, "
    + ", ".join(f"try_strptime(t, '{c}') AS f{i}" for i, c in enumerate([c for _, c, _ in _TEXTS] + [_DAY_FIRST[1]])) + " FROM mixed)\n"
    + " UNION ALL ".join(
        f"SELECT 't' AS \"column\", '{f}' AS format, count(t) AS n_values, count(f{i}) AS n_parsed, " + ("count(*) FILTER (f1 <> f3)" if i == 3 else "0") + " AS n_conflicts FROM read"
        for i, f in enumerate([f for f, _, _ in _TEXTS] + [_DAY_FIRST[0]])))
def q_timestamp_formats(spark, sf_dir):
    """What each candidate parses; the day-first one reads some month-first times as others."""
    return uses_frame(spark, _uses(spark, sf_dir)[1]).drop("rank")


@register("mixed_timestamps", O.with_base("").rstrip() + ",\n" + _MIXED_SQL + "\nSELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce("
    + ", ".join(f"try_strptime(t, '{c}')" for _, c, _ in _TEXTS) + ") AS picked_up FROM mixed")
def q_mixed_timestamps(spark, sf_dir):
    """The column parsed in the formats that its own values chose."""
    df, uses = _uses(spark, sf_dir)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parse_timestamp(F.col("t"), chosen_formats(uses, "t")).alias("picked_up"))


@register("merged_verdicts", "WITH " + O.TRIPS + "\n" + O.cast_verdicts_sql("trips", O.TRIPS_SCHEMA, DEFAULT_ROLES.narrow_targets))
def q_merged_verdicts(spark, sf_dir):
    """Cast verdicts of the plan that is merged from the months' own profiles, the last month's added later, stored and read back."""
    by_month = trips(spark, sf_dir).withColumn(SOURCE, period_file(F.col("lpep_pickup_datetime")))
    last = by_month.agg(F.max(SOURCE)).first()[0]
    path = scratch_path(spark, "profiles")
    update_profiles(by_month.where(F.col(SOURCE) != last), path)
    update_profiles(by_month.where(F.col(SOURCE) == last), path, sources=[last])
    write_plan(spark, plan_from_profiles(*read_profiles(spark, path)), f"{path}/plan.json")
    plan = read_plan(spark, f"{path}/plan.json")
    return C.cast_verdicts_frame(spark, plan).select(F.lit("trips").alias("tbl"), "*")
