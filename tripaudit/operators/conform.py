"""Conformance: drop, parse, narrow, encode.

Each step is a projection driven by a frozen :class:`ConformPlan`; the
only data pass is the profile in ``tripaudit.plans.profile``. Column order
of the input is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..config import DEFAULT_ROLES, TripRoles
from ..functions.exprs import float_roundtrip_ok, is_numeric
from ..plans.profile import ConformPlan, build_plan, cast_ok, normalise_nan
from ..session import scratch_path


def _q(name: str):
    return F.col(f"`{name}`")


def drop_columns(df: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """Drop the configured columns that are present, keep the rest in order."""
    return df.drop(*[c for c in roles.columns_to_drop if c in df.columns])


def drop_null_columns(df: DataFrame, plan: ConformPlan) -> DataFrame:
    """Drop the columns the profile found entirely null (kept when 0 rows)."""
    return df.drop(*[c for c in plan.dropped_all_null if c in df.columns])


def parse_timestamp(c, formats: tuple[str, ...] = ()):
    """Unparseable -> NULL; optional explicit formats tried in order."""
    plain = c.try_cast("timestamp_ntz")
    if formats:
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats], plain)
    return plain


def parse_timestamps(df: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """D3: string timestamp columns -> TIMESTAMP_NTZ (unparseable: NULL); others untouched.

    Covers the listed columns and every pickup and dropoff candidate."""
    out = []
    for f in df.schema.fields:
        if f.name in roles.timestamp_columns and isinstance(f.dataType, T.StringType):
            out.append(parse_timestamp(_q(f.name), roles.datetime_formats).alias(f.name))
        else:
            out.append(_q(f.name))
    return df.select(*out)


REJECTS = "cast_rejects"


def narrow_types(df: DataFrame, plan: ConformPlan, roles: TripRoles = DEFAULT_ROLES, rejects: str | None = None) -> DataFrame:
    """Cast the columns whose verdict is ``converted``, each value under its own check.

    A frozen plan may meet data it was not made from: a value that fails the
    check of its cast (fractional, out of range, beyond the tolerance) becomes
    NULL, never a truncated number or an error. With ``rejects`` its original
    goes into that column, a map from column to value as text; rows without
    one have NULL there.
    """
    casts, kinds = plan.cast_map(), plan.guarded()
    out, failed = [], []
    for c in df.columns:
        if c not in casts:
            out.append(_q(c))
            continue
        ok = cast_ok(df.schema[c].dataType, _q(c), kinds[c], roles)
        out.append(F.when(ok, _q(c).try_cast(casts[c])).alias(c))
        failed.append(F.when(~ok, F.struct(F.lit(c).alias("key"), _q(c).cast("string").alias("value"))))
    if rejects is not None:
        none = F.lit(None).cast("map<string,string>")
        found = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else None
        out.append((F.when(F.size(found) > 0, F.map_from_entries(found)) if failed else none).alias(rejects))
    return df.select(*out)


def _family(t: T.DataType) -> str:
    if is_numeric(t):
        return "number"
    return "time" if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) else t.typeName()


def guarded(c, own: T.DataType, target: T.DataType, roles: TripRoles = DEFAULT_ROLES):
    """A value cast to another type, and whether that keeps it; NULL keeps.

    Whole numbers and decimals have to come back equal, floats within the
    tolerance of D4; text has to parse; anything may become text. Between
    families without a cast no value is kept.
    """
    families = _family(own), _family(target)
    if families[1] == "string":
        return c.cast(target), F.lit(True)
    if families[0] == "string":
        value = parse_timestamp(c, roles.datetime_formats).cast(target) if families[1] == "time" else c.try_cast(target)
        return value, c.isNull() | value.isNotNull()
    if families[0] != families[1] or families[0] not in ("number", "time"):
        return F.lit(None).cast(target), c.isNull()
    value = c.try_cast(target)
    if isinstance(target, T.FloatType) and families[0] == "number":
        return value, float_roundtrip_ok(c, roles.float_rtol, roles.float_atol)
    return value, c.isNull() | F.coalesce(value.try_cast(own) == c, F.lit(False))


def reject_counts(df: DataFrame, rejects: str = REJECTS) -> DataFrame:
    """Quarantined values by column: rows and distinct values."""
    return (
        df.where(_q(rejects).isNotNull()).select(F.explode(_q(rejects)).alias("column", "value"))
        .groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("value").alias("n_values"))
    )


def apply_plan(df: DataFrame, plan: ConformPlan, roles: TripRoles = DEFAULT_ROLES, rejects: str | None = None) -> DataFrame:
    """D1 -> D2 -> D3 -> D5 as one projection (D6/D7 change no values)."""
    df = normalise_nan(df)
    df = drop_columns(df, roles)
    df = drop_null_columns(df, plan)
    df = parse_timestamps(df, roles)
    return narrow_types(df, plan, roles, rejects)


def conform(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, approx_distinct: bool = False) -> tuple[DataFrame, ConformPlan]:
    plan = build_plan(df, roles, approx_distinct=approx_distinct)
    return apply_plan(df, plan, roles), plan


# ---------------------------------------------------------------------------
# verdict and report tables (small, built from the plan on the driver)
# ---------------------------------------------------------------------------


def cast_verdicts_frame(spark: SparkSession, plan: ConformPlan) -> DataFrame:
    rows = [(v.column, v.target, v.type_before, v.type_after, v.verdict) for v in plan.casts]
    schema = "column string, target string, type_before string, type_after string, verdict string"
    return spark.createDataFrame(rows, schema)


def cardinality_frame(spark: SparkSession, plan: ConformPlan) -> DataFrame:
    rows = [(c.column, c.n_distinct, c.n_rows, float(c.ratio), c.verdict) for c in plan.categories]
    return spark.createDataFrame(rows, "column string, n_distinct bigint, n_rows bigint, ratio double, verdict string")


def category_codes(df: DataFrame, column: str, plan: ConformPlan | None = None) -> DataFrame:
    """Code table of a categorical column, of any size.

    code = rank of the value among the sorted distinct non-null values, from
    0; NULL has code -1. The distinct values are range-partitioned and
    numbered within their partition; the rows of the partitions before (one
    small row each) are added, so no task sees the whole table.
    """
    if plan is not None:
        verdict = {c.column: c for c in plan.categories}.get(column)
        if verdict is None or verdict.verdict != "categorical":
            raise ValueError(f"{column} is not categorical under this plan")
    spark = df.sparkSession
    counts = df.groupBy(_q(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    path = scratch_path(spark, "codes")
    counts.repartitionByRange("value").withColumn("__p", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    known = dealt.where(F.col("value").isNotNull())
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("value")) - 1
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))  # one row for each partition
    offsets = known.groupBy("__p").agg(F.count(F.lit(1)).alias("__n")).select("__p", F.coalesce(before, F.lit(0)).alias("__off"))
    coded = known.withColumn("__r", rank).join(offsets, "__p").select("value", (F.col("__r") + F.col("__off")).cast("int").alias("code"), "n_rows")
    missing = dealt.where(F.col("value").isNull()).select("value", F.lit(-1).alias("code"), "n_rows")
    return coded.union(missing).select(F.col("value").alias(column), "code", "n_rows")


def encode_categories(df: DataFrame, column: str, codes: DataFrame, broadcast_codes: int = DEFAULT_ROLES.broadcast_codes) -> DataFrame:
    """Attach ``{column}_code``; the code table is broadcast only if its counted size is within the bound."""
    known = codes.where(F.col(column).isNotNull()).select(F.col(column).alias("__v"), F.col("code").alias(f"{column}_code"))
    if known.count() <= broadcast_codes:
        known = F.broadcast(known)
    joined = df.join(known, _q(column) == F.col("__v"), "left").drop("__v")
    return joined.withColumn(f"{column}_code", F.coalesce(F.col(f"{column}_code"), F.lit(-1)))


# bytes per value of fixed-width types (Spark's default sizes)
FIXED_SIZES = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
    "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _value_size(dt: T.DataType) -> int:
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    return FIXED_SIZES.get(dt.simpleString(), 8)


def _string_like(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.BinaryType))


def footprint_aggregates(before: DataFrame) -> list:
    """Byte length of every string column (to run inside another aggregate)."""
    return [
        F.coalesce(F.sum(F.octet_length(_q(f.name))), F.lit(0)).cast("bigint").alias(f"b__{i}")
        for i, f in enumerate(before.schema.fields)
        if _string_like(f.dataType)
    ]


def footprint_from_row(before: DataFrame, row: dict, rows: int) -> dict:
    sizes = {}
    for i, f in enumerate(before.schema.fields):
        sizes[f.name] = int(row[f"b__{i}"]) if _string_like(f.dataType) else rows * _value_size(f.dataType)
    return {"rows": rows, "bytes": sizes}


def _footprint_pass(before: DataFrame) -> dict:
    """One aggregate: row count and the byte length of every string column."""
    row = before.agg(F.count(F.lit(1)).alias("__rows"), *footprint_aggregates(before)).collect()[0].asDict()
    return footprint_from_row(before, row, int(row["__rows"]))


def _sizes_after(after: DataFrame, measured: dict) -> dict:
    """Sizes of a projection of the measured frame: strings keep their bytes."""
    rows = measured["rows"]
    out = {}
    for f in after.schema.fields:
        if _string_like(f.dataType):
            out[f.name] = measured["bytes"][f.name]
        else:
            out[f.name] = rows * _value_size(f.dataType)
    return out


def column_footprint(spark: SparkSession, before: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """Bytes per column, before and (optionally) after conformance.

    Re-aimed from in-process object sizes: fixed-width types count
    ``rows * size``, strings their UTF-8 bytes; a dropped column 0 after. Needs one pass over
    ``before``; ``after`` must be a projection of it (as ``apply_plan`` is).
    """
    measured = _footprint_pass(before)
    after_sizes = _sizes_after(after, measured) if after is not None else {}
    after_types = {f.name: f.dataType.simpleString() for f in after.schema.fields} if after is not None else {}
    rows = []
    for i, f in enumerate(before.schema.fields):
        rows.append(
            (i, f.name, f.dataType.simpleString(), measured["bytes"][f.name], after_types.get(f.name), after_sizes.get(f.name, 0))
        )
    schema = "position int, column string, type_before string, bytes_before bigint, type_after string, bytes_after bigint"
    return spark.createDataFrame(rows, schema)


def footprint_report(spark: SparkSession, before: DataFrame, after: DataFrame, measured: dict | None = None) -> DataFrame:
    """One row: MB before/after (bytes / 1024^2), reduction %, rows, columns.

    ``measured`` (from ``footprint_from_row``) skips the pass over ``before``.
    """
    measured = measured if measured is not None else _footprint_pass(before)
    b = sum(measured["bytes"].values()) / 1024**2
    a = sum(_sizes_after(after, measured).values()) / 1024**2
    reduction = (1 - a / b) * 100 if b > 0 else 0.0
    row = (round(b, 2), round(a, 2), round(reduction, 2), measured["rows"], len(after.columns))
    schema = "before_mb double, after_mb double, reduction_percent double, rows bigint, columns bigint"
    return spark.createDataFrame([row], schema)


def type_changes(spark: SparkSession, before: DataFrame, after: DataFrame, plan: ConformPlan) -> DataFrame:
    """Per column: type before, type after and why."""
    verdict = {v.column: v.verdict for v in plan.casts}
    after_types = {f.name: f.dataType.simpleString() for f in after.schema.fields}
    rows = []
    for f in before.schema.fields:
        if f.name in plan.dropped_by_name:
            why = "dropped_by_name"
        elif f.name in plan.dropped_all_null:
            why = "dropped_all_null"
        elif f.name in plan.parsed_timestamps:
            why = "parsed"
        else:
            why = verdict.get(f.name, "unchanged")
        rows.append((f.name, f.dataType.simpleString(), after_types.get(f.name), why))
    return spark.createDataFrame(rows, "column string, type_before string, type_after string, verdict string")


def optimize(spark: SparkSession, df: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> tuple[DataFrame, dict]:
    """Conform ``df`` and return it with its report, in one call.

    The report holds before_mb, after_mb, reduction_percent, rows, columns and
    the type of every column before and after (a dropped column has none).
    Two passes over ``df``: the profile and the footprint (string bytes).
    """
    out, plan = conform(df, roles)
    report = footprint_report(spark, df, out).collect()[0].asDict()
    report["types_before"] = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    report["types_after"] = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    report["verdicts"] = {v.column: v.verdict for v in plan.casts}
    return out, report
