"""Profiles of single files that merge, and plans kept beside their output.

A file's profile holds, for every column, its type, its rows and values and
the outcome of the cast checks; every entry merges by a sum, an "and" or a join
of types, so the profile of a table is the merge of its files' profiles, and a
new month is profiled alone. Distinct values of the category columns are kept
as rows. The plan made from merged profiles is the plan that one pass over all
files would give. Plans are stored as JSON and read back equal.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, TripRoles
from ..session import path_exists
from ..sources.sink import SOURCE, write_by_source
from .lattice import join_types
from .profile import CastVerdict, CategoryVerdict, ConformPlan, cast_check_exprs, plan_from_profile

ROWS = ""  # the entry that counts a file's rows
PROFILE = "column string, position int, type string, target string, n_rows bigint, n_values bigint, ok boolean, finite boolean"


def file_profiles(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, source: str = SOURCE) -> DataFrame:
    """(source_file, and ``PROFILE``) of every file in ``df``: one aggregate, one row a file, unpivoted."""
    from .profile import _nn

    names = [c for c in df.columns if c != source]
    aggs = [F.count(F.lit(1)).alias("n")]
    entries = [_entry(ROWS, -1, None, None, F.col("n"), None, None, None)]
    for i, c in enumerate(names):
        t = df.schema[c].dataType
        aggs.append(F.count(_nn(df, c)).alias(f"v{i}"))
        entries.append(_entry(c, i, t, None, F.col("n"), F.col(f"v{i}"), None, None))
        for j, (target_of, target) in enumerate(roles.narrow_targets):
            if target_of == c and c not in roles.columns_to_drop:
                checks = cast_check_exprs(t, _nn(df, c), target, roles)
                aggs += [e.alias(f"{k}{j}") for k, e in checks.items()]
                ok, finite = (F.col(f"{k}{j}") if k in checks else None for k in ("ok", "finite"))
                entries.append(_entry(c, i, t, target, F.col("n"), F.col(f"v{i}"), ok, finite))
    wide = df.groupBy(F.col(f"`{source}`").alias(SOURCE)).agg(*aggs)
    return wide.select(SOURCE, F.inline(F.array(*entries)))


def _entry(column, position, t, target, rows, values, ok, finite):
    none = F.lit(None)
    return F.struct(
        F.lit(column).alias("column"), F.lit(position).alias("position"), (none if t is None else F.lit(t.simpleString())).cast("string").alias("type"), F.lit(target).cast("string").alias("target"),
        rows.alias("n_rows"), (none if values is None else values).cast("bigint").alias("n_values"), (none if ok is None else ok).cast("boolean").alias("ok"), (none if finite is None else finite).cast("boolean").alias("finite"),
    )


def category_values(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, source: str = SOURCE) -> DataFrame:
    """(source_file, column, value) of the category columns: each file's distinct values as text, nulls left out."""
    cols = [c for c in roles.categorical_columns if c in df.columns and c not in roles.columns_to_drop]
    if not cols:
        return df.sparkSession.createDataFrame([], f"{SOURCE} string, column string, value string")
    long = df.select(F.col(f"`{source}`").alias(SOURCE), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([SOURCE], cols, "column", "value")
    return long.where("value IS NOT NULL AND value <> 'NaN'").distinct()


def update_profiles(df: DataFrame, path: str, roles: TripRoles = DEFAULT_ROLES, sources: Iterable[str] = ()) -> None:
    """Profile the files in ``df`` and put the profiles in place of earlier ones; other files' stay."""
    sources = list(sources)
    write_by_source(file_profiles(df, roles), f"{path}/columns", sources)
    write_by_source(category_values(df, roles), f"{path}/categories", sources)


def merged_profile(profiles: DataFrame) -> DataFrame:
    """The profiles of all files as one, with the types that a column has and its last place in any file."""
    return profiles.groupBy("column", "target").agg(
        F.max("position").alias("position"), F.collect_set("type").alias("types"), F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"),
        F.bool_and("ok").alias("ok"), F.bool_and("finite").alias("finite"),
    )


def plan_from_profiles(profiles: DataFrame, values: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> ConformPlan:
    """The plan of all files from their profiles; the driver gets one row a column.

    A column that a file lacks is null there. One with several types has their
    join (``plans.lattice``); joined to text it can't be narrowed.
    """
    spark = profiles.sparkSession
    rows = sorted(merged_profile(profiles).collect(), key=lambda r: (r["position"], r["column"], r["target"] or ""))
    whole = {r["column"]: r for r in rows if r["target"] is None}
    names = [c for c in whole if c != ROWS]
    types = {c: reduce(join_types, (_type(t) for t in sorted(whole[c]["types"]))) for c in names}
    row: dict = {"__rows": whole[ROWS]["n_rows"] if ROWS in whole else 0}
    kept = [c for c in names if c not in roles.columns_to_drop]
    row |= {f"nn__{i}": whole[c]["n_values"] for i, c in enumerate(kept)}
    checks = {(r["column"], r["target"]): r for r in rows if r["target"] is not None}
    for j, key in enumerate(roles.narrow_targets):
        if tuple(key) in checks:
            row |= {f"ok__{j}": checks[tuple(key)]["ok"], f"finite__{j}": checks[tuple(key)]["finite"]}
    distinct = {r["column"]: r["n"] for r in values.groupBy("column").agg(F.count_distinct("value").alias("n")).collect()}
    row |= {f"nd__{j}": distinct.get(c, 0) for j, c in enumerate(roles.categorical_columns)}
    frame = spark.createDataFrame([], T.StructType([T.StructField(c, types[c]) for c in names]))
    return plan_from_profile(frame, roles, row)


def _type(text: str) -> T.DataType:
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


def read_profiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The stored profiles and category values; none of the latter where no file has any."""
    values = f"{path}/categories"
    none = spark.createDataFrame([], f"{SOURCE} string, column string, value string")
    found = spark.read.schema("column string, value string").parquet(values) if path_exists(spark, values) else none
    return spark.read.schema(PROFILE).parquet(f"{path}/columns"), found


def write_plan(spark: SparkSession, plan: ConformPlan, path: str) -> None:
    """The plan as JSON in one file, over an earlier one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(conf).create(p, True)
    out.write(bytearray(json.dumps(asdict(plan), indent=1).encode()))
    out.close()


def read_plan(spark: SparkSession, path: str) -> ConformPlan:
    raw = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    return ConformPlan(
        rows=raw["rows"], input_schema=tuple(map(tuple, raw["input_schema"])), casts=tuple(CastVerdict(**v) for v in raw["casts"]), categories=tuple(CategoryVerdict(**c) for c in raw["categories"]),
        approx_distinct=raw["approx_distinct"], **{k: tuple(raw[k]) for k in ("dropped_by_name", "dropped_all_null", "parsed_timestamps")},
    )
