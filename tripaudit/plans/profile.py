"""Profile -> plan.

One distributed aggregate over the raw table decides everything that
depends on all of the data: all-null columns, safe casts and cardinality.
The result is a small frozen :class:`ConformPlan`; applying it is a pure
projection (``tripaudit.operators.conform``), valid on batch and streaming
frames alike. Only this one-row result travels to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, TripRoles
from ..functions.exprs import (
    TARGET_KINDS,
    finite_ok,
    float_roundtrip_ok,
    integral_in_range_ok,
    is_float,
    is_numeric,
    nan_to_null,
)


@dataclass(frozen=True)
class CastVerdict:
    column: str
    target: str
    type_before: str
    type_after: str
    verdict: str  # converted | kept_loss | failed | skipped


@dataclass(frozen=True)
class CategoryVerdict:
    column: str
    n_distinct: int
    n_rows: int
    ratio: float
    verdict: str  # categorical | kept | skipped


@dataclass(frozen=True)
class ConformPlan:
    rows: int
    input_schema: tuple[tuple[str, str], ...]
    dropped_by_name: tuple[str, ...]
    dropped_all_null: tuple[str, ...]
    parsed_timestamps: tuple[str, ...]
    casts: tuple[CastVerdict, ...]
    categories: tuple[CategoryVerdict, ...]
    approx_distinct: bool = False

    def cast_map(self) -> dict[str, str]:
        """column -> Spark type; with several targets for one column the first converted wins."""
        out: dict[str, str] = {}
        for v in self.casts:
            if v.verdict == "converted" and v.column not in out:
                out[v.column] = v.type_after
        return out

    def guarded(self) -> dict[str, str]:
        """column -> target kind of the casts that are applied."""
        out: dict[str, str] = {}
        for v in self.casts:
            if v.verdict == "converted":
                out.setdefault(v.column, v.target)
        return out

    def categorical(self) -> tuple[str, ...]:
        return tuple(c.column for c in self.categories if c.verdict == "categorical")


def normalise_nan(df: DataFrame) -> DataFrame:
    """First step after a read: NaN -> NULL on every float column."""
    exprs = []
    for f in df.schema.fields:
        if is_float(f.dataType):
            exprs.append(nan_to_null(_q(f.name)).cast(f.dataType).alias(f.name))
        else:
            exprs.append(_q(f.name))
    return df.select(*exprs)


def _q(name: str) -> F.Column:
    return F.col(f"`{name}`")


def cast_ok(dt: T.DataType, c: F.Column, target: str, roles: TripRoles) -> F.Column:
    """Whether one row's value passes the check of its cast; a null passes."""
    lo_hi = TARGET_KINDS[target][1]
    if not is_numeric(dt):
        return F.lit(False)
    return float_roundtrip_ok(c, roles.float_rtol, roles.float_atol) if lo_hi is None else integral_in_range_ok(c, *lo_hi)


def cast_check_exprs(dt: T.DataType, c: F.Column, target: str, roles: TripRoles) -> dict[str, F.Column]:
    """Aggregates that decide the verdict of one (column, target) pair."""
    kind = TARGET_KINDS[target]
    out: dict[str, F.Column] = {}
    if not is_numeric(dt):
        return out
    if kind[1] is None:
        out["ok"] = F.bool_and(float_roundtrip_ok(c, roles.float_rtol, roles.float_atol))
    else:
        lo, hi = kind[1]
        out["ok"] = F.bool_and(integral_in_range_ok(c, lo, hi))
        if not kind[2]:
            out["finite"] = F.bool_and(finite_ok(c))
    return out


def decide_cast(dt: T.DataType, target: str, rows: int, non_null: int, checks: dict) -> str:
    """Verdict table of the narrowing step.

    float target: converted, or kept_loss beyond the tolerance.
    nullable int target: converted, or failed on a fractional / out-of-range value.
    non-nullable int target: failed on null or infinity, kept_loss on a
    fractional / out-of-range value (silent truncation), else converted.
    """
    if not is_numeric(dt):
        return "failed"
    _, rng, nullable = TARGET_KINDS[target]
    ok = checks.get("ok")
    ok = True if ok is None else bool(ok)
    if rng is None:
        return "converted" if ok else "kept_loss"
    if nullable:
        return "converted" if ok else "failed"
    finite = checks.get("finite")
    finite = True if finite is None else bool(finite)
    if non_null < rows or not finite:
        return "failed"
    return "converted" if ok else "kept_loss"


def _nn(df: DataFrame, name: str) -> F.Column:
    """Column with NaN read as NULL (the profile sees what the plan will apply to)."""
    c = _q(name)
    return nan_to_null(c).cast(df.schema[name].dataType) if is_float(df.schema[name].dataType) else c


def profile_aggregates(df: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> list[F.Column]:
    """Non-distinct aggregates of the profile pass, over the raw columns.

    They may run as an ``agg`` or be observed during a write of ``df``.
    """
    names = df.schema.names
    dropped = set(c for c in roles.columns_to_drop if c in names)
    kept = [c for c in names if c not in dropped]
    aggs: list[F.Column] = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(kept):
        aggs.append(F.count(_nn(df, c)).alias(f"nn__{i}"))
    for j, (c, target) in enumerate(roles.narrow_targets):
        if c not in kept:
            continue
        for k, e in cast_check_exprs(df.schema[c].dataType, _nn(df, c), target, roles).items():
            aggs.append(e.alias(f"{k}__{j}"))
    return aggs


def distinct_aggregates(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, approx_distinct: bool = False) -> list[F.Column]:
    out = []
    names = df.schema.names
    for j, c in enumerate(roles.categorical_columns):
        if c in names and c not in roles.columns_to_drop:
            x = _nn(df, c)
            out.append((F.approx_count_distinct(x) if approx_distinct else F.count_distinct(x)).alias(f"nd__{j}"))
    return out


def plan_from_profile(df: DataFrame, roles: TripRoles, row: dict, approx_distinct: bool = False) -> ConformPlan:
    """Freeze the verdicts from the one-row profile result."""
    schema = df.schema
    names = schema.names
    present = set(names)
    dropped_by_name = tuple(c for c in roles.columns_to_drop if c in present)
    kept = [c for c in names if c not in dropped_by_name]
    rows = int(row["__rows"])
    non_null = {c: int(row[f"nn__{i}"]) for i, c in enumerate(kept)}
    all_null = tuple(c for c in kept if non_null[c] == 0) if rows > 0 else ()
    remaining = [c for c in kept if c not in all_null]

    parsed = tuple(
        c for c in roles.timestamp_columns if c in remaining and isinstance(schema[c].dataType, T.StringType)
    )

    casts = []
    for j, (c, target) in enumerate(roles.narrow_targets):
        before = schema[c].dataType.simpleString() if c in present else None
        if c not in remaining:
            casts.append(CastVerdict(c, target, before, before, "skipped"))
            continue
        checks = {k: row.get(f"{k}__{j}") for k in ("ok", "finite")}
        verdict = decide_cast(schema[c].dataType, target, rows, non_null[c], checks)
        after = TARGET_KINDS[target][0] if verdict == "converted" else before
        casts.append(CastVerdict(c, target, before, after, verdict))

    cats = []
    for j, c in enumerate(roles.categorical_columns):
        if c not in remaining:
            cats.append(CategoryVerdict(c, 0, rows, 0.0, "skipped"))
            continue
        nd = int(row[f"nd__{j}"])
        ratio = nd / rows if rows > 0 else 0.0
        verdict = "kept" if ratio >= roles.category_ratio_limit else "categorical"
        cats.append(CategoryVerdict(c, nd, rows, ratio, verdict))

    return ConformPlan(
        rows=rows,
        input_schema=tuple((f.name, f.dataType.simpleString()) for f in schema.fields),
        dropped_by_name=dropped_by_name,
        dropped_all_null=all_null,
        parsed_timestamps=parsed,
        casts=tuple(casts),
        categories=tuple(cats),
        approx_distinct=approx_distinct,
    )


def build_plan(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, approx_distinct: bool = False) -> ConformPlan:
    """Run the single profile pass over ``df`` and freeze the plan."""
    aggs = profile_aggregates(df, roles) + distinct_aggregates(df, roles, approx_distinct)
    row = df.agg(*aggs).collect()[0].asDict()
    return plan_from_profile(df, roles, row, approx_distinct)
