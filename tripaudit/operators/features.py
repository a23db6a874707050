"""Derived columns and quality flags (F1-F20) as a rule registry.

Every rule names the inputs it requires; a rule whose inputs are absent is
not emitted and is reported by :func:`feature_manifest` instead of failing.
All rules are built-in expressions; Catalyst collapses the levels below into
one projection over the scan, so the chain costs no extra pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, TripRoles
from ..functions.exprs import (
    flag,
    float_sum,
    integral_between,
    minutes_between,
    not_flag,
    safe_ratio_float,
)

# added columns, in the order the chain adds them (fixed output vocabulary)
FEATURE_COLUMNS = (
    "trip_duration_min",
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_year",
    "expected_fare",
    "fare_discrepancy",
    "avg_speed_mph",
    "is_invalid_PULocation",
    "is_invalid_DOLocation",
    "is_same_zone",
    "is_zero_passenger",
    "is_invalid_ratecodeID",
    "is_invalid_payment",
    "is_cash_with_tip",
    "is_free_but_charged",
)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Rule:
    name: str
    outputs: tuple[str, ...]
    requires: tuple[str, ...]  # role names ("pickup", "dropoff") or column names
    build: Callable[[DataFrame, dict, TripRoles], dict[str, Column]]


def resolve_roles(columns: list[str], roles: TripRoles) -> dict[str, str]:
    """Role -> physical column: first present candidate wins."""
    out = {}
    for role, cands in (("pickup", roles.pickup_candidates), ("dropoff", roles.dropoff_candidates)):
        for c in cands:
            if c in columns:
                out[role] = c
                break
    return out


def _impute_zero(df: DataFrame, name: str) -> Column:
    """NULL -> 0 in the column's own type (TINYINT once narrowed)."""
    dt = df.schema[name].dataType
    c = _q(name)
    # a column that could not be narrowed keeps its type: no lossy cast
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        c = F.nanvl(c, F.lit(None).cast(dt))
    return F.coalesce(c, F.lit(0).cast(dt))


def _duration(df, r, roles):
    return {"trip_duration_min": minutes_between(_q(r["pickup"]), _q(r["dropoff"]))}


def _time_parts(df, r, roles):
    p = _q(r["pickup"])
    return {
        "pickup_hour": F.hour(p).cast("tinyint"),
        "pickup_dayofweek": F.weekday(p).cast("tinyint"),
        "pickup_month": F.month(p).cast("tinyint"),
        "pickup_year": F.year(p).cast("smallint"),
    }


def _expected_fare(df, r, roles):
    present = [_q(c) for c in roles.fare_components if c in df.columns]
    return {"expected_fare": float_sum(present)}


def _discrepancy(df, r, roles):
    # subtract in the type the fare was kept in; narrow the result, not the input
    kept = df.schema["fare_amount"].dataType
    wide = "float" if isinstance(kept, T.FloatType) else "double"
    return {"fare_discrepancy": F.abs(_q("fare_amount").cast(wide) - F.col("expected_fare").cast(wide)).cast("float")}


def _speed(df, r, roles):
    hours = (F.col("trip_duration_min") / 60.0).cast("float")
    return {"avg_speed_mph": safe_ratio_float(_q("trip_distance"), hours)}


def _zones(df, r, roles):
    lo, hi = roles.zone_range
    pu, do = _q("PULocationID"), _q("DOLocationID")
    return {
        "is_invalid_PULocation": not_flag(integral_between(pu, lo, hi)),
        "is_invalid_DOLocation": not_flag(integral_between(do, lo, hi)),
        "is_same_zone": flag(pu == do),
    }


def _passengers(df, r, roles):
    imputed = _impute_zero(df, "passenger_count")
    return {"passenger_count": imputed, "is_zero_passenger": flag(imputed == 0)}


def _ratecode(df, r, roles):
    imputed = _impute_zero(df, "RatecodeID")
    return {"RatecodeID": imputed, "is_invalid_ratecodeID": not_flag(imputed.isin(list(roles.rate_codes)))}


def _payment(df, r, roles):
    pay, tip = _q("payment_type"), _q("tip_amount")
    out = {
        "is_invalid_payment": not_flag(pay.isin(list(roles.payment_types))),
        "is_cash_with_tip": flag((pay == roles.cash_payment) & (tip > 0)),
    }
    if "total_amount" in df.columns:
        out["is_free_but_charged"] = flag(pay.isin(list(roles.free_payments)) & (_q("total_amount") > 0))
    return out


# Registry in chain order; level 2 rules read level 1 outputs.
RULES: tuple[Rule, ...] = (
    Rule("trip_duration", ("trip_duration_min",), ("pickup", "dropoff"), _duration),
    Rule("time_features", ("pickup_hour", "pickup_dayofweek", "pickup_month", "pickup_year"), ("pickup",), _time_parts),
    Rule("expected_fare", ("expected_fare",), (), _expected_fare),
    Rule("fare_discrepancy", ("fare_discrepancy",), ("fare_amount",), _discrepancy),
    Rule("avg_speed", ("avg_speed_mph",), ("trip_distance", "trip_duration_min"), _speed),
    Rule("zone_flags", ("is_invalid_PULocation", "is_invalid_DOLocation", "is_same_zone"), ("PULocationID", "DOLocationID"), _zones),
    Rule("zero_passenger", ("is_zero_passenger",), ("passenger_count",), _passengers),
    Rule("ratecode_flag", ("is_invalid_ratecodeID",), ("RatecodeID",), _ratecode),
    Rule(
        "payment_flags",
        ("is_invalid_payment", "is_cash_with_tip", "is_free_but_charged"),
        ("payment_type", "tip_amount", "fare_amount"),
        _payment,
    ),
)


def _missing(rule: Rule, columns: list[str], resolved: dict) -> list[str]:
    miss = []
    for req in rule.requires:
        if req in ("pickup", "dropoff"):
            if req not in resolved:
                miss.append(req)
        elif req not in columns:
            miss.append(req)
    return miss


def add_features(df: DataFrame, roles: TripRoles = DEFAULT_ROLES, only: tuple[str, ...] | None = None) -> DataFrame:
    """apply the rules in order; absent inputs skip a rule."""
    resolved = resolve_roles(df.columns, roles)
    for rule in RULES:
        if only is not None and rule.name not in only:
            continue
        if _missing(rule, df.columns, resolved):
            continue
        df = df.withColumns(rule.build(df, resolved, roles))
    return df


def feature_manifest(columns: list[str], roles: TripRoles = DEFAULT_ROLES) -> list[tuple[str, str, str, str]]:
    """(rule, status, outputs, missing inputs) for a given input column list."""
    resolved = resolve_roles(columns, roles)
    cols = list(columns)
    out = []
    for rule in RULES:
        miss = _missing(rule, cols, resolved)
        outputs = list(rule.outputs)
        if rule.name == "payment_flags" and "total_amount" not in cols and not miss:
            outputs.remove("is_free_but_charged")
            out.append((rule.name + ":free_but_charged", "skipped", "is_free_but_charged", "total_amount"))
        out.append((rule.name, "skipped" if miss else "applied", ",".join(outputs), ",".join(miss)))
        if not miss:
            cols.extend(o for o in rule.outputs if o not in cols)
    return out


def rule_report(spark, input_columns: list[str], featured: DataFrame, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """F20 as a table: per output of every rule, applied or skipped (and why),
    with the rows where it is non-null and non-zero (flagged, for a flag).

    One aggregate over the featured table; the manifest itself is plan-time.
    """
    status: dict[str, tuple[str, str, str]] = {}
    for rule, st, outputs, missing in feature_manifest(input_columns, roles):
        for o in outputs.split(","):
            if o:
                status[o] = (rule.split(":")[0], st, missing)
    outputs = [o for o in FEATURE_COLUMNS if o in status]
    present = [o for o in outputs if status[o][1] == "applied" and o in featured.columns]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, o in enumerate(present):
        aggs += [F.count(_q(o)).alias(f"nn{i}"), F.count_if(_q(o) != 0).alias(f"nz{i}")]
    row = featured.agg(*aggs).collect()[0]
    rows = []
    for o in outputs:
        rule, st, missing = status[o]
        if o in present:
            i = present.index(o)
            rows.append((rule, o, st, missing, int(row[f"nn{i}"]), int(row[f"nz{i}"])))
        else:
            rows.append((rule, o, st, missing, 0, 0))
    schema = "rule string, output string, status string, missing string, n_non_null bigint, n_nonzero bigint"
    return spark.createDataFrame(rows, schema)


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("is_")]
