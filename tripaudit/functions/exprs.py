"""Column expressions shared by the operators.

All of them are built-in Spark expressions (no UDF), written in ANSI-safe
forms (``try_divide``, ``try_cast``) so they stay inside whole-stage codegen
and never raise on bad rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _inf():
    return F.lit(float("inf"))

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)

# target kind -> (Spark type name, integer range or None, nullable)
TARGET_KINDS = {
    "Int8": ("tinyint", (-128, 127), True),
    "int8": ("tinyint", (-128, 127), False),
    "Int16": ("smallint", (-32768, 32767), True),
    "int16": ("smallint", (-32768, 32767), False),
    "Int32": ("int", (-(2**31), 2**31 - 1), True),
    "int32": ("int", (-(2**31), 2**31 - 1), False),
    "float32": ("float", None, True),
    "float64": ("double", None, True),
}


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, INTEGRAL_TYPES + FRACTIONAL_TYPES)


def is_float(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def nan_to_null(c: Column) -> Column:
    """NaN means missing; Spark would otherwise order NaN above everything."""
    return F.nanvl(c, F.lit(None).cast("double"))


def flag(cond: Column) -> Column:
    """0/1 TINYINT flag; an unknown condition counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("tinyint")


def not_flag(cond: Column) -> Column:
    """0/1 TINYINT flag of NOT cond; an unknown condition counts as 1."""
    return (~F.coalesce(cond, F.lit(False))).cast("tinyint")


def integral_between(c: Column, lo: int, hi: int) -> Column:
    """c is a whole number within [lo, hi]; NULL when c is NULL."""
    return c.between(lo, hi) & (c == F.floor(c))


def minutes_between(start: Column, end: Column) -> Column:
    """(end - start) in minutes as FLOAT, wall-clock difference of NTZ times."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return (micros.cast("double") / 1000000.0 / 60.0).cast("float")


def safe_ratio_float(num: Column, den: Column) -> Column:
    """num / den in float32 semantics with +-inf, NaN and NULL mapped to 0."""
    q = F.try_divide(num.cast("double"), den.cast("double")).cast("float")
    return F.when(q.isNull() | F.isnan(q) | (F.abs(q) == _inf()), F.lit(0.0).cast("float")).otherwise(q)


def float_sum(columns: list[Column]) -> Column:
    """Row-wise FLOAT sum with missing values as 0; 0.0 when there are none."""
    if not columns:
        return F.lit(0.0).cast("float")
    return reduce(add, [F.coalesce(nan_to_null(c).cast("float"), F.lit(0.0).cast("float")) for c in columns]).cast("float")


def float_roundtrip_ok(c: Column, rtol: float, atol: float) -> Column:
    """Row passes the float32 tolerance check (NULL passes)."""
    x = c.cast("double")
    back = x.cast("float").cast("double")
    return (
        x.isNull()
        | (back == x)
        | ((F.abs(back) < _inf()) & (F.abs(x - back) <= F.lit(atol) + F.lit(rtol) * F.abs(back)))
    )


def integral_in_range_ok(c: Column, lo: int, hi: int) -> Column:
    """Row is NULL or a whole number inside [lo, hi]."""
    x = c.cast("double")
    return x.isNull() | (x.between(lo, hi) & (x == F.floor(x)))


def finite_ok(c: Column) -> Column:
    x = c.cast("double")
    return x.isNull() | (F.abs(x) < _inf())
