"""Joined types of columns that drift between files.

Any two types have a join, the narrowest type that holds the values of both;
joining is commutative, associative and idempotent, so the result does not
depend on the order in which files are met, and joins of joins (by month, by
part) agree with one join of everything. Numbers go byte < short < int < long
and on to decimals and doubles, dates to timestamps, and what has no common
type is text. Every column with more than one type is reported.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_TEMPORAL = (T.DateType(), T.TimestampType(), T.TimestampNTZType())
MOST_DIGITS = 38


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if a in _INTEGRAL and b in _INTEGRAL:
        return _INTEGRAL[max(_INTEGRAL.index(a), _INTEGRAL.index(b))]
    if a in _TEMPORAL and b in _TEMPORAL:
        return _TEMPORAL[max(_TEMPORAL.index(a), _TEMPORAL.index(b))]
    if _is_number(a) and _is_number(b):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        scale = max(_scale(a), _scale(b))
        whole = max(_whole(a), _whole(b))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.DoubleType()
    return T.StringType()


def _is_number(t: T.DataType) -> bool:
    return t in _INTEGRAL or isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType))


def _scale(t: T.DataType) -> int:
    return t.scale if isinstance(t, T.DecimalType) else 0


def _whole(t: T.DataType) -> int:
    return t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[t]


@dataclass(frozen=True)
class TypeConflict:
    """A column that files hold in several types.

    ``widened``: every value is kept as it is; ``inexact``: whole numbers of
    more than 53 bits, or decimals, become doubles; ``zoned``: instants become
    wall-clock times of the session's zone; ``text``: values become text.
    """

    column: str
    joined: str
    kind: str
    types: tuple[str, ...]


def _kind(joined: T.DataType, types: set[T.DataType]) -> str:
    if isinstance(joined, T.StringType):
        return "text"
    if isinstance(joined, T.DoubleType) and any(t == T.LongType() or isinstance(t, T.DecimalType) for t in types):
        return "inexact"
    return "zoned" if joined == T.TimestampNTZType() and T.TimestampType() in types else "widened"


def join_schemas(schemas: Iterable[T.StructType]) -> tuple[T.StructType, list[TypeConflict]]:
    """One schema for all, columns in the order in which they are first met, and the columns that drift."""
    seen: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for f in schema.fields:
            types = seen.setdefault(f.name, [])
            if f.dataType not in types:
                types.append(f.dataType)
    joined = {name: reduce(join_types, types) for name, types in seen.items()}
    drifting = [
        TypeConflict(name, joined[name].simpleString(), _kind(joined[name], set(types)), tuple(sorted(t.simpleString() for t in types))) for name, types in seen.items() if len(types) > 1
    ]
    return T.StructType([T.StructField(name, t) for name, t in joined.items()]), drifting


def as_type(c: Column, own: T.DataType, joined: T.DataType) -> Column:
    """A value of one type as a value of a type joined from it."""
    return c if own == joined else c.cast(joined)


def as_joined(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as one projection onto a joined schema; columns that it lacks are NULL, those of ``keep`` stay last."""
    own = {f.name: f.dataType for f in df.schema.fields}
    cols = [(as_type(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return df.select(*cols, *keep)


def conflicts_frame(spark: SparkSession, conflicts: list[TypeConflict]) -> DataFrame:
    rows = [(c.column, c.joined, c.kind, ", ".join(c.types)) for c in conflicts]
    return spark.createDataFrame(rows, "column string, joined string, kind string, types string")
