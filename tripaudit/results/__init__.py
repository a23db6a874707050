"""Registered results: name -> (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads the given tables (through the ``trips`` view derived from
``lineitem``). Column names are aliased identically on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fixture import KEYS

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}

KEYS_SQL = ", ".join(KEYS)

# pandas cannot hold NULL in an int8 column: a nullable integer result column
# is presented as DOUBLE on both sides so the two frames compare equal.
NULLABLE_INTS = ("payment_type",)


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate result name {name}")
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def presentable(df: DataFrame, columns: tuple[str, ...] = NULLABLE_INTS) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns if c in df.columns})


def sql_col(c: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {c}" if c in NULLABLE_INTS else c


def load_all() -> dict[str, tuple[Builder, str | None]]:
    from . import summaries, conform, distributions, anomalies, sources  # noqa: F401  (registration side effects)

    return REGISTRY
