"""D3: which formats the texts of a timestamp column are written in.

One aggregate counts, for every candidate format, the values that it parses,
and for every two formats the values that both parse, to different times. The
formats that parse anything are used in the order of what they parse, so a
value that two formats read differently goes to the one that fits more of the
column; such formats are reported as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ISO first, then the common orders of day and month.
CANDIDATES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "dd.MM.yyyy HH:mm")


@dataclass(frozen=True)
class FormatUse:
    column: str
    format: str
    rank: int | None  # place in the order of use; None: parses nothing
    n_values: int
    n_parsed: int
    n_conflicts: int  # values that a format of a better or equal rank reads as another time


def _parsed(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def format_uses(df: DataFrame, columns: tuple[str, ...], candidates: tuple[str, ...] = CANDIDATES) -> list[FormatUse]:
    """One pass over the columns; the driver gets one row.

    Nulls and texts that no format parses count nowhere but in ``n_values``
    (texts). Ties in what two formats parse go to the earlier candidate.
    """
    # every text is parsed once in each format, and the pairs compare what that gave
    names = [f"t{i}_{j}" for i, _ in enumerate(columns) for j, _ in enumerate(candidates)]
    times = [F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(columns)]
    times.append(F.array(*[_parsed(F.col(f"`{c}`"), f) for c in columns for f in candidates]).alias("times"))
    read = df.select(*times).select(*[f"x{i}" for i, _ in enumerate(columns)], *[F.col("times")[k].alias(n) for k, n in enumerate(names)])
    aggs = []
    for i, _ in enumerate(columns):
        aggs.append(F.count(f"x{i}").alias(f"n{i}"))
        aggs += [F.count(f"t{i}_{j}").alias(f"p{i}_{j}") for j, _ in enumerate(candidates)]
        aggs += [F.count_if(F.col(f"t{i}_{j}") != F.col(f"t{i}_{k}")).alias(f"c{i}_{j}_{k}") for j, k in combinations(range(len(candidates)), 2)]
    row = read.agg(*aggs).first()
    out = []
    for i, c in enumerate(columns):
        order = sorted((j for j in range(len(candidates)) if row[f"p{i}_{j}"]), key=lambda j: (-row[f"p{i}_{j}"], j))
        for j, f in enumerate(candidates):
            rank = order.index(j) if j in order else None
            better = order[:rank] if rank is not None else []
            conflicts = sum(row[f"c{i}_{min(j, k)}_{max(j, k)}"] for k in better)
            out.append(FormatUse(c, f, rank, row[f"n{i}"], row[f"p{i}_{j}"], conflicts))
    return out


def chosen_formats(uses: list[FormatUse], column: str) -> tuple[str, ...]:
    """The formats of a column in their order of use; for ``parse_timestamp`` and ``TripRoles.datetime_formats``."""
    return tuple(u.format for u in sorted((u for u in uses if u.column == column and u.rank is not None), key=lambda u: u.rank))


def uses_frame(spark: SparkSession, uses: list[FormatUse]) -> DataFrame:
    rows = [(u.column, u.format, u.rank, u.n_values, u.n_parsed, u.n_conflicts) for u in uses]
    return spark.createDataFrame(rows, "column string, format string, rank int, n_values bigint, n_parsed bigint, n_conflicts bigint")
