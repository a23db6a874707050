"""Column states of single files that add up to those of the whole table.

A file's state of a column is a row: counts, bounds, mean and squared
deviations, a KLL sketch of the quantiles and an HLL sketch of the distinct
values. States are kept by source file, so a new or replaced month is the only
one that is read; the table's state is merged from them. Merged states take
the place of the statistics pass: bounds and counts are exact, the sketch's
quantiles are the guess from which the exact search starts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sink import SOURCE, write_by_source
from .distributions import QUANTILE_PROBS, _num
from .quantiles import bracket_probs

#: Size of the KLL sketches; their rank error is then under 1 percent, and the brackets are 1.5 percent wide on either side.
KLL_SIZE, ACCURACY = 400, 200


def file_states(df: DataFrame, columns: tuple[str, ...], source: str = SOURCE) -> DataFrame:
    """(source_file, column, n_rows, n, vmin, vmax, mean, m2, quantiles, distinct) of every present numeric column.

    NaN and infinities are missing, as in every summary; ``n_rows`` counts
    them. The distinct values are sketched by their 64-bit hashes (texts of
    doubles cost twice the time). Partial aggregation keeps a busy month off single tasks.
    """
    cols = [c for c in columns if c in df.columns]
    long = df.select(F.col(source).alias(SOURCE), *[_num(c).alias(c) for c in cols]).unpivot([SOURCE], cols, "column", "value")
    v = F.col("value")
    return long.groupBy(SOURCE, "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("n"), F.min(v).alias("vmin"), F.max(v).alias("vmax"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"),
        F.kll_sketch_agg_double(v, F.lit(KLL_SIZE)).alias("quantiles"), F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v))).alias("distinct"),
    )


def update_states(df: DataFrame, path: str, columns: tuple[str, ...], sources: Iterable[str] = ()) -> None:
    """Compute the states of the files in ``df`` and put them in place of earlier ones; other files' stay.

    ``sources``: the files that ``df`` covers, so that one without rows loses its state.
    """
    write_by_source(file_states(df, columns), path, sources)


def merged_states(states: DataFrame) -> DataFrame:
    """One row per column: n_rows, n, vmin, vmax, sd, n_distinct (estimated) and the merged quantile sketch."""
    total = states.groupBy("column").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    both = states.join(F.broadcast(total), "column")  # one row per column
    off = F.col("mean") - F.col("_mean")
    out = both.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.min("vmin").alias("vmin"), F.max("vmax").alias("vmax"),
        F.sum(F.col("m2") + F.col("n") * off * off).alias("_m2"), F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("_distinct"),
    )
    sd = F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (F.col("n") - 1)))
    return out.select("column", "n_rows", "n", "vmin", "vmax", sd.alias("sd"), F.hll_sketch_estimate("_distinct").alias("n_distinct"), "quantiles")


def stats_from_states(states: DataFrame, probs: tuple[float, ...] = QUANTILE_PROBS) -> dict:
    """The statistics that the distribution summaries take (see ``numeric_stats``), from states alone."""
    ranks = bracket_probs(probs, ACCURACY)
    guess = F.when(F.col("n") > 0, F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(r))) for r in ranks]))
    rows = merged_states(states).select("column", "n", "vmin", "vmax", "sd", guess.alias("approx")).collect()  # one row per column
    return {r["column"]: {"n": r["n"], "min": r["vmin"], "max": r["vmax"], "sd": r["sd"], "approx": r["approx"]} for r in rows}


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
