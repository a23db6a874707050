"""Helpers shared by the operators: tables, staged results, range-partitioned running totals."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: A small side is broadcast only up to so many rows; beyond that Spark picks the join.
BROADCAST_ROWS = 200_000
#: Words are maximal runs of characters other than space and \t \n \v \f \r.
WORD_SQL = r"[^\x20\x09-\x0D]+"


#: Arrow batches carry whole texts, so they are bounded by bytes (a longer row is a batch of its own).
BATCH_LIMIT, MOST_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limit of bytes per Arrow batch to ``MOST_BATCH``; a lower one stays."""
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_LIMIT))
    if not 0 < limit <= MOST_BATCH:
        spark.conf.set(BATCH_LIMIT, str(MOST_BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_MODELS: list[Callable[[], None]] = []


def remembered(load):
    """Keeps what ``load`` returned for its last two arguments in a Python worker, until ``free_models``."""
    kept = lru_cache(maxsize=2)(load)
    _MODELS.append(kept.cache_clear)
    return kept


def free_models() -> None:
    """Workers go from stage to stage: an operator that needs the memory lets go of what others kept there."""
    for clear in _MODELS:
        clear()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # the C library keeps freed arrays otherwise
        trim(0)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of doc_id as text is divisible by ``folds``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if the known row count is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _running(group: str, value: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            g = pdf[group].to_numpy()
            v = pdf[value].to_numpy().astype(np.int64)
            first = np.r_[g[0] != last, g[1:] != g[:-1]]
            c = np.cumsum(v)
            at = np.flatnonzero(first)
            base = np.zeros(len(v), np.int64)
            seg = np.cumsum(first) - 1
            starts = np.where(at > 0, c[at - 1], 0) if len(at) else np.array([], np.int64)
            inside = seg >= 0
            base[inside] = starts[seg[inside]]
            before = c - v - base
            before[~inside] += total
            pdf["before"] = before
            last, total = g[-1], int(before[-1] + v[-1])
            yield pdf

    return run


def running_total(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows of the same ``group`` that come earlier in ``order``.

    ``group`` and ``value`` are whole numbers without nulls. Rows are dealt by
    ranges of (group, order), so a group that holds most rows spreads over many
    tasks; a task keeps one running sum, and the only other state is one sum
    for each group and task, joined back. Rows that tie in ``order`` get some
    order of their own, fixed by the written table.
    """
    keys = [group, *order]
    schema = T.StructType([*df.schema.fields, T.StructField("before", T.LongType())])
    local = staged(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInPandas(_running(group, value), schema).withColumn("_pid", F.spark_partition_id()),
        name,
    )
    sums = local.groupBy("_pid", group).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(sums.withColumn("_off", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum"), f"{name}-offsets")
    return local.join(small(offsets, offsets.count()), ["_pid", group]).withColumn("before", F.col("before") + F.col("_off")).drop("_pid", "_off")
