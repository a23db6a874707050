"""Sinks: monthly export, partitioned trip table, report tables.

Writes go through Spark's commit protocol, so a lost executor only retries
its tasks. Output folders are taken under the shared folder the cluster names
in ``spark.checkpoint.dir`` (see ``tripaudit.session``), never a local path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_ROLES, TripRoles
from ..session import open_writers
from .files import PARTITION_KEY, MonthlyLayout, file_listing, period_file, periods_in_data, read_all

SOURCE = "source_file"
_MONTH = "_month"


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cluster rows by the output partition keys with the ``rebalance`` hint.

    Adaptive execution then splits a partition that is too large (one busy
    month becomes several tasks and files) and merges small ones, so a hot
    key never lands in a single task and small months do not produce a
    file per input split.
    """
    return df.hint("rebalance", *keys)


def export_monthly(df: DataFrame, root: str, pickup: str, roles: TripRoles = DEFAULT_ROLES, build: Callable[[DataFrame], DataFrame] | None = None) -> MonthlyLayout:
    """Write a trip table as monthly files ``<root>/file=<name>/`` in one job.

    Rows without a pickup time go to the file of the unknown period. With
    ``build``, ``df`` holds what trips are made of, and the trips are made of
    it row by row after the shuffle, which then moves its few columns only."""
    moved = _spread(df.withColumn(_MONTH, F.year(pickup) * 12 + F.month(pickup)), [_MONTH])
    rows = build(moved) if build else moved
    tagged = rows.drop(_MONTH).withColumn(PARTITION_KEY, period_file(F.col(pickup), roles))
    with open_writers(df.sparkSession):
        tagged.write.mode("overwrite").partitionBy(PARTITION_KEY).parquet(root)
    return MonthlyLayout(root, PARTITION_KEY)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Remove the folders ``<column>=<value>`` of a partitioned table; those that are not there are no error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for value in values:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={escape(value)}")
        folder.getFileSystem(conf).delete(folder, True)


def write_by_source(df: DataFrame, path: str, sources: Iterable[str] = (), column: str = SOURCE, by_file: bool = False) -> None:
    """Rows partitioned by the file that they came from, which ``column`` names.

    A rerun replaces the files that it contains and nothing else (dynamic
    partition overwrite). ``sources`` are the files that the load covers: one
    that has no rows now loses those of earlier loads, after the write.
    ``by_file``: the rows come as they are read from these files. A split of
    the scan then holds a file or few, and its task writes them as they are,
    without a shuffle; a large file comes in several splits.
    """
    seen = Observation()
    watched = df.observe(seen, F.collect_set(column).alias("sources"))
    with open_writers(df.sparkSession):
        (
            (watched if by_file else _spread(watched, [column]))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(path)
        )
    try:
        written = set(seen.get["sources"])
    except Py4JJavaError:  # a plan that Spark finds empty before it runs reports no metrics
        written = {r[0] for r in df.select(column).distinct().collect()}
    drop_partitions(df.sparkSession, path, column, sorted(set(sources) - written))


def write_trips(df: DataFrame, path: str, sources: Iterable[str] = (), by_file: bool = False) -> None:
    """Featured trips, partitioned by the file that a row came from (see ``write_by_source``).

    Monthly files hold stray pickups of other months; these stay with their
    file, and ``pickup_year`` and ``pickup_month`` are ordinary columns.
    """
    write_by_source(df, path, sources, by_file=by_file)


def read_trips(spark: SparkSession, path: str) -> DataFrame | None:
    """The whole trip table; files that were conformed to other types are widened (see ``files.read_all``)."""
    layout = MonthlyLayout(path, SOURCE)
    names = [r["file_name"] for r in file_listing(spark, layout).select("file_name").collect()]
    return read_all(spark, layout, names)


def write_report(df: DataFrame, path: str) -> None:
    """A summary table (small by construction): one overwrite write."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


__all__ = ["export_monthly", "write_trips", "read_trips", "write_report", "periods_in_data"]
