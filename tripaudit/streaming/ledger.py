"""The ledger of an incremental ingest (S5): what became of every version of every file.

A version is a path with its size and modification time. Its state is

* ``taken``: its rows are in the sink;
* ``retry``: an error that may pass kept it out; the next run tries again;
* ``rejected``: it is broken, or failed as often as allowed; the error says why.

Each batch writes its entries into a folder of its own, after its rows, so a
batch that is run again writes the same folder anew. The latest entry of a
path counts. A file that changed since then, or may be tried again, is
outstanding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists

TAKEN, RETRY, REJECTED = "taken", "retry", "rejected"
ENTRY = "path string, length bigint, modified timestamp, source_file string, state string, error string, n_rows bigint, attempt int, at timestamp"


def record(spark: SparkSession, ledger: str, batch: str, entries: list[tuple]) -> None:
    """Write a batch's entries (rows of ``ENTRY`` without the time)."""
    schema = ENTRY.rsplit(",", 1)[0]
    frame = spark.createDataFrame(entries, schema).withColumn("at", F.current_timestamp())
    frame.coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/batch={batch}")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Every entry with its batch; none before the first batch."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], f"{ENTRY}, batch string")
    return spark.read.schema(f"{ENTRY}, batch string").parquet(ledger)


def last_entries(spark: SparkSession, ledger: str, paths: list[str], batch: str) -> dict:
    """path -> the latest entry of each of a batch's paths from other batches; the driver gets these paths' entries."""
    own = read_ledger(spark, ledger).where(F.col("path").isin(paths) & (F.col("batch") != batch))
    return {r["path"]: r for r in sorted(own.collect(), key=lambda r: (r["at"], r["attempt"]))}


def current(entries: DataFrame) -> DataFrame:
    """The latest entry of each path."""
    last = entries.groupBy("path").agg(F.max(F.struct("at", "attempt", *[c for c in entries.columns if c not in ("path", "at", "attempt")])).alias("e"))
    return last.select("path", *[f"e.{c}" for c in entries.columns if c != "path"])


def outstanding(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Of a listing (path, length, modified): files that changed after their entry, and those to be tried again."""
    last = current(entries).select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), "state", "attempt")
    changed = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
    return files.join(last, "path").where(changed | (F.col("state") == RETRY)).select("path", "length", "modified")


def gone(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of files to be tried again that the listing lacks."""
    return current(entries).where(F.col("state") == RETRY).join(files.select("path"), "path", "left_anti")
