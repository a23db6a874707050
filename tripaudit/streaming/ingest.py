"""Incremental ingest of monthly files with Structured Streaming and a ledger.

The batch reader's bounded-memory chunking becomes a stream of files: each
micro-batch takes at most ``max_files_per_trigger`` new files, reads their
footers in tasks and their rows by footer schema (so files may drift), aligns
them to the declared schema, applies the frozen conformance plan and the
feature rules, and writes the rows of each file into a folder of the file's
own, ``file_key=<hash of the path>``. A batch that is run again overwrites the
same folders, so together with the checkpoint the output is exactly-once.

Nothing is lost on the way. A value that the declared type can't hold is NULL
and kept as text in ``cast_rejects``. A file that can't be read is entered in
the ledger (``streaming.ledger``): tried again by the next run if the error may
pass, listed as rejected if not. After the stream, a run takes the files that
the ledger has outstanding; a file that was replaced replaces its rows.
``availableNow`` processes what is there and stops, so the same code serves
back-fills and scheduled runs.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, TripRoles
from ..operators.batch_summaries import summary_states
from ..operators.conform import REJECTS, apply_plan, guarded
from ..operators.features import add_features
from ..plans.profile import ConformPlan, normalise_nan
from ..session import open_writers
from ..sources.files import PARTITION_KEY, MonthlyLayout, part_listing, source_name, validate_file
from ..sources.footers import BROKEN, EMPTY, OK, UNKNOWN_STORE, plain_path, with_footers
from ..sources.sink import drop_partitions, write_by_source
from . import ledger as L

FILE_KEY = "file_key"
MOST_ATTEMPTS = 3
_ALIGNED = "_align_rejects"


def _decoded(path: Column) -> Column:
    """A path of a read file's metadata as the listing has it."""
    return plain_path(F.url_decode(F.regexp_replace(path, r"\+", "%2B")))


def file_key(path: Column) -> Column:
    return F.substring(F.sha2(path, 256), 1, 32)


def read_files(spark: SparkSession, layout: MonthlyLayout, groups: list[tuple[T.StructType, list[str]]], schema: T.StructType, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """Part files, by schema, as one frame in the declared one, tagged with ``source_file`` and ``file_key``.

    A column that a file lacks is NULL, one that is not declared is left out,
    one of another type is cast under a check of each value: what the declared
    type can't hold (a fraction in a whole number, text in a number) is NULL,
    and its text goes into ``_align_rejects``.
    """
    frames = []
    none = F.lit(None).cast("map<string,string>")
    for own, paths in groups:
        df = normalise_nan(spark.read.schema(own).parquet(*paths))
        types = {f.name: f.dataType for f in own.fields}
        cols, failed = [], []
        for f in schema.fields:
            if f.name == PARTITION_KEY:
                continue
            c = F.col(f"`{f.name}`")
            if f.name not in types:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif types[f.name] == f.dataType:
                cols.append(c)
            else:
                value, ok = guarded(c, types[f.name], f.dataType, roles)
                cols.append(F.when(ok, value).alias(f.name))
                failed.append(F.when(~ok, F.struct(F.lit(f.name).alias("key"), c.cast("string").alias("value"))))
        found = F.filter(F.array(*failed), lambda x: x.isNotNull()) if failed else None
        rejects = F.when(F.size(found) > 0, F.map_from_entries(found)) if failed else none
        path = F.col("_metadata.file_path")
        frames.append(df.select(*cols, source_name(spark, layout, path).alias("source_file"), file_key(_decoded(path)).alias(FILE_KEY), rejects.alias(_ALIGNED)))
    return reduce(lambda a, b: a.union(b), frames)


def _write(raw: DataFrame, plan: ConformPlan, roles: TripRoles, sink: str) -> None:
    out = add_features(apply_plan(raw, plan, roles, rejects=REJECTS), roles)
    # a value that failed the alignment is NULL to the plan, so no column is in both maps
    both = F.coalesce(F.map_concat(_ALIGNED, REJECTS), F.col(_ALIGNED), F.col(REJECTS))
    out = out.withColumn(REJECTS, both).drop(_ALIGNED)
    # a split holds rows of one file or few, in their order: its task writes them as they are, without a shuffle or sort
    with open_writers(raw.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FILE_KEY).parquet(sink)


def _looked_at(spark: SparkSession, layout: MonthlyLayout, files: list[Row]) -> list[Row]:
    """A batch's files with names, keys and footers; through Spark's own reader where tasks can't open the store."""
    listed = spark.createDataFrame([(f["path"], f["length"], f["modified"]) for f in files], "path string, length bigint, modified timestamp")
    plain = plain_path(F.col("path"))
    named = listed.select("*", source_name(spark, layout, plain).alias("source_file"), plain.alias("plain"), file_key(plain).alias("key"))
    out = []
    for r in with_footers(named, min(len(files), spark.sparkContext.defaultParallelism)).collect():  # as many rows as a batch has files
        if r["status"] == UNKNOWN_STORE:
            c = validate_file(spark, r["path"])
            status = {"ok": OK, "no_columns": EMPTY, "unreadable": BROKEN}.get(c.status, c.status)
            r = Row(**(r.asDict() | {"status": status, "error": c.error, "columns": c.schema.json() if c.schema else None}))
        out.append(r)
    return out


def ingest_files(
    spark: SparkSession, layout: MonthlyLayout, files: list[Row], schema: T.StructType, plan: ConformPlan, sink: str, ledger: str, batch: str,
    roles: TripRoles = DEFAULT_ROLES, most_attempts: int = MOST_ATTEMPTS, summaries: str | None = None,
) -> None:
    """Take one batch of files (path, length, modified): write rows, their summary states if asked for, then the ledger.

    Where the write fails, each file is tried alone, so that one bad file
    keeps no other out.
    """
    if not files:
        return
    feet = _looked_at(spark, layout, files)
    named = {r["path"]: r for r in feet}
    before = L.last_entries(spark, ledger, [r["plain"] for r in feet], batch)
    good = [r for r in feet if r["status"] in (OK, EMPTY)]
    errors = {r["path"]: (r["status"], r["error"]) for r in feet if r["status"] not in (OK, EMPTY)}

    def write(rows: list[Row]) -> None:
        groups: dict[str, tuple[T.StructType, list[str]]] = {}
        for r in rows:
            if r["status"] == OK:
                groups.setdefault(r["columns"], (T.StructType.fromJson(json.loads(r["columns"])), []))[1].append(r["path"])
        if groups:
            _write(read_files(spark, layout, list(groups.values()), schema, roles), plan, roles, sink)

    try:
        write(good)
    except Exception:  # noqa: BLE001 - find the file that it was
        for r in good:
            try:
                write([r])
            except Exception as e:  # noqa: BLE001
                errors[r["path"]] = ("retry", (str(e).strip() or type(e).__name__).splitlines()[0][:300])
    emptied = [named[r["path"]]["key"] for r in good if r["path"] not in errors and not r["n_rows"]]
    drop_partitions(spark, sink, FILE_KEY, emptied)
    taken = [named[r["path"]]["key"] for r in good if r["path"] not in errors]
    if summaries and taken:
        if len(emptied) < len(taken):
            folders = [f"{sink.rstrip('/')}/{FILE_KEY}={k}" for k in taken if k not in emptied]
            rows = spark.read.option("basePath", sink).parquet(*folders)
            write_by_source(summary_states(rows, FILE_KEY), summaries, taken, FILE_KEY)
        else:
            drop_partitions(spark, summaries, FILE_KEY, emptied)
    entries = []
    for r in feet:
        at = named[r["path"]]
        last = before.get(at["plain"])
        same = last is not None and last["length"] == r["length"] and last["modified"] == r["modified"]
        attempt = last["attempt"] + 1 if same else 1
        status, error = errors.get(r["path"], (OK, None))
        state = L.TAKEN if status == OK else L.REJECTED if status == BROKEN or attempt >= most_attempts else L.RETRY
        entries.append((at["plain"], r["length"], r["modified"], at["source_file"], state, error, r["n_rows"] if state == L.TAKEN else None, attempt))
    L.record(spark, ledger, batch, entries)


def take_outstanding(
    spark: SparkSession, layout: MonthlyLayout, schema: T.StructType, plan: ConformPlan, sink: str, ledger: str,
    roles: TripRoles = DEFAULT_ROLES, max_files: int = 8, most_attempts: int = MOST_ATTEMPTS, summaries: str | None = None,
) -> int:
    """Files that changed after they were entered, and files to be tried again, in batches; returns how many."""
    listed = part_listing(spark, layout).select(F.col("path").alias("raw"), plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))
    due = L.outstanding(listed.drop("raw"), L.read_ledger(spark, ledger)).select("path").join(listed, "path").select(F.col("raw").alias("path"), "length", "modified").orderBy("path")
    n, held = 0, []
    for row in due.toLocalIterator():
        held.append(row)
        n += 1
        if len(held) >= max_files:
            ingest_files(spark, layout, held, schema, plan, sink, ledger, uuid.uuid4().hex, roles, most_attempts, summaries)
            held = []
    ingest_files(spark, layout, held, schema, plan, sink, ledger, uuid.uuid4().hex, roles, most_attempts, summaries)
    return n


def run_incremental_ingest(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    plan: ConformPlan,
    sink: str,
    checkpoint: str,
    roles: TripRoles = DEFAULT_ROLES,
    max_files_per_trigger: int = 8,
    timeout_s: float | None = None,
    partition_key: str | None = PARTITION_KEY,
    ledger: str | None = None,
    most_attempts: int = MOST_ATTEMPTS,
    summaries: str | None = None,
) -> DataFrame:
    """Process every file present under ``root`` and stop; returns the ledger's latest entries.

    Values that fail their cast are NULL in the output and kept as text in
    its ``cast_rejects`` column. The driver gets the footers of one batch at a
    time. The ledger is a folder beside the sink unless named. With
    ``summaries``, the states of A1-A5 are kept there by file
    (``operators.batch_summaries``).
    """
    layout = MonthlyLayout(root, partition_key)
    ledger = ledger or f"{sink.rstrip('/')}-ledger"
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def batch(files: DataFrame, number: int) -> None:
        rows = files.select("path", "length", F.col("modificationTime").alias("modified")).collect()  # at most max_files_per_trigger
        ingest_files(files.sparkSession, layout, rows, schema, plan, sink, ledger, f"{stream}-{number}", roles, most_attempts, summaries)

    listing = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(root)
        .select("path", "modificationTime", "length")  # content is not read
    )
    q = listing.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("incremental ingest did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    take_outstanding(spark, layout, schema, plan, sink, ledger, roles, max_files_per_trigger, most_attempts, summaries)
    return L.current(L.read_ledger(spark, ledger))
