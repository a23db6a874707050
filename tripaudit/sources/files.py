"""Monthly trip files: naming, listing, audit, reading.

A monthly file is addressed by the name ``{taxi_type}_tripdata_{year}-{MM}.parquet``.
Two physical layouts are understood:

* flat: ``<root>/<name>`` - a published single file (or a Spark output
  directory of that name);
* partitioned: ``<root>/file=<name>/part-*.parquet`` - what
  :func:`export_monthly` writes in one distributed job.

Listing and schema checks touch only metadata (the file index and Parquet
footers); data is read lazily by Catalyst with pruning and pushdown.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_ROLES, TripRoles
from ..plans.lattice import TypeConflict, as_joined, join_schemas
from ..session import path_exists, scratch_path
from .footers import BROKEN, EMPTY, MISSING, OK, RETRY, UNKNOWN_STORE, with_footers

PARTITION_KEY = "file"


@dataclass(frozen=True)
class MonthlyLayout:
    root: str
    partition_key: str | None = PARTITION_KEY  # None: flat layout

    def path(self, name: str) -> str:
        root = self.root.rstrip("/")
        return f"{root}/{self.partition_key}={name}" if self.partition_key else f"{root}/{name}"


def period_files(spark: SparkSession, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """The configured periods, year-major then month, with their file names."""
    rows = [(roles.taxi_type, y, m, roles.file_name(y, m)) for y, m in roles.periods()]
    return spark.createDataFrame(rows, "taxi_type string, year int, month int, file_name string")


def period_file(pickup: Column, roles: TripRoles = DEFAULT_ROLES) -> Column:
    """The name of the monthly file of a pickup time; the unknown period's for NULL."""
    name = F.format_string(
        roles.file_name_template.replace("{taxi_type}", "%s").replace("{year}", "%d").replace("{month:02d}", "%02d"),
        F.lit(roles.taxi_type), F.year(pickup), F.month(pickup),
    )
    return F.when(pickup.isNull(), F.lit(roles.unknown_file_name())).otherwise(name)


def periods_in_data(df: DataFrame, pickup: str, roles: TripRoles = DEFAULT_ROLES) -> DataFrame:
    """S1 over data: the distinct (year, month) of pickups and their file names.

    Rows without a pickup time are the unknown period: year and month NULL."""
    p = F.col(pickup)
    return df.select(
        F.lit(roles.taxi_type).alias("taxi_type"), F.year(p).alias("year"), F.month(p).alias("month"), period_file(p, roles).alias("file_name")
    ).distinct()


def source_name(spark: SparkSession, layout: MonthlyLayout, path: Column) -> Column:
    """Name of the source that a part file under the root belongs to.

    Partitioned layout: the partition value. Flat layout: the first path
    component under the root that ends in .parquet (a file, or a Spark output
    directory), else the whole path under the root. Any name counts.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(layout.root)
    root = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().getPath().rstrip("/") + "/"
    plain = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    under = F.substr(plain, F.instr(plain, F.lit(root)) + F.lit(len(root)))
    if layout.partition_key:
        return F.regexp_extract(under, f"(?:^|/){layout.partition_key}=([^/]+)/", 1)
    first = F.regexp_extract(under, r"^((?:[^/]+/)*?[^/]+\.parquet)(?:/.*)?$", 1)
    return F.when(first != "", first).otherwise(under)


def part_listing(spark: SparkSession, layout: MonthlyLayout) -> DataFrame:
    """(path, length, modificationTime, file_name) of every Parquet part under the root.

    Uses the ``binaryFile`` source for a distributed file index; its content
    is not selected, so none is read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(layout.root)
        .select("path", "length", "modificationTime")
    )
    return listing.withColumn("file_name", source_name(spark, layout, F.col("path"))).where(F.col("file_name") != "")


def file_listing(spark: SparkSession, layout: MonthlyLayout) -> DataFrame:
    """S7 + S8: every Parquet file under the root, whatever its name, with bytes, parts and modification time."""
    return part_listing(spark, layout).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")
    )


def _hadoop_status(spark: SparkSession, path: str, with_bytes: bool = False):
    """(exists, is_file, is_dir, modification time, bytes) of a path (bytes of
    all parts for a directory)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False, False, False, None, None
    st = fs.getFileStatus(p)
    if st.isFile():
        size = st.getLen()
    else:
        size = fs.getContentSummary(p).getLength() if with_bytes else None
    return True, st.isFile(), st.isDirectory(), st.getModificationTime(), size


# footer schemas already read in this process, keyed by (path, mtime, length):
# an unchanged file is not read again (a changed one has a new key)
_FOOTERS: dict = {}


@dataclass(frozen=True)
class FileCheck:
    file_name: str
    path: str
    exists: bool
    is_file: bool
    n_columns: int
    status: str  # ok | missing | no_columns | unreadable
    error: str | None
    schema: T.StructType | None
    bytes: int | None = None
    n_rows: int | None = None
    parts: tuple[tuple[T.StructType, tuple[str, ...]], ...] = ()  # by schema, where they differ


def validate_file(spark: SparkSession, path: str, name: str | None = None, with_bytes: bool = False) -> FileCheck:
    """Exists -> is a file (or a Spark output directory) -> footer has columns.

    Never raises; any error becomes status ``unreadable``. Only the footer
    schema is read.
    """
    name = name or path.rstrip("/").rsplit("/", 1)[-1]
    try:
        exists, is_file, _is_dir, mtime, length = _hadoop_status(spark, path, with_bytes)
        if not exists:
            return FileCheck(name, path, False, False, 0, "missing", None, None)
        key = (path, mtime, length)
        schema = _FOOTERS.get(key)
        if schema is None:
            schema = spark.read.parquet(path).schema
            _FOOTERS[key] = schema
        if not schema.fields:
            return FileCheck(name, path, True, is_file, 0, "no_columns", None, schema, length)
        return FileCheck(name, path, True, is_file, len(schema.fields), "ok", None, schema, length)
    except Exception as e:  # noqa: BLE001 - audit must not fail
        msg = str(e).strip().splitlines()[0][:300] if str(e).strip() else type(e).__name__
        return FileCheck(name, path, True, False, 0, "unreadable", msg, None)


def _audit_on_driver(spark: SparkSession, layout: MonthlyLayout, names: list[str], with_bytes: bool, threads: int = 16) -> list[FileCheck]:
    """For stores that only Spark's own reader can open."""
    if not names:
        return []
    with ThreadPoolExecutor(max_workers=min(threads, len(names))) as pool:
        return list(pool.map(lambda n: validate_file(spark, layout.path(n), n, with_bytes), names))


def footer_table(spark: SparkSession, layout: MonthlyLayout, names: list[str] | None = None) -> DataFrame | None:
    """Every Parquet part under the root (of these names) with what its footer says, read in tasks.

    (file_name, path, length, modificationTime, status, error, n_rows,
    columns), written under the shared folder; None where nothing is listed.
    """
    if not path_exists(spark, layout.root):
        return None
    parts = part_listing(spark, layout)
    if names is not None:
        wanted = spark.createDataFrame([(n,) for n in names], "file_name string").distinct()
        parts = parts.join(wanted, "file_name", "left_semi")
    path = scratch_path(spark, "footers")
    with_footers(parts).write.parquet(path)
    return spark.read.parquet(path)


#: From best to worst; a file of several parts is as good as its worst part.
_STATUS = (OK, EMPTY, RETRY, MISSING, BROKEN, UNKNOWN_STORE)


def audit_files(spark: SparkSession, layout: MonthlyLayout, names: list[str], with_bytes: bool = False) -> list[FileCheck]:
    """S2 over many files, in the order of ``names``.

    Footers are read in tasks (``footer_table``); the driver gets one small row
    for each file and each distinct schema once. The parts of a file may
    differ: its schema is their join, and ``parts`` lists them by schema.
    Names that the listing does not hold, and stores that tasks can't open,
    are looked up through Spark one by one. ``with_bytes`` adds their sizes.
    """
    feet = footer_table(spark, layout, names) if names else None
    found: dict[str, FileCheck] = {}
    if feet is not None:
        tagged = feet.withColumn("_schema", F.sha2("columns", 256)).withColumn("_rank", F.array_position(F.array(*map(F.lit, _STATUS)), F.col("status")))
        schemas = {r["_schema"]: T.StructType.fromJson(json.loads(r["columns"])) for r in tagged.where("columns IS NOT NULL").groupBy("_schema").agg(F.first("columns").alias("columns")).collect()}
        rows = tagged.groupBy("file_name").agg(
            F.sum("length").alias("bytes"), F.sum("n_rows").alias("n_rows"), F.max(F.struct("_rank", "status", "error")).alias("worst"),
            F.max(F.endswith("path", F.concat(F.lit("/"), F.col("file_name")))).alias("is_file"), F.sort_array(F.collect_set("_schema")).alias("schemas"),
        )
        mixed = rows.where((F.size("schemas") > 1) & (F.col("worst.status") == OK)).select("file_name")
        by_schema: dict[str, dict[str, list[str]]] = {}
        for r in tagged.join(mixed, "file_name", "left_semi").select("file_name", "_schema", "path").orderBy("path").collect():
            by_schema.setdefault(r["file_name"], {}).setdefault(r["_schema"], []).append(r["path"])
        for r in rows.collect():
            name, status = r["file_name"], r["worst"]["status"]
            if status == UNKNOWN_STORE:
                continue
            path = layout.path(name)
            if status not in (OK, EMPTY):
                found[name] = FileCheck(name, path, True, False, 0, "unreadable", r["worst"]["error"], None, r["bytes"])
                continue
            schema, _ = join_schemas(schemas[k] for k in r["schemas"])
            parts = tuple((schemas[k], tuple(paths)) for k, paths in by_schema.get(name, {}).items())
            found[name] = FileCheck(name, path, True, r["is_file"], len(schema.fields), status, None, schema, r["bytes"], r["n_rows"], parts)
    rest = [n for n in dict.fromkeys(names) if n not in found]
    found |= {c.file_name: c for c in _audit_on_driver(spark, layout, rest, with_bytes)}
    return [found[n] for n in names]


def audit_frame(spark: SparkSession, checks: list[FileCheck]) -> DataFrame:
    rows = [(c.file_name, c.path, c.exists, c.is_file, c.bytes, c.n_columns, c.status, c.error) for c in checks]
    schema = "file_name string, path string, exists boolean, is_file boolean, bytes bigint, n_columns int, status string, error string"
    return spark.createDataFrame(rows, schema)


def columns_frame(spark: SparkSession, checks: list[FileCheck]) -> DataFrame:
    """S3: one row per (file, column) of the valid files."""
    rows = [
        (c.file_name, i, f.name, f.dataType.simpleString())
        for c in checks
        if c.status == "ok"
        for i, f in enumerate(c.schema.fields)
    ]
    return spark.createDataFrame(rows, "file_name string, position int, column string, type string")


def read_month(spark: SparkSession, layout: MonthlyLayout, year: int, month: int, roles: TripRoles = DEFAULT_ROLES) -> DataFrame | None:
    """One month, all columns, or None when the file does not validate."""
    name = roles.file_name(year, month)
    check = validate_file(spark, layout.path(name), name)
    if check.status != "ok":
        return None
    return spark.read.parquet(check.path)


def _tag(df: DataFrame, layout: MonthlyLayout) -> DataFrame:
    return df.withColumn("source_file", source_name(df.sparkSession, layout, F.col("_metadata.file_path")))


def read_all(spark: SparkSession, layout: MonthlyLayout, names: list[str] | None = None, roles: TripRoles = DEFAULT_ROLES) -> DataFrame | None:
    """Every valid month, tagged with ``source_file``; invalid ones skipped.

    Files are grouped by identical footer schema and each group is read with
    one ``spark.read.parquet(*paths)`` and one projection onto the joined
    schema (``plans.lattice``): numbers widen, and a column that is a number
    here and text there is text, with every value. The plan has one branch per
    distinct schema, not per month. ``type_conflicts`` lists what drifted.
    """
    if names is None:
        names = [roles.file_name(y, m) for y, m in roles.periods()]
    return read_checked(spark, layout, audit_files(spark, layout, names))


def _by_schema(checks: list[FileCheck]) -> dict[str, tuple[T.StructType, list[str]]]:
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for c in checks:
        if c.status == "ok":
            for schema, paths in c.parts or ((c.schema, (c.path,)),):
                groups.setdefault(schema.json(), (schema, []))[1].extend(paths)
    return groups


def type_conflicts(checks: list[FileCheck]) -> list[TypeConflict]:
    """The columns that the valid files of an audit hold in several types, and what became of them."""
    return join_schemas(schema for schema, _ in _by_schema(checks).values())[1]


def read_checked(spark: SparkSession, layout: MonthlyLayout, checks: list[FileCheck]) -> DataFrame | None:
    """The valid files of an audit as one frame (see :func:`read_all`)."""
    groups = _by_schema(checks)
    if not groups:
        return None
    joined, _ = join_schemas(schema for schema, _ in groups.values())
    frames = [as_joined(_tag(spark.read.schema(schema).parquet(*paths), layout), joined, ("source_file",)) for schema, paths in groups.values()]
    return reduce(lambda a, b: a.union(b), frames)


def load_counts(df: DataFrame, checks: list[FileCheck] | None = None) -> DataFrame:
    """Rows and columns per source file.

    With the audit of the load, every valid file has a row, one without rows
    too, and the columns are the file's own; without it, the columns are
    those of the frame.
    """
    counts = df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    if checks is None:
        n_cols = len([c for c in df.columns if c != "source_file"])
        return counts.withColumn("n_columns", F.lit(n_cols).cast("int"))
    files = df.sparkSession.createDataFrame([(c.file_name, c.n_columns) for c in checks if c.status == "ok"], "source_file string, n_columns int")
    return files.join(counts, "source_file", "left").select("source_file", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"), "n_columns")
