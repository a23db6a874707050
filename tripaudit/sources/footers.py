"""Parquet footers read in tasks.

A listing of paths is dealt over the cluster and every task opens its files'
footers: schema, rows, or what is wrong. The driver sees no file. Errors that
may pass (the store does not answer, the file is gone) are told apart from
files that are broken, which a later try would not mend. A store that the
tasks' file systems don't know is reported as such; the caller asks Spark's
own reader there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

OK, EMPTY, BROKEN, MISSING, RETRY, UNKNOWN_STORE = "ok", "no_columns", "broken", "missing", "retry", "unknown_store"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
_UNSIGNED = {pa.uint8(): T.ShortType(), pa.uint16(): T.IntegerType(), pa.uint32(): T.LongType(), pa.uint64(): T.DecimalType(20, 0)}
FIELDS = "status string, error string, n_rows long, columns string"


def plain_path(path: Column) -> Column:
    """A listed path in one form: local files without their scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def _field(name: str, t: pa.DataType) -> T.StructField:
    if pa.types.is_dictionary(t):
        t = t.value_type
    if pa.types.is_timestamp(t) and t.unit == "ns":
        raise TypeError(f"column {name}: timestamps of nanoseconds can't be read")
    return T.StructField(name, _UNSIGNED.get(t) or from_arrow_type(t, prefer_timestamp_ntz=True))


def schema_of(arrow: pa.Schema) -> T.StructType:
    """The schema that Spark reads a file with."""
    own = (arrow.metadata or {}).get(_SPARK_SCHEMA)
    if own:
        return T.StructType.fromJson(json.loads(own))
    return T.StructType([_field(f.name, f.type) for f in arrow])


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    parts = urlsplit(path) if "://" in path else None
    if parts is None or parts.scheme == "file":
        return pafs.LocalFileSystem(), "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path
    fs, root = pafs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/")
    return fs, root.rstrip("/") + path.split(parts.netloc, 1)[1]


def read_footer(path: str) -> tuple[str, str | None, int | None, str | None]:
    """(status, error, rows, schema as JSON) of one file; raises nothing."""
    try:
        fs, inner = _store(path)
    except Exception as e:  # noqa: BLE001 - a store that tasks can't open
        return UNKNOWN_STORE, _message(e), None, None
    try:
        with fs.open_input_file(inner) as source:
            meta = pq.ParquetFile(source)
            schema = schema_of(meta.schema_arrow)
            status = OK if schema.fields else EMPTY
            return status, None, meta.metadata.num_rows, schema.json()
    except FileNotFoundError as e:
        return MISSING, _message(e), None, None
    except Exception as e:  # noqa: BLE001 - whatever a broken file makes of the reader
        return RETRY if isinstance(e, OSError) and e.errno is not None else BROKEN, _message(e), None, None


def _message(e: Exception) -> str:
    text = str(e).strip()
    return text.splitlines()[0][:300] if text else type(e).__name__


def with_footers(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """``files`` (with ``path``) and for each the fields of its footer; spread over the cluster, or over so many tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_footer(p) for p in batch.column("path").to_pylist()]
            columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "status", "error", "n_rows", "columns"])

    schema = T.StructType([*files.schema.fields, *T.StructType.fromDDL(FIELDS).fields])
    tasks = tasks or files.sparkSession.sparkContext.defaultParallelism * 4
    return files.repartition(tasks).mapInArrow(run, schema)
