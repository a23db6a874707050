"""Session helpers: building a local session for tests and resolving the
shared folder (``spark.checkpoint.dir``) where derived tables and stream
checkpoints are written."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tripaudit") -> SparkSession:
    """Local session used by tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRIPAUDIT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # wide projections and aggregates compile to large methods; let the
        # JIT compile them instead of interpreting their bytecode
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Only a local-mode session without the setting
    (tests, the driver's local check) gets a fresh scratch folder of its own;
    on a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="tripaudit-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


#: The JVM only interprets methods of more bytes than this, unless it is told otherwise.
METHOD_LIMIT, MOST_METHOD, COMPILES_ALL = "spark.sql.codegen.hugeMethodLimit", 8000, "-XX:-DontCompileHugeMethods"


def bound_methods(spark: SparkSession) -> None:
    """Lower the session's limit of generated methods to what the JVM compiles; a lower one stays.

    A stage that passes it runs operator by operator, each compiled, instead
    of as one interpreted method. Not needed where executors compile all.
    """
    where = "spark.driver.extraJavaOptions" if spark.sparkContext.master.startswith("local[") else "spark.executor.extraJavaOptions"
    if COMPILES_ALL not in (spark.sparkContext.getConf().get(where) or "") and int(spark.conf.get(METHOD_LIMIT)) > MOST_METHOD:
        spark.conf.set(METHOD_LIMIT, str(MOST_METHOD))


WRITERS, MOST_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 32


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within it keep up to ``MOST_WRITERS`` files of a task open instead of sorting its rows.

    A task with more partition values sorts the rest, as without it.
    """
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(max(int(before), MOST_WRITERS)))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


_SCRATCH: dict[str, list[str]] = {}
#: Called by release_scratch: modules that keep handles on scratch tables forget them.
ON_RELEASE: list = []


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the tables that this application wrote under the shared folder so far.

    For long sessions: call it once the results that read them are written.
    Tables that were kept for the session are written anew when next asked
    for. Returns how many paths were deleted.
    """
    sc, done = spark.sparkContext, 0
    for forget in ON_RELEASE:
        forget()
    for path in _SCRATCH.pop(sc.applicationId, []):
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        done += bool(p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True))
    return done


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: a restarted context gets a new key."""
    return (id(spark), spark.sparkContext.applicationId)
