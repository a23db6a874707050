"""Steps that moved, sorted or interpreted more than their work needs."""

from __future__ import annotations

import contextlib
import io
import os
import re

import numpy as np
import pytest
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT_ROLES
from tripaudit.operators import distributions as D
from tripaudit.operators import formats as FO
from tripaudit.operators.states import file_states, merged_states
from tripaudit.results.sources import _replace_files
from tripaudit.session import METHOD_LIMIT, WRITERS, bound_methods, open_writers
from tripaudit.sources import sink
from tripaudit.sources.fixture import sources_of_trips, trips_from_lineitem
from tripaudit.streaming import ingest

PICKUP = "lpep_pickup_datetime"


@pytest.fixture
def lineitem(spark):
    return spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")


def test_replaced_files_are_dealt_over_tasks(spark, tmp_path):
    folder = str(tmp_path / "file=x")
    _replace_files(spark.range(0, 300, 1, 4), folder, 3)
    first = sorted(os.listdir(folder))
    _replace_files(spark.range(0, 3000, 1, 4), folder, 3)
    names = [n for n in sorted(os.listdir(folder)) if n.endswith(".parquet") and not n.startswith(".")]
    assert names == [n for n in first if n.endswith(".parquet") and not n.startswith(".")] and len(names) == 3
    sizes = [spark.read.parquet(f"{folder}/{n}").count() for n in names]
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_export_moves_what_trips_are_made_of(spark, lineitem, tmp_path):
    """The same monthly files, from a shuffle of a quarter of the columns."""
    moved = []

    def build(rows):
        moved.extend(rows.columns)
        return trips_from_lineitem(rows)

    a = sink.export_monthly(trips_from_lineitem(lineitem), str(tmp_path / "a"), PICKUP)
    b = sink.export_monthly(sources_of_trips(lineitem), str(tmp_path / "b"), PICKUP, DEFAULT_ROLES, build)
    x, y = (spark.read.parquet(layout.root) for layout in (a, b))
    assert x.columns == y.columns and x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    assert 4 * len(moved) <= 5 * len(sources_of_trips(lineitem).columns) and len(moved) < len(x.columns) / 2


def test_rows_read_by_file_are_written_without_a_shuffle(spark, lineitem, tmp_path, monkeypatch):
    layout = sink.export_monthly(trips_from_lineitem(lineitem), str(tmp_path / "m"), PICKUP)
    rows = spark.read.parquet(layout.root).withColumnRenamed("file", "source_file")
    sink.write_trips(rows, str(tmp_path / "shuffled"))

    def no_shuffle(*_):
        raise AssertionError("shuffled")

    monkeypatch.setattr(sink, "_spread", no_shuffle)
    sink.write_trips(rows, str(tmp_path / "direct"), by_file=True)
    x, y = (spark.read.parquet(str(tmp_path / n)) for n in ("shuffled", "direct"))
    assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def test_ingest_writes_without_a_shuffle(spark, tmp_path, monkeypatch):
    from tripaudit.plans.profile import build_plan

    src = trips_from_lineitem(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")).limit(200)
    layout = sink.export_monthly(src, str(tmp_path / "m"), PICKUP)
    src = spark.read.parquet(layout.root).drop("file")
    parts = [os.path.join(p, n) for p, _, names in os.walk(layout.root) for n in names if n.endswith(".parquet")]
    plan = build_plan(src)

    def no_hint(*_):
        raise AssertionError("shuffled")

    monkeypatch.setattr(type(src), "hint", no_hint)
    raw = ingest.read_files(spark, layout, [(src.schema, parts)], src.schema)
    ingest._write(raw, plan, DEFAULT_ROLES, str(tmp_path / "sink"))
    assert spark.read.parquet(str(tmp_path / "sink")).count() == src.count()


def test_open_writers_restores_the_setting(spark):
    before = spark.conf.get(WRITERS)
    with pytest.raises(ValueError), open_writers(spark):
        assert int(spark.conf.get(WRITERS)) >= 32
        raise ValueError
    assert spark.conf.get(WRITERS) == before


def test_methods_stay_within_what_the_jvm_compiles():
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Session:
        def __init__(self, options, limit):
            self.conf, self.sparkContext, self.master = Conf({METHOD_LIMIT: limit}), self, "spark://x"
            self.options = options

        def getConf(self):
            return {"spark.executor.extraJavaOptions": self.options}

    for options, limit, want in ((None, "65535", "8000"), (None, "4000", "4000"), ("-XX:-DontCompileHugeMethods", "65535", "65535")):
        session = Session(options, limit)
        bound_methods(session)
        assert session.conf[METHOD_LIMIT] == want


def _method_sizes(df: DataFrame) -> list[int]:
    spark = df.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out = io.StringIO()
    try:
        with contextlib.redirect_stdout(out):
            df.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_density_sums_are_a_method_that_the_jvm_compiles(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2000).select(*[(F.rand(i) * 100).alias(f"c{i}") for i in range(8)]).write.parquet(path)
    df = spark.read.parquet(path)
    cols = [f"c{i}" for i in range(8)]
    sizes = _method_sizes(D.density_moments(df, D.numeric_stats(df, tuple(cols)), cols))
    assert sizes and max(sizes) < 8000


def test_profile_brackets_hold_the_quantiles(spark):
    values = np.random.default_rng(5).lognormal(size=20000)
    df = spark.createDataFrame([Row(x=float(v), y=None) for v in values], "x double, y double")
    st = D.numeric_stats(df, ("x", "y"))
    a, exact = st["x"]["approx"], np.quantile(values, D.QUANTILE_PROBS)
    assert all(a[2 * j] <= q <= a[2 * j + 1] for j, q in enumerate(exact)) and st["y"]["approx"] is None
    plan = df.agg(*D.numeric_stat_exprs(["x"]))._jdf.queryExecution().toString()
    assert "percentile_approx" not in plan


def test_distinct_sketches_take_hashes(spark):
    df = spark.range(6000).select(F.lit("f").alias("source_file"), F.when(F.col("id") % 2 == 0, (F.col("id") % 1000) / 7).alias("x"))
    states = file_states(df, ("x",))
    assert "as string" not in states._jdf.queryExecution().optimizedPlan().toString().lower()
    assert abs(merged_states(states).first()["n_distinct"] / 500 - 1) < 0.05


def test_each_format_parses_once(spark, monkeypatch):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("01/02/2024 03:04:05",), ("no",), (None,)], "t string")
    seen = []
    agg = type(df).agg

    def spy(self, *exprs):
        out = agg(self, *exprs)
        seen.append(out)
        return out

    monkeypatch.setattr(type(df), "agg", spy)
    uses = {u.format: u for u in FO.format_uses(df, ("t",))}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("gettimestamp(") == len(FO.CANDIDATES)
    assert uses["MM/dd/yyyy HH:mm:ss"].n_parsed == 1 and uses["dd/MM/yyyy HH:mm:ss"].n_conflicts == 1 and uses[FO.CANDIDATES[0]].n_values == 3
