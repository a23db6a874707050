"""Files that drift, fail, come back or are replaced: type lattice, footers, guarded alignment, ledger, emptied sources."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.config import DEFAULT_ROLES as R
from tripaudit.operators.conform import guarded
from tripaudit.plans.lattice import join_schemas, join_types
from tripaudit.plans.profile import build_plan
from tripaudit.sources import files as FS
from tripaudit.sources.footers import read_footer, with_footers
from tripaudit.sources.sink import read_trips, write_trips
from tripaudit.streaming import ledger as L
from tripaudit.streaming.ingest import ingest_files, run_incremental_ingest, take_outstanding

DECIMALS = st.tuples(st.integers(1, 38), st.integers(0, 38)).filter(lambda x: x[1] <= x[0]).map(lambda x: T.DecimalType(*x))
TYPES = st.one_of(
    st.sampled_from([T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BinaryType()]),
    DECIMALS,
)


@settings(max_examples=500, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_types_form_a_semilattice(a, b, c):
    assert join_types(a, a) == a
    assert join_types(a, b) == join_types(b, a)
    assert join_types(join_types(a, b), c) == join_types(a, join_types(b, c))


def test_conflicts_are_named(spark):
    one = T.StructType.fromDDL("a bigint, b int, c string, d timestamp_ntz, e int")
    two = T.StructType.fromDDL("a double, b bigint, c double, d timestamp, f int")
    joined, conflicts = join_schemas([one, two])
    assert joined.simpleString() == "struct<a:double,b:bigint,c:string,d:timestamp_ntz,e:int,f:int>"
    assert {c.column: c.kind for c in conflicts} == {"a": "inexact", "b": "widened", "c": "text", "d": "zoned"}


def test_text_and_number_months_are_read_whole(spark, scratch):
    root = os.path.join(scratch, "raw")
    spark.createDataFrame([("cash", 1), ("7", 2), (None, 3)], "payment_type string, k int").write.parquet(f"{root}/one.parquet")
    spark.createDataFrame([(4, 5), (None, 6)], "payment_type bigint, k bigint").write.parquet(f"{root}/two.parquet")
    # parts of one file may differ as well
    spark.createDataFrame([(2.5, 7)], "payment_type double, k int").write.parquet(f"{root}/three.parquet")
    spark.createDataFrame([(True, 8)], "payment_type boolean, k int").write.mode("append").parquet(f"{root}/three.parquet")
    layout = FS.MonthlyLayout(root, None)
    checks = FS.audit_files(spark, layout, ["one.parquet", "two.parquet", "three.parquet"])
    assert {c.file_name: (c.status, c.n_rows) for c in checks} == {"one.parquet": ("ok", 3), "two.parquet": ("ok", 2), "three.parquet": ("ok", 2)}
    df = FS.read_checked(spark, layout, checks)
    assert dict(df.dtypes) == {"payment_type": "string", "k": "bigint", "source_file": "string"}
    assert {r["k"]: r["payment_type"] for r in df.collect()} == {1: "cash", 2: "7", 3: None, 5: "4", 6: None, 7: "2.5", 8: "true"}
    assert {c.column: c.kind for c in FS.type_conflicts(checks)} == {"payment_type": "text", "k": "widened"}


def test_footers_say_what_is_wrong(spark, scratch):
    pd.DataFrame({"a": pd.array([1, 2], "uint16"), "s": ["x", "y"], "t": pd.to_datetime(["2024-01-01", None]).astype("datetime64[us]"), "c": pd.Categorical(["p", "q"])}).to_parquet(f"{scratch}/a b+%41.parquet")
    pd.DataFrame({"t": pd.to_datetime(["2024-01-01"])}).astype("datetime64[ns]").to_parquet(f"{scratch}/nanos.parquet")
    with open(f"{scratch}/junk.parquet", "w") as out:
        out.write("no table")
    names = ["a b+%41.parquet", "nanos.parquet", "junk.parquet", "gone.parquet"]
    frame = spark.createDataFrame([(f"file:{scratch}/{n}",) for n in names], "path string")
    got = {r["path"].rsplit("/", 1)[1]: r for r in with_footers(frame).collect()}
    good = got[names[0]]
    assert good["status"] == "ok" and good["n_rows"] == 2
    schema = T.StructType.fromJson(__import__("json").loads(good["columns"]))
    assert schema == spark.read.parquet(f"{scratch}/a b+%41.parquet").schema
    assert {n: got[n]["status"] for n in names[1:]} == {"nanos.parquet": "broken", "junk.parquet": "broken", "gone.parquet": "missing"}
    assert read_footer("nostore://host/x.parquet")[0] == "unknown_store"


@pytest.mark.parametrize(
    "own, target, cases",
    [
        ("double", "bigint", [(1.0, 1), (1.5, "no"), (300.25, "no"), (1e30, "no"), (None, None)]),
        ("bigint", "tinyint", [(127, 127), (128, "no")]),
        ("string", "bigint", [("12", 12), ("cash", "no"), ("1.5", "no")]),
        ("string", "double", [("1.5", 1.5), ("", "no")]),
        ("double", "string", [(1.5, "1.5")]),
        ("bigint", "double", [(5, 5.0), (2**53 + 1, "no")]),
        ("boolean", "bigint", [(True, "no"), (None, None)]),
        ("timestamp_ntz", "bigint", [(None, None)]),
    ],
)
def test_alignment_keeps_or_rejects_each_value(spark, own, target, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, x {own}")
    value, ok = guarded(F.col("x"), df.schema["x"].dataType, T.StructType.fromDDL(f"y {target}")["y"].dataType)
    got = {r["i"]: r["y"] if r["ok"] else "no" for r in df.select("i", value.alias("y"), ok.alias("ok")).collect()}
    assert got == {i: c[1] for i, c in enumerate(cases)}


def _rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("lpep_pickup_datetime"), F.lit("2024-01-05 10:10:00").cast("timestamp_ntz").alias("lpep_dropoff_datetime"),
        F.col("id").alias("PULocationID"), F.lit(1.0).alias("fare_amount"),
    )


def _single(df, path):
    df.toPandas().astype({"lpep_pickup_datetime": "datetime64[us]", "lpep_dropoff_datetime": "datetime64[us]"}).to_parquet(path)


def _state(spark, sink, ledger):
    entries = {r["source_file"]: (r["state"], r["attempt"], r["n_rows"]) for r in L.current(L.read_ledger(spark, ledger)).collect()}
    rows = {r["source_file"]: r["count"] for r in spark.read.parquet(sink).groupBy("source_file").count().collect()}
    return entries, rows


def test_ingest_loses_nothing(spark, scratch):
    root, sink, ckpt = (os.path.join(scratch, n) for n in ("in", "out", "ckpt"))
    os.makedirs(root)
    a, b, c, d = (f"{root}/{n}.parquet" for n in "abcd")
    _single(_rows(spark, 5), a)
    _single(_rows(spark, 4).withColumn("PULocationID", F.col("PULocationID") + 0.5), b)  # no whole numbers
    with open(c, "w") as out:
        out.write("broken")
    _single(_rows(spark, 3), d)
    schema, plan, ledger = _rows(spark, 1).schema, build_plan(_rows(spark, 9)), f"{sink}-ledger"

    def run():
        return run_incremental_ingest(spark, root, schema, plan, sink, ckpt, max_files_per_trigger=2, timeout_s=300, partition_key=None)

    run()
    entries, rows = _state(spark, sink, ledger)
    assert entries == {"a.parquet": ("taken", 1, 5), "b.parquet": ("taken", 1, 4), "c.parquet": ("rejected", 1, None), "d.parquet": ("taken", 1, 3)}
    assert rows == {"a.parquet": 5, "b.parquet": 4, "d.parquet": 3}
    rejected = spark.read.parquet(sink).where("source_file = 'b.parquet'").select("PULocationID", F.col("cast_rejects")["PULocationID"]).collect()
    assert sorted(map(tuple, rejected)) == [(None, "0.5"), (None, "1.5"), (None, "2.5"), (None, "3.5")]
    # replaced: longer, mended, emptied; and nothing changes without a change
    _single(_rows(spark, 8), a)
    _single(_rows(spark, 2), c)
    _single(_rows(spark, 0), d)
    for _ in range(2):
        run()
        entries, rows = _state(spark, sink, ledger)
        assert entries == {"a.parquet": ("taken", 1, 8), "b.parquet": ("taken", 1, 4), "c.parquet": ("taken", 1, 2), "d.parquet": ("taken", 1, 0)}
        assert rows == {"a.parquet": 8, "b.parquet": 4, "c.parquet": 2}


def test_a_file_that_is_gone_is_tried_again_and_then_listed(spark, scratch):
    root, sink = (os.path.join(scratch, n) for n in ("in", "out"))
    os.makedirs(root)
    _single(_rows(spark, 5), f"{root}/a.parquet")
    _single(_rows(spark, 2), f"{root}/b.parquet")
    schema, plan, ledger, layout = _rows(spark, 1).schema, build_plan(_rows(spark, 9)), f"{sink}-ledger", FS.MonthlyLayout(root, None)
    listed = FS.part_listing(spark, layout).select("path", "length", F.col("modificationTime").alias("modified")).collect()
    os.rename(f"{root}/a.parquet", f"{scratch}/away")
    ingest_files(spark, layout, listed, schema, plan, sink, ledger, "0")
    assert _state(spark, sink, ledger) == ({"a.parquet": ("retry", 1, None), "b.parquet": ("taken", 1, 2)}, {"b.parquet": 2})
    ingest_files(spark, layout, listed, schema, plan, sink, ledger, "0")  # the same batch once more
    assert _state(spark, sink, ledger)[0]["a.parquet"] == ("retry", 1, None)
    assert take_outstanding(spark, layout, schema, plan, sink, ledger) == 0  # not listed, still due
    ingest_files(spark, layout, listed[:1] if "a.parquet" in listed[0]["path"] else listed[1:], schema, plan, sink, ledger, "1")
    ingest_files(spark, layout, [r for r in listed if "a.parquet" in r["path"]], schema, plan, sink, ledger, "2")
    assert _state(spark, sink, ledger)[0]["a.parquet"] == ("rejected", 3, None)
    os.rename(f"{scratch}/away", f"{root}/a.parquet")
    os.utime(f"{root}/a.parquet", (2_000_000_000, 2_000_000_000))  # a new version
    assert take_outstanding(spark, layout, schema, plan, sink, ledger) == 1
    assert _state(spark, sink, ledger) == ({"a.parquet": ("taken", 1, 5), "b.parquet": ("taken", 1, 2)}, {"a.parquet": 5, "b.parquet": 2})


def test_a_file_that_fails_while_it_is_read_keeps_no_other_out(spark, scratch):
    root, sink = (os.path.join(scratch, n) for n in ("in", "out"))
    os.makedirs(root)
    for n in "ab":
        _single(_rows(spark, 3000), f"{root}/{n}.parquet")
    with open(f"{root}/a.parquet", "r+b") as f:  # sound footer, broken pages
        f.seek(4)
        f.write(os.urandom(900))
    schema, plan, ledger, layout = _rows(spark, 1).schema, build_plan(_rows(spark, 9)), f"{sink}-ledger", FS.MonthlyLayout(root, None)
    listed = FS.part_listing(spark, layout).select("path", "length", F.col("modificationTime").alias("modified")).collect()
    ingest_files(spark, layout, listed, schema, plan, sink, ledger, "0")
    entries, rows = _state(spark, sink, ledger)
    assert {k: v[:2] for k, v in entries.items()} == {"a.parquet": ("retry", 1), "b.parquet": ("taken", 1)} and rows == {"b.parquet": 3000}


def test_an_emptied_source_loses_its_rows(spark, scratch):
    out = os.path.join(scratch, "trips")
    both = spark.createDataFrame([(1, "a=1.parquet"), (2, "b.parquet"), (3, "c.parquet")], "k int, source_file string")
    write_trips(both, out)
    write_trips(both.where("k = 2"), out, ["a=1.parquet", "b.parquet"])
    assert sorted(r["k"] for r in read_trips(spark, out).select("k").collect()) == [2, 3]
