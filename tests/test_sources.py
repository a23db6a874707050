"""Monthly files with drifting schemas, junk and gaps; listing; sampling; sinks."""

from __future__ import annotations

import os

from tripaudit.config import DEFAULT_ROLES
from tripaudit.sources import files as FS
from tripaudit.sources.sample import sample_rows
from tripaudit.sources.sink import export_monthly, read_trips, write_trips

ROLES = DEFAULT_ROLES.with_(year_start=2024, year_end=2024, months=(1, 2, 3, 4, 5))


def _write_months(spark, root):
    spark.createDataFrame([(1, 10.0), (2, 11.0)], "a bigint, fare double").write.parquet(f"{root}/green_tripdata_2024-01.parquet")
    spark.createDataFrame([(1.5, 12.0, 0.5)], "a double, fare double, extra double").write.parquet(
        f"{root}/green_tripdata_2024-02.parquet"
    )
    spark.createDataFrame([(3, 13.0), (4, 14.0), (5, 15.0)], "a bigint, fare double").write.parquet(
        f"{root}/green_tripdata_2024-03.parquet"
    )
    with open(f"{root}/green_tripdata_2024-04.parquet", "wb") as fh:
        fh.write(b"not a parquet file at all")
    # 2024-05 is missing


def test_file_names(spark):
    assert DEFAULT_ROLES.file_name(2025, 1) == "green_tripdata_2025-01.parquet"
    rows = FS.period_files(spark, ROLES).collect()
    assert [r["file_name"] for r in rows][:2] == ["green_tripdata_2024-01.parquet", "green_tripdata_2024-02.parquet"]
    assert DEFAULT_ROLES.periods()[0] == (2021, 1) and len(DEFAULT_ROLES.periods()) == 60


def test_audit_drift_junk_and_gap(spark, scratch):
    root = os.path.join(scratch, "raw")
    os.makedirs(root)
    _write_months(spark, root)
    layout = FS.MonthlyLayout(root, partition_key=None)
    names = [ROLES.file_name(y, m) for y, m in ROLES.periods()]
    checks = {c.file_name: c for c in FS.audit_files(spark, layout, names)}
    assert checks["green_tripdata_2024-01.parquet"].status == "ok"
    assert checks["green_tripdata_2024-02.parquet"].n_columns == 3
    assert checks["green_tripdata_2024-04.parquet"].status == "unreadable"
    assert checks["green_tripdata_2024-04.parquet"].is_file is False
    assert checks["green_tripdata_2024-05.parquet"].status == "missing"

    df = FS.read_all(spark, layout, names, ROLES)
    assert df.count() == 6
    types = dict(df.dtypes)
    assert types["a"] == "double" and types["extra"] == "double"
    counts = {r["source_file"]: r["n_rows"] for r in FS.load_counts(df).collect()}
    assert counts == {
        "green_tripdata_2024-01.parquet": 2,
        "green_tripdata_2024-02.parquet": 1,
        "green_tripdata_2024-03.parquet": 3,
    }
    assert FS.read_month(spark, layout, 2024, 4, ROLES) is None
    assert FS.read_month(spark, layout, 2024, 3, ROLES).count() == 3
    cols = FS.columns_frame(spark, list(checks.values())).where("file_name = 'green_tripdata_2024-02.parquet'").collect()
    assert [r["column"] for r in sorted(cols, key=lambda r: r["position"])] == ["a", "fare", "extra"]


def test_listing_flat(spark, scratch):
    root = os.path.join(scratch, "raw2")
    os.makedirs(root)
    _write_months(spark, root)
    got = {r["file_name"] for r in FS.file_listing(spark, FS.MonthlyLayout(root, None)).collect()}
    assert got == {f"green_tripdata_2024-0{m}.parquet" for m in (1, 2, 3, 4)}


def test_export_roundtrip_and_listing(spark, scratch):
    from tripaudit.chain import trips

    src = trips(spark, "/root/testdata/sf0.001")
    layout = export_monthly(src, os.path.join(scratch, "monthly"), "lpep_pickup_datetime", DEFAULT_ROLES)
    listing = FS.file_listing(spark, layout).collect()
    n_months = src.selectExpr("count(distinct date_format(lpep_pickup_datetime, 'yyyy-MM'))").collect()[0][0]
    assert len(listing) == n_months
    names = [r["file_name"] for r in listing]
    back = FS.read_all(spark, layout, names)
    assert back.count() == src.count()
    assert back.drop("source_file").exceptAll(src).count() == 0


def test_sample_is_repeatable_and_whole_rows(spark):
    from tripaudit.chain import trips

    src = trips(spark, "/root/testdata/sf0.001")
    a = sample_rows(src, 3, seed=7).collect()
    b = sample_rows(src, 3, seed=7).collect()
    assert a == b and len(a) == 3 and len(a[0]) == len(src.columns)


def test_partitioned_trip_sink(spark, scratch):
    from tripaudit.chain import featured_trips

    from pyspark.sql import functions as F

    feat = featured_trips(spark, "/root/testdata/sf0.001").withColumn("source_file", F.concat(F.lit("f"), F.col("pickup_year"), F.lit(".parquet")))
    out = os.path.join(scratch, "featured")
    write_trips(feat, out)
    back = spark.read.parquet(out)
    assert back.count() == feat.count()
    plan = back.where("source_file = 'f1997.parquet'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "source_file" in plan


def test_stray_rows_of_another_month_survive_its_run(spark, scratch):
    rows = lambda month, n, strays: [(f"2024-0{month}-05 10:00:00",)] * n + [(f"2024-0{s}-28 23:50:00",) for s in strays]
    out = os.path.join(scratch, "trips")
    frame = lambda data, name: spark.createDataFrame(data, "t string").selectExpr("to_timestamp(t) AS t", f"'{name}' AS source_file")
    write_trips(frame(rows(1, 100, []), "jan.parquet"), out)
    write_trips(frame(rows(2, 80, [1, 1]), "feb.parquet"), out)
    assert {r["source_file"]: r["count"] for r in read_trips(spark, out).groupBy("source_file").count().collect()} == {"jan.parquet": 100, "feb.parquet": 82}
    write_trips(frame(rows(1, 90, []), "jan.parquet"), out)
    assert read_trips(spark, out).count() == 172 and read_trips(spark, out).where("month(t) = 1").count() == 92


def test_any_file_name_is_listed_and_counted(spark, scratch):
    root = os.path.join(scratch, "any")
    os.makedirs(root)
    spark.createDataFrame([(1, 2.0)], "a bigint, b double").write.parquet(f"{root}/fhvhv_tripdata_2024-01.parquet")
    spark.createDataFrame([(1,)], "a bigint").write.parquet(f"{root}/zones.parquet")
    spark.createDataFrame([], "a bigint, b double, c string").write.parquet(f"{root}/deep.d/none.parquet")
    layout = FS.MonthlyLayout(root, None)
    names = ["fhvhv_tripdata_2024-01.parquet", "zones.parquet", "deep.d/none.parquet"]
    assert sorted(r["file_name"] for r in FS.file_listing(spark, layout).collect()) == sorted(names)
    checks = FS.audit_files(spark, layout, names)
    got = {r["source_file"]: (r["n_rows"], r["n_columns"]) for r in FS.load_counts(FS.read_checked(spark, layout, checks), checks).collect()}
    assert got == {"fhvhv_tripdata_2024-01.parquet": (1, 2), "zones.parquet": (1, 1), "deep.d/none.parquet": (0, 3)}


def test_rows_without_pickup_time_are_kept(spark, scratch):
    df = spark.createDataFrame([("2024-01-05 10:00:00", 1), (None, 2)], "t string, k int").selectExpr("to_timestamp_ntz(t) AS lpep_pickup_datetime", "k")
    layout = export_monthly(df, os.path.join(scratch, "m"), "lpep_pickup_datetime")
    names = [r["file_name"] for r in FS.periods_in_data(df, "lpep_pickup_datetime").collect()]
    assert sorted(names) == ["green_tripdata_2024-01.parquet", "green_tripdata_unknown.parquet"] and FS.read_all(spark, layout, names).count() == 2


def test_hot_month_is_split_across_files(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.range(200000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise((F.col("id") % 12) + 1).alias("pickup_month"),
        (F.col("id") * 1.5).alias("fare_amount"),
    ).selectExpr("*", "concat('m', pickup_month, '.parquet') AS source_file")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        out = os.path.join(scratch, "hot")
        write_trips(df, out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = os.path.join(out, "source_file=m1.parquet")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(out).count() == 200000


def test_drifting_months_through_conform_and_features(spark, scratch):
    from pyspark.sql import functions as F

    from tripaudit.chain import trips
    from tripaudit.operators.conform import conform
    from tripaudit.operators.features import add_features

    src = trips(spark, "/root/testdata/sf0.001")
    root = os.path.join(scratch, "drift")
    old = src.where(F.year("lpep_pickup_datetime") == 1996).drop("cbd_congestion_fee").withColumn(
        "passenger_count", F.col("passenger_count").cast("bigint")
    )
    new = src.where(F.year("lpep_pickup_datetime") == 2001)
    old.where(F.month("lpep_pickup_datetime") == 3).write.parquet(f"{root}/green_tripdata_1996-03.parquet")
    new.where(F.month("lpep_pickup_datetime") == 3).write.parquet(f"{root}/green_tripdata_2001-03.parquet")
    roles = DEFAULT_ROLES.with_(year_start=1996, year_end=2001, months=(3,))
    df = FS.read_all(spark, FS.MonthlyLayout(root, None), None, roles)
    assert dict(df.dtypes)["passenger_count"] == "double" and "cbd_congestion_fee" in df.columns
    out, plan = conform(df)
    feat = add_features(out).cache()
    rows = feat.where("source_file = 'green_tripdata_1996-03.parquet'").select(
        "expected_fare", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee",
    ).collect()
    assert rows
    for r in rows:
        assert r["cbd_congestion_fee"] is None
        parts = [r[c] or 0.0 for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge")]
        assert abs(r["expected_fare"] - sum(parts)) < 1e-6
    assert {v.column: v.verdict for v in plan.casts}["passenger_count"] == "converted"
    assert feat.count() == old.where(F.month("lpep_pickup_datetime") == 3).count() + new.where(F.month("lpep_pickup_datetime") == 3).count()


def test_audit_reports_bytes(spark, scratch):
    root = os.path.join(scratch, "raw3")
    os.makedirs(root)
    _write_months(spark, root)
    layout = FS.MonthlyLayout(root, partition_key=None)
    checks = {c.file_name: c for c in FS.audit_files(spark, layout, [ROLES.file_name(2024, m) for m in (1, 4, 5)], with_bytes=True)}
    assert checks["green_tripdata_2024-01.parquet"].bytes > 0
    assert checks["green_tripdata_2024-04.parquet"].bytes is None or checks["green_tripdata_2024-04.parquet"].status == "unreadable"
    assert checks["green_tripdata_2024-05.parquet"].bytes is None
    frame = FS.audit_frame(spark, list(checks.values()))
    assert "bytes" in frame.columns
