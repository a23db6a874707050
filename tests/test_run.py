"""The batch entry point over exported monthly files."""

from __future__ import annotations

import os

from tripaudit.chain import trips
from tripaudit.config import DEFAULT_ROLES
from tripaudit.run import run
from tripaudit.sources.sink import export_monthly


def test_run_over_monthly_files(spark, scratch):
    src = trips(spark, "/root/testdata/sf0.001")
    layout = export_monthly(src, os.path.join(scratch, "raw"), "lpep_pickup_datetime")
    out = os.path.join(scratch, "out")
    roles = DEFAULT_ROLES.with_(year_start=1995, year_end=2001)
    lines = []
    res = run(spark, layout.root, out, roles, layout="partitioned", echo=lines.append)
    assert res["status"] == "ok"
    assert res["report"]["rows"] == src.count()
    assert res["skipped"] == []
    names = {os.path.basename(p) for p in res["written"]}
    assert {"histograms", "box_stats", "trips_by_hour", "pair_distance_fare", "null_counts"} <= names
    assert spark.read.parquet(os.path.join(out, "trips")).count() == src.count()
    audit = {r["file_name"]: r["status"] for r in spark.read.parquet(os.path.join(out, "reports", "file_audit")).collect()}
    assert audit["green_tripdata_2001-12.parquet"] == "missing"
    assert {"anomaly_counts", "anomaly_ranking", "demand_profile"} <= names
    # the same files once more, in two runs: the table and its reports stay whole
    again = os.path.join(scratch, "again")
    for years in ((1995, 1997), (1998, 2001), (1995, 1997)):
        run(spark, layout.root, again, roles.with_(year_start=years[0], year_end=years[1]), layout="partitioned", echo=lines.append)
    for table in ("box_stats", "histograms", "pair_distance_fare"):
        a, b = (spark.read.parquet(os.path.join(d, "reports", table)) for d in (out, again))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())), table
    one = run(spark, layout.root, os.path.join(scratch, "one"), roles, 1996, 3, layout="partitioned", echo=lines.append)
    assert one["status"] == "ok" and one["report"]["rows"] < src.count()
    none = run(spark, layout.root, os.path.join(scratch, "none"), roles, 2030, 1, layout="partitioned", echo=lines.append)
    assert none["status"] == "no_data"


def test_released_scratch_is_gone_and_built_anew(spark):
    from tripaudit.chain import featured_trips
    from tripaudit.session import release_scratch

    n = featured_trips(spark, "/root/testdata/sf0.001").count()
    assert release_scratch(spark) >= 2 and release_scratch(spark) == 0
    assert featured_trips(spark, "/root/testdata/sf0.001").count() == n
