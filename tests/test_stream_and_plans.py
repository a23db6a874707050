"""Stream = batch, plan shape (pruning, no Python UDFs), fixture facts, oracle sweep."""

from __future__ import annotations

import os

import duckdb
import pytest

from tripaudit.chain import featured_trips, plan_for, trips
from tripaudit.sources.sink import export_monthly
from tripaudit.streaming.ingest import run_incremental_ingest

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_and_restart_is_idempotent(spark, scratch):
    src = trips(spark, SF)
    layout = export_monthly(src, os.path.join(scratch, "monthly"), "lpep_pickup_datetime")
    schema = spark.read.parquet(layout.root).schema
    n_files = sum(f.endswith(".parquet") for _, _, fs in os.walk(layout.root) for f in fs)
    sink, ckpt = os.path.join(scratch, "sink"), os.path.join(scratch, "ckpt")
    plan = plan_for(spark, SF)
    run_incremental_ingest(spark, layout.root, schema, plan, sink, ckpt, max_files_per_trigger=n_files // 4, timeout_s=600)
    assert len([d for d in os.listdir(sink + "-ledger") if d.startswith("batch=")]) >= 4
    out = spark.read.parquet(sink).drop("source_file", "file_key")
    assert out.where("cast_rejects IS NOT NULL").count() == 0
    batch = featured_trips(spark, SF)
    cols = [c for c in batch.columns if c not in ("pickup_year", "pickup_month")]
    assert out.count() == batch.count()
    assert out.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    # a second run over the same checkpoint finds nothing new
    run_incremental_ingest(spark, layout.root, schema, plan, sink, ckpt, max_files_per_trigger=16, timeout_s=600)
    assert spark.read.parquet(sink).count() == batch.count()


def _plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned(spark):
    from tripaudit.operators.summaries import trips_by_hour

    feat = featured_trips(spark, SF)
    text = _plan_text(trips_by_hour(feat))
    read = [line for line in text.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert read, text
    joined = " ".join(read)
    assert "pickup_hour" in joined and "trip_duration_min" in joined
    assert "fare_amount" not in joined and "total_amount" not in joined


def test_filter_is_pushed_down(spark):
    feat = featured_trips(spark, SF)
    text = _plan_text(feat.where("trip_distance > 50").select("trip_distance"))
    assert "PushedFilters" in text and "GreaterThan(trip_distance" in text


def test_no_python_udf_in_registered_plans(spark):
    from tripaudit.results import load_all

    skip = {"incremental_ingest"}  # runs a stream when called
    for name, (fn, _) in load_all().items():
        if name in skip:
            continue
        text = _plan_text(fn(spark, SF))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name
        assert "CartesianProduct" not in text, name


def test_fixture_facts_sf001(spark):
    feat = featured_trips(spark, "/root/testdata/sf0.01")
    sums = feat.selectExpr(
        "count(*) AS n", "sum(is_invalid_PULocation) AS pu", "sum(is_invalid_DOLocation) AS do",
        "sum(is_same_zone) AS same", "sum(is_zero_passenger) AS zero", "sum(is_invalid_ratecodeID) AS rate",
        "sum(is_invalid_payment) AS pay", "sum(is_cash_with_tip) AS cash", "sum(is_free_but_charged) AS free",
        "count_if(trip_duration_min < 0) AS neg", "count_if(trip_duration_min = 0) AS zero_dur",
        "count_if(fare_discrepancy IS NULL) AS null_disc",
    ).collect()[0].asDict()
    assert sums == {
        "n": 60000, "pu": 451, "do": 456, "same": 5015, "zero": 4612, "rate": 2938, "pay": 2847,
        "cash": 2621, "free": 18699, "neg": 575, "zero_dur": 616, "null_disc": 1024,
    }


def _duck(sf_dir):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "region", "part", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


FAST = [
    "trips_by_hour", "fare_by_weekday", "null_counts", "negative_durations", "flag_domains",
    "cast_verdicts", "narrowed_types", "cardinality_ratio", "category_codes", "footprint_report",
    "histograms", "box_stats", "pair_duration_distance", "anomaly_overlap", "discrepancy_bands",
    "tip_anomalies", "demand_profile", "fare_by_weekday_clean", "pair_correlations", "anomaly_ranking",
    "period_files", "load_counts", "unknown_period_counts", "file_listing", "written_trips", "row_sample",
    "string_pickups", "guarded_casts", "wide_category_codes", "edge_histograms", "edge_box_stats", "edge_density", "guards",
]


@pytest.mark.parametrize("name", FAST)
def test_oracle_small(spark, name):
    import __spark_entry__ as E

    sdf = E.queries()[name](spark, SF).toPandas()
    ddf = _duck(SF).execute(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    cols = sorted(sdf.columns)

    def norm(df):
        out = []
        for row in df[cols].itertuples(index=False, name=None):
            out.append(tuple(None if (v is None or (isinstance(v, float) and v != v)) else (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)) for v in row))
        return sorted(out, key=repr)

    assert norm(sdf) == norm(ddf)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert len(rows) == 24 and sum(r["n_trips"] for r in rows) > 0
