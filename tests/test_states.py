"""States that add up by file: columns, summaries; samples of cells; timestamp formats."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import functions as F

from tripaudit.chain import featured_trips, trips
from tripaudit.operators import batch_summaries as B
from tripaudit.operators import distributions as D
from tripaudit.operators import summaries as S
from tripaudit.operators.formats import chosen_formats, format_uses
from tripaudit.operators.states import file_states, merged_states, read_states, stats_from_states, update_states
from tripaudit.plans.profile import build_plan
from tripaudit.plans.store import plan_from_profiles, read_plan, read_profiles, update_profiles, write_plan
from tripaudit.sources.sink import write_by_source

SF = "/root/testdata/sf0.001"


def _values(spark, parts):
    rows = [(f"{name}.parquet", None if v is None else float(v)) for name, vals in parts.items() for v in vals]
    return spark.createDataFrame(rows, "source_file string, x double")


def test_states_merge_and_a_new_month_reads_itself_alone(spark, scratch):
    rng = np.random.default_rng(2)
    parts = {"a": [*rng.normal(1e6, 1, 4000), None, np.nan, np.inf], "b": rng.normal(1e6 + 5, 3, 1000), "c": [None], "d": rng.integers(0, 9, 500)}
    path = os.path.join(scratch, "states")
    update_states(_values(spark, {k: parts[k] for k in "abc"}), path, ("x",))
    kept = {f: os.stat(os.path.join(path, f)).st_mtime_ns for f in os.listdir(path) if f.startswith("source_file=")}
    update_states(_values(spark, {"d": parts["d"]}), path, ("x",), ["d.parquet"])
    assert all(os.stat(os.path.join(path, f)).st_mtime_ns == t for f, t in kept.items())
    whole = np.array([v for p in parts.values() for v in p if v is not None and np.isfinite(v)])
    got = merged_states(read_states(spark, path)).first()
    assert (got["n_rows"], got["n"], got["vmin"], got["vmax"]) == (sum(map(len, parts.values())), len(whole), whole.min(), whole.max())
    assert np.isclose(got["sd"], whole.std(ddof=1), rtol=1e-9)
    assert abs(got["n_distinct"] / len(set(whole)) - 1) < 0.1
    # seeds from the sketches, exact results
    df = _values(spark, parts)
    a = D.box_stats(spark, df, columns=("x",), stats=stats_from_states(read_states(spark, path))).first()
    assert tuple(a) == tuple(D.box_stats(spark, df, columns=("x",)).first())
    # a month that became empty loses its state; one that is computed again counts once
    update_states(_values(spark, {"b": parts["b"]}), path, ("x",), ["a.parquet", "b.parquet"])
    assert merged_states(read_states(spark, path)).first()["n"] == 1500


def test_states_of_nothing(spark):
    assert merged_states(file_states(_values(spark, {}), ("x", "absent"))).count() == 0
    only = file_states(_values(spark, {"a": [None]}), ("x",))
    assert stats_from_states(only)["x"] == {"n": 0, "min": None, "max": None, "sd": None, "approx": None}


def test_summaries_of_batches_equal_those_of_the_table(spark, scratch):
    feat = featured_trips(spark, SF).withColumn("batch", (F.col("l_orderkey") % 7).cast("string"))
    path = os.path.join(scratch, "summaries")
    for k in (0, 1, 2, 1, 3):  # batch 1 comes twice
        rows = feat.where((F.col("batch") == str(k)) if k < 3 else F.col("batch") >= "3")
        write_by_source(B.summary_states(rows, "batch"), path, column="batch")
    merged = B.merged_summaries(spark.read.parquet(path)).cache()
    same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert same(B.null_counts(merged), S.null_counts(feat))
    assert same(B.negative_durations(merged), S.negative_durations(feat))
    assert same(B.flag_domains(merged), S.flag_domains(feat))
    assert same(B.trips_by_hour(merged), S.trips_by_hour(feat))
    assert same(B.fare_by_weekday(merged), S.fare_by_weekday(feat))


def test_sample_of_cells_is_repeatable_and_limited_before_the_shuffle(spark):
    feat = featured_trips(spark, SF)
    keys = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    a = D.pair_sample(feat, "distance_fare", keys, 4)
    rows = sorted(map(tuple, a.collect()))
    assert rows == sorted(map(tuple, D.pair_sample(feat.repartition(5), "distance_fare", keys, 4).collect()))
    cells = {(r["bin_x"], r["bin_y"]): r["n_rows"] for r in D.pair_table(feat, "distance_fare").collect()}
    taken = {}
    for r in rows:
        taken[r[1:3]] = taken.get(r[1:3], 0) + 1
    assert taken == {c: min(4, n) for c, n in cells.items()}
    assert sorted(map(tuple, D.pair_sample(feat, "distance_fare", keys, 4, seed=1).collect())) != rows
    assert a._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2  # partial, then final
    assert D.pair_sample(feat.limit(0), "distance_fare", keys).count() == 0


def test_formats_are_chosen_by_what_they_parse(spark):
    texts = ["2024-01-02 03:04:05"] * 3 + ["13/02/2024 00:00:00"] * 5 + ["03/04/2024 00:00:00", "no time", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    uses = {u.format: u for u in format_uses(df, ("t",))}
    iso, day, month = (uses[f] for f in ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm:ss"))
    assert (iso.n_parsed, day.n_parsed, month.n_parsed) == (3, 6, 1)
    assert (day.rank, iso.rank, month.rank) == (0, 1, 2) and month.n_conflicts == 1 and day.n_conflicts == 0
    assert uses["dd.MM.yyyy HH:mm"].rank is None and {u.n_values for u in uses.values()} == {11}
    assert chosen_formats(list(uses.values()), "t")[0] == "dd/MM/yyyy HH:mm:ss"
    assert [u.n_parsed for u in format_uses(df.limit(0), ("t",))] == [0] * 5


def test_profiles_of_files_merge_to_the_plan_of_the_whole(spark, scratch):
    trips_df = trips(spark, SF)
    tagged = trips_df.withColumn("source_file", F.concat(F.year("lpep_pickup_datetime").cast("string"), F.lit(".parquet")))
    years = sorted(r[0] for r in tagged.select("source_file").distinct().collect())
    path = os.path.join(scratch, "profiles")
    update_profiles(tagged.where(F.col("source_file").isin(years[:3])), path)
    # one year lacks a column, another holds whole numbers as text in one
    update_profiles(tagged.where(F.col("source_file") == years[3]).drop("congestion_surcharge"), path)
    update_profiles(tagged.where(F.col("source_file").isin(years[4:])).withColumn("extra", F.col("extra").cast("string")), path)
    update_profiles(tagged.where(F.col("source_file") == years[0]), path)  # once more
    got = plan_from_profiles(*read_profiles(spark, path))
    whole = tagged.withColumn("congestion_surcharge", F.when(F.col("source_file") != years[3], F.col("congestion_surcharge"))).withColumn("extra", F.col("extra").cast("string")).drop("source_file")
    assert got == build_plan(whole)
    assert {v.column: v.verdict for v in got.casts}["extra"] == "failed"
    write_plan(spark, got, f"{scratch}/plan.json")
    assert read_plan(spark, f"{scratch}/plan.json") == got
    # a file that became empty counts no longer
    update_profiles(tagged.limit(0), path, sources=years)
    assert plan_from_profiles(*read_profiles(spark, path)).rows == 0
