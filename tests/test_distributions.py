"""Distribution summaries against brute force in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT_ROLES
from tripaudit.operators import distributions as D
from tripaudit.operators.quantiles import exact_quantiles


def _frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def test_histogram_edge_values(spark):
    df = _frame(spark, [0, 1, 2, 50])
    h = {r["bin"]: r["n_rows"] for r in D.histograms(df, columns=("x",)).collect()}
    assert len(h) == 50
    assert {b for b, n in h.items() if n} == {0, 1, 2, 49}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.normal(10, 3, 3000), rng.integers(0, 5, 500), [80000.0, -40.0]])
    vals = np.round(vals, 2)
    df = _frame(spark, list(vals) + [None])
    got = sorted((r["bin"], r["n_rows"]) for r in D.histograms(df, columns=("x",)).collect())
    counts, _ = np.histogram(vals, bins=np.linspace(vals.min(), vals.max(), 51))
    assert [n for _, n in got] == list(counts)


def test_constant_column_histogram(spark):
    df = _frame(spark, [3.0, 3.0, 3.0])
    rows = {r["bin"]: (r["bin_lo"], r["n_rows"]) for r in D.histograms(df, columns=("x",)).collect()}
    counts, edges = np.histogram(np.array([3.0, 3.0, 3.0]), bins=50)
    assert [rows[i][1] for i in range(50)] == list(counts)
    assert rows[0][0] == edges[0]


@pytest.mark.parametrize("seed", [4, 5, 6, 7])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 4000))
    kind = seed % 3
    if kind == 0:
        vals = rng.normal(0, 1, n)
    elif kind == 1:
        vals = rng.integers(0, 7, n).astype(float)  # heavy ties
    else:
        vals = np.concatenate([rng.exponential(1.0, n), [1e9]])  # outlier stretches the range
    df = _frame(spark, vals)
    long = D.numeric_long(df, ("x",))
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    bounds = {"x": (len(vals), float(vals.min()), float(vals.max()))}
    got = exact_quantiles(spark, long, probs, bounds, buckets=64)["x"]
    want = np.percentile(vals, [p * 100 for p in probs])
    for p, w in zip(probs, want):
        assert got[p] == pytest.approx(w, rel=0, abs=1e-12 * max(1.0, abs(w)))


def _box_reference(x, whis=1.5):
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo, hi = q1 - whis * iqr, q3 + whis * iqr
    wisk_hi = x[x <= hi]
    whishi = q3 if len(wisk_hi) == 0 or np.max(wisk_hi) < q3 else np.max(wisk_hi)
    wisk_lo = x[x >= lo]
    whislo = q1 if len(wisk_lo) == 0 or np.min(wisk_lo) > q1 else np.min(wisk_lo)
    fliers = x[(x < whislo) | (x > whishi)]
    return q1, med, q3, whislo, whishi, len(fliers)


@pytest.mark.parametrize("seed", [8, 9])
def test_box_stats_match_reference(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.normal(20, 5, 2000).round(2), [500.0, -300.0, 700.0]])
    df = _frame(spark, vals)
    r = D.box_stats(spark, df, columns=("x",)).collect()[0]
    q1, med, q3, wlo, whi, nf = _box_reference(vals)
    assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, med, q3), abs=1e-9)
    assert (r["whisker_lo"], r["whisker_hi"], r["n_fliers"]) == (wlo, whi, nf)


def test_box_stats_fixture_facts(spark):
    from tripaudit.chain import featured_trips

    rows = {r["column"]: r for r in D.box_stats(spark, featured_trips(spark, "/root/testdata/sf0.01")).collect()}
    fare = rows["fare_amount"]
    assert (fare["q1"], fare["median"], fare["q3"], fare["whisker_lo"], fare["whisker_hi"], fare["n_fliers"]) == (
        21.0, 40.5, 60.0, -37.0, 78.0, 296)
    dist = rows["trip_distance"]
    assert (dist["q1"], dist["median"], dist["q3"], dist["whisker_lo"], dist["whisker_hi"], dist["n_fliers"]) == (
        3.0, 6.25, 9.5, 0.0, 12.5, 57)


def test_density_close_to_exact_kde(spark):
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.normal(0, 1, 3000), rng.normal(6, 0.5, 1000)])
    df = _frame(spark, vals)
    got = sorted((r["point"], r["x"], r["density"]) for r in D.density_curves(df, columns=("x",)).collect())
    n = len(vals)
    h = vals.std(ddof=1) * n ** (-0.2)
    grid = np.linspace(vals.min(), vals.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / h) ** 2).sum(axis=1) / (n * h * np.sqrt(2 * np.pi))
    xs = np.array([x for _, x, _ in got])
    dens = np.array([d for _, _, d in got])
    assert np.allclose(xs, grid, rtol=0, atol=1e-12)
    assert np.max(np.abs(dens - exact)) < 1e-3 * exact.max()


@pytest.mark.parametrize("moments, width", [(2, 0.5), (4, 0.5), (6, 0.25), (12, 0.25)])
def test_density_stays_within_its_error_bound(spark, moments, width):
    rng = np.random.default_rng(4)
    vals = np.concatenate([rng.normal(0, 1, 900), rng.normal(4, 0.1, 300), [-3.0, 40.0, 40.0]])
    got = sorted((r["point"], r["density"]) for r in D.density_curves(_frame(spark, vals), columns=("x",), moments=moments, width=width).collect())
    n = len(vals)
    h = vals.std(ddof=1) * n ** (-0.2)
    grid = np.linspace(vals.min(), vals.max(), 200)
    exact = np.exp(-0.5 * ((grid[:, None] - vals[None, :]) / h) ** 2).sum(axis=1)
    off = np.abs(np.array([d for _, d in got]) * n * h * np.sqrt(2 * np.pi) - exact).max()
    assert off <= n * (D.density_error_bound(moments, width) + 1e-13)
    assert D.density_error_bound() < 1e-15


def test_density_states_of_parts_add_up(spark):
    rng = np.random.default_rng(5)
    vals = rng.gamma(2.0, 3.0, 4000)
    df = _frame(spark, vals)
    stats = D.numeric_stats(df, ("x",))
    whole = {r["bin"]: tuple(r)[2:] for r in D.density_moments(df, stats, ["x"]).collect()}
    parts = [D.density_moments(_frame(spark, vals[k::3]), stats, ["x"]) for k in range(3)]
    both = parts[0].union(parts[1]).union(parts[2]).groupBy("column", "bin").agg(*[F.sum(f"m{k}").alias(f"m{k}") for k in range(D.MOMENTS)])
    summed = {r["bin"]: tuple(r)[2:] for r in both.collect()}
    assert summed.keys() == whole.keys() and len(whole) < 400
    assert all(np.allclose(summed[b], whole[b], rtol=1e-9, atol=1e-12) for b in whole)


def test_pair_bins_match_histogram2d(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(5, 2, 1000).round(2)
    y = (x * 3 + rng.normal(0, 1, 1000)).round(2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "trip_distance double, fare_amount double")
    got = {(r["bin_x"], r["bin_y"]): r["n_rows"] for r in D.pair_bins(df, "distance_fare", "trip_distance", "fare_amount").collect()}
    h, _, _ = np.histogram2d(x, y, bins=[np.linspace(x.min(), x.max(), 51), np.linspace(y.min(), y.max(), 51)])
    want = {(i, j): int(h[i, j]) for i in range(50) for j in range(50) if h[i, j]}
    assert got == want


def test_histogram_counts_sum_to_non_null(spark):
    from tripaudit.chain import featured_trips

    feat = featured_trips(spark, "/root/testdata/sf0.001")
    h = D.histograms(feat).groupBy("column").sum("n_rows").collect()
    for r in h:
        assert r["sum(n_rows)"] == feat.where(feat[r["column"]].isNotNull()).count()
    assert DEFAULT_ROLES.hist_bins == 50


def test_approximate_box_stats_close(spark):
    rng = np.random.default_rng(13)
    vals = rng.normal(50, 10, 5000).round(3)
    df = _frame(spark, vals)
    r = D.box_stats(spark, df, columns=("x",), exact=False).collect()[0]
    q1, med, q3, *_ = _box_reference(vals)
    span = vals.max() - vals.min()
    assert abs(r["q1"] - q1) < 0.01 * span and abs(r["median"] - med) < 0.01 * span and abs(r["q3"] - q3) < 0.01 * span


def test_wrong_seeds_still_give_exact_quantiles(spark):
    rng = np.random.default_rng(14)
    vals = rng.normal(0, 1, 3000)
    long = D.numeric_long(_frame(spark, vals), ("x",))
    bounds = {"x": (len(vals), float(vals.min()), float(vals.max()))}
    bad = {"x": [5.0, 6.0, -9.0, -8.0, 0.0, 0.0]}  # brackets that miss every rank
    got = exact_quantiles(spark, long, (0.25, 0.5, 0.75), bounds, buckets=32, approx=bad)["x"]
    want = np.percentile(vals, [25, 50, 75])
    assert [got[p] for p in (0.25, 0.5, 0.75)] == pytest.approx(list(want), abs=1e-12)


def test_nan_is_left_out_of_distributions(spark):
    vals = [1.0, 2.0, float("nan"), 3.0, 4.0, None]
    df = _frame(spark, vals)
    h = D.histograms(df, columns=("x",)).groupBy().sum("n_rows").collect()[0][0]
    assert h == 4
    r = D.box_stats(spark, df, columns=("x",)).collect()[0]
    assert (r["n"], r["median"]) == (4, 2.5)
    assert D.density_curves(df, columns=("x",)).count() == 200
