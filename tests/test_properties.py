"""Property tests: exact quantiles and histogram binning against numpy."""

from __future__ import annotations

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripaudit.operators import distributions as D
from tripaudit.operators.quantiles import exact_quantiles

values = st.lists(
    st.one_of(
        st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False, width=32),
        st.sampled_from([0.0, 1.0, 1.0, 2.5, -3.25]),  # ties
    ),
    min_size=1,
    max_size=300,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(vals=values, buckets=st.sampled_from([2, 3, 16, 4096]))
def test_quantiles_equal_numpy(spark, vals, buckets):
    arr = np.array(vals, dtype=float)
    df = spark.createDataFrame([(float(v),) for v in arr], "x double")
    long = D.numeric_long(df, ("x",))
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = exact_quantiles(spark, long, probs, {"x": (len(arr), float(arr.min()), float(arr.max()))}, buckets=buckets)["x"]
    want = np.percentile(arr, [p * 100 for p in probs])
    for p, w in zip(probs, want):
        assert abs(got[p] - w) <= 1e-9 * max(1.0, abs(w))


@SETTINGS
@given(vals=values)
def test_histogram_equals_numpy(spark, vals):
    arr = np.array(vals, dtype=float)
    df = spark.createDataFrame([(float(v),) for v in arr], "x double")
    got = sorted((r["bin"], r["n_rows"]) for r in D.histograms(df, columns=("x",)).collect())
    lo, hi = arr.min(), arr.max()
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    counts, _ = np.histogram(arr, bins=np.linspace(lo, hi, 51))
    assert [n for _, n in got] == list(counts)


money = st.floats(min_value=-500, max_value=500, allow_nan=False, allow_infinity=False, width=32)


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(
            money, money, money, money, st.one_of(st.none(), money),
            st.floats(min_value=0, max_value=1000, allow_nan=False, width=32),
            st.integers(min_value=-600, max_value=90000),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_float32_features_equal_numpy(spark, rows):
    import datetime as dt

    from pyspark.sql import types as T

    from tripaudit.operators.features import add_features

    t0 = dt.datetime(2024, 5, 1, 8, 0)
    data = [
        (i, float(f), float(e), float(tip), float(toll), None if c is None else float(c), float(d), t0, t0 + dt.timedelta(seconds=s))
        for i, (f, e, tip, toll, c, d, s) in enumerate(rows)
    ]
    schema = T.StructType(
        [T.StructField("id", T.IntegerType())]
        + [T.StructField(n, T.FloatType()) for n in ("fare_amount", "extra", "tip_amount", "tolls_amount", "congestion_surcharge", "trip_distance")]
        + [T.StructField("lpep_pickup_datetime", T.TimestampNTZType()), T.StructField("lpep_dropoff_datetime", T.TimestampNTZType())]
    )
    out = add_features(spark.createDataFrame(data, schema)).orderBy("id").collect()
    for (f, e, tip, toll, c, d, s), r in zip(rows, out):
        comps = np.array([f, e, tip, toll, 0.0 if c is None else c], dtype=np.float32)
        acc = np.float32(0.0)
        for v in comps:  # left to right, in float32
            acc = np.float32(acc + v)
        assert np.float32(r["expected_fare"]) == acc
        assert np.float32(r["fare_discrepancy"]) == np.float32(abs(np.float32(f) - acc))
        dur = np.float32(s / 60)
        assert np.float32(r["trip_duration_min"]) == dur
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            spd = np.float32(np.float32(d) / np.float32(dur / np.float32(60)))
        if not np.isfinite(spd):
            spd = np.float32(0.0)
        assert np.float32(r["avg_speed_mph"]) == spd


def _numpy_verdict(vals: list, target: str) -> str:
    """The narrowing checks computed with numpy on the non-missing values."""
    a = np.array([v for v in vals if v is not None and not np.isnan(v)], dtype=np.float64)
    has_missing = len(a) < len(vals)
    if target == "float32":
        with np.errstate(over="ignore"):
            back = a.astype(np.float32).astype(np.float64)
        ok = bool(np.allclose(a, back, rtol=1e-4, atol=1e-6, equal_nan=False)) if len(a) else True
        return "converted" if ok else "kept_loss"
    lo, hi = (-128, 127) if target == "Int8" else (-32768, 32767)
    fits = bool(np.all(np.isfinite(a) & (a == np.floor(a)) & (a >= lo) & (a <= hi))) if len(a) else True
    if target == "Int8":
        return "converted" if fits else "failed"
    if has_missing or not bool(np.all(np.isfinite(a))):
        return "failed"
    return "converted" if fits else "kept_loss"


cast_values = st.lists(
    st.one_of(
        st.none(),
        st.just(float("nan")),
        st.sampled_from([0.0, 1.0, -128.0, 127.0, 128.0, 32767.0, 32768.0, 1.5, 1e39, float("inf"), 0.1, 3.4e38]),
        st.integers(min_value=-40000, max_value=40000).map(float),
        st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
    ),
    min_size=1,
    max_size=30,
)


@SETTINGS
@given(vals=cast_values)
def test_cast_verdicts_equal_numpy_checks(spark, vals):
    from tripaudit.config import DEFAULT_ROLES
    from tripaudit.plans.profile import build_plan

    df = spark.createDataFrame([(v,) for v in vals], "x double")
    if all(v is None or np.isnan(v) for v in vals):
        return  # an all-missing column is dropped before narrowing
    pairs = (("x", "float32"), ("x", "Int8"), ("x", "int16"))
    plan = build_plan(df, DEFAULT_ROLES.with_(narrow_targets=pairs, columns_to_drop=(), categorical_columns=()))
    got = {v.target: v.verdict for v in plan.casts}
    for _, target in pairs:
        assert got[target] == _numpy_verdict(vals, target), (target, vals)
