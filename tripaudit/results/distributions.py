"""Registered results: histograms, densities, box statistics, pair tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as O
from ..chain import featured_trips, numeric_profile
from ..config import DEFAULT_ROLES
from ..operators import distributions as D
from ..operators.states import merged_states, read_states, stats_from_states, update_states
from ..session import ON_RELEASE, scratch_path, session_key
from ..sources.files import period_file
from ..sources.fixture import read_table
from ..sources.sink import SOURCE
from . import register

NUM = DEFAULT_ROLES.eda_numeric
BINS = DEFAULT_ROLES.hist_bins

LONG = (
    ",\nlong AS (SELECT \"column\", value FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM)
    + " FROM feat) ON " + ", ".join(NUM) + " INTO NAME \"column\" VALUE value)),\n"
    "stats AS (SELECT \"column\", count(value) AS n, min(value) AS vmin, max(value) AS vmax, "
    "stddev_samp(value) AS sd FROM long GROUP BY \"column\")"
)


def bin_sql(v: str, lo: str, hi: str, bins: int) -> str:
    step = f"(({hi} - {lo}) / CAST({bins} AS DOUBLE))"
    b0 = f"least(greatest(CAST(floor(({v} - {lo}) / {step}) AS INTEGER), 0), {bins - 1})"
    down = f"(CASE WHEN {b0} > 0 AND {v} < {b0} * {step} + {lo} THEN {b0} - 1 ELSE {b0} END)"
    return f"(CASE WHEN {down} < {bins - 1} AND {v} >= ({down} + 1) * {step} + {lo} THEN {down} + 1 ELSE {down} END)"


def _hist_sql(base: str = O.BASE.rstrip("\n") + LONG) -> str:
    return (
        base + ",\n"
        "rng AS (SELECT \"column\", CASE WHEN vmin = vmax THEN vmin - 0.5 ELSE vmin END AS lo, "
        "CASE WHEN vmin = vmax THEN vmax + 0.5 ELSE vmax END AS hi FROM stats),\n"
        f"binned AS (SELECT \"column\", {bin_sql('value', 'lo', 'hi', BINS)} AS bin FROM long JOIN rng USING (\"column\")),\n"
        "counts AS (SELECT \"column\", bin, count(*) AS n FROM binned GROUP BY \"column\", bin),\n"
        f"grid AS (SELECT \"column\", lo, hi, CAST(unnest(range(0, {BINS})) AS INTEGER) AS bin FROM rng)\n"
        f"SELECT g.\"column\", g.bin, g.bin * ((hi - lo) / CAST({BINS} AS DOUBLE)) + lo AS bin_lo, "
        f"CASE WHEN g.bin = {BINS - 1} THEN hi ELSE (g.bin + 1) * ((hi - lo) / CAST({BINS} AS DOUBLE)) + lo END AS bin_hi, "
        "CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows FROM grid g LEFT JOIN counts c ON g.\"column\" = c.\"column\" AND g.bin = c.bin"
    )


@register("histograms", _hist_sql())
def q_histograms(spark, sf_dir):
    return D.histograms(featured_trips(spark, sf_dir), stats=numeric_profile(spark, sf_dir))


def _box_sql(base: str = O.BASE.rstrip("\n") + LONG) -> str:
    return (
        base + ",\n"
        "q AS (SELECT \"column\", count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, "
        "quantile_cont(value, 0.75) AS q3 FROM long GROUP BY \"column\"),\n"
        "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS flo, q3 + 1.5 * (q3 - q1) AS fhi FROM q),\n"
        "a AS (SELECT \"column\", min(CASE WHEN value >= flo THEN value END) AS wlo, "
        "max(CASE WHEN value <= fhi THEN value END) AS whi, count_if(value < flo) AS bf, count_if(value < q1) AS bq1, "
        "count_if(value > fhi) AS af, count_if(value > q3) AS aq3 FROM long JOIN f USING (\"column\") GROUP BY \"column\")\n"
        "SELECT \"column\", n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, "
        "round(CASE WHEN wlo IS NOT NULL AND wlo <= q1 THEN wlo ELSE q1 END, 6) AS whisker_lo, "
        "round(CASE WHEN whi IS NOT NULL AND whi >= q3 THEN whi ELSE q3 END, 6) AS whisker_hi, "
        "CAST((CASE WHEN wlo IS NOT NULL AND wlo <= q1 THEN bf ELSE bq1 END) + "
        "(CASE WHEN whi IS NOT NULL AND whi >= q3 THEN af ELSE aq3 END) AS BIGINT) AS n_fliers "
        "FROM f JOIN a USING (\"column\")"
    )


@register("box_stats", _box_sql())
def q_box_stats(spark, sf_dir):
    b = D.box_stats(spark, featured_trips(spark, sf_dir), stats=numeric_profile(spark, sf_dir))
    return b.select(
        "column", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_fliers"
    )


def _states(spark, sf_dir):
    """States by month: of all months but the last at first, then of that one, which alone is read."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _STATES:
        feat = featured_trips(spark, sf_dir)
        by_month = feat.select(*[c for c in NUM if c in feat.columns], period_file(F.col("lpep_pickup_datetime")).alias(SOURCE))
        last = by_month.agg(F.max(SOURCE)).first()[0]
        path = scratch_path(spark, "states")
        update_states(by_month.where(F.col(SOURCE) != last), path, NUM)
        update_states(by_month.where(F.col(SOURCE) == last), path, NUM, [last])
        _STATES[key] = path
    return read_states(spark, _STATES[key])


_STATES: dict = {}
ON_RELEASE.append(_STATES.clear)


@register("column_states", O.BASE.rstrip("\n") + LONG + "\nSELECT \"column\", (SELECT count(*) FROM feat) AS n_rows, n, vmin, vmax, round(sd, 6) AS sd, true AS distinct_close FROM stats")
def q_column_states(spark, sf_dir):
    """Merged from monthly states; the estimate of the distinct values is held against their exact number."""
    got = merged_states(_states(spark, sf_dir))
    exact = D.numeric_long(featured_trips(spark, sf_dir), NUM).groupBy("column").agg(F.count_distinct("value").alias("_exact"))
    close = F.abs(F.col("n_distinct") / F.col("_exact") - 1) < 0.1
    return got.join(exact, "column").select("column", "n_rows", "n", "vmin", "vmax", F.round("sd", 6).alias("sd"), close.alias("distinct_close"))


@register("box_stats_by_month", _box_sql())
def q_box_stats_by_month(spark, sf_dir):
    """Exact box statistics whose search starts from the merged monthly sketches."""
    b = D.box_stats(spark, featured_trips(spark, sf_dir), stats=stats_from_states(_states(spark, sf_dir)))
    return b.select("column", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_fliers")


def _density_sql(base: str) -> str:
    """The exact density: the kernels of all values at every grid point."""
    g = DEFAULT_ROLES.kde_grid_points
    return (
        base + ",\n"
        "st AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM stats WHERE n >= 2 AND sd > 0),\n"
        "v AS (SELECT \"column\", value, count(*) AS w FROM long GROUP BY \"column\", value),\n"
        f"gx AS (SELECT \"column\", point, CASE WHEN point = {g - 1} THEN vmax "
        f"ELSE CAST(point AS DOUBLE) * ((vmax - vmin) / CAST({g - 1} AS DOUBLE)) + vmin END AS x, vmin, vmax, n, h "
        f"FROM st, (SELECT CAST(unnest(range(0, {g})) AS INTEGER) AS point)),\n"
        "s AS (SELECT gx.\"column\", point, x, n, h, vmin, vmax, sum(w * exp(-0.5 * ((x - value) / h) * ((x - value) / h))) AS s "
        "FROM gx JOIN v ON gx.\"column\" = v.\"column\" GROUP BY gx.\"column\", point, x, n, h, vmin, vmax)\n"
        "SELECT \"column\", point, x, "
        f"round(s / (n * h * sqrt(2 * pi())) * n * ((vmax - vmin) / CAST({BINS} AS DOUBLE)), 4) AS density_count FROM s"
    )


@register("density_curves", _density_sql(O.BASE.rstrip("\n") + LONG))
def q_density_curves(spark, sf_dir):
    d = D.density_curves(featured_trips(spark, sf_dir), stats=numeric_profile(spark, sf_dir))
    return d.select("column", "point", "x", F.round("density_count", 4).alias("density_count"))


# values that a chart has no place for: infinities among the quantities, and a constant column
_EDGE_FRAME = (
    "SELECT CASE WHEN l_orderkey % 500 = 1 THEN CAST('inf' AS DOUBLE) WHEN l_orderkey % 500 = 2 THEN CAST('-inf' AS DOUBLE) ELSE l_quantity END AS quantity, "
    "CAST(1 AS DOUBLE) AS constant, l_extendedprice AS price FROM lineitem"
)
_EDGE = ("quantity", "constant", "price")
_EDGE_LONG = (
    "WITH long AS (SELECT \"column\", value FROM (UNPIVOT (" + _EDGE_FRAME + ") ON quantity, constant, price INTO NAME \"column\" VALUE value) WHERE NOT isinf(value)),\n"
    "stats AS (SELECT \"column\", count(value) AS n, min(value) AS vmin, max(value) AS vmax, stddev_samp(value) AS sd FROM long GROUP BY \"column\")"
)


def _edge_frame(spark, sf_dir):
    x = F.when(F.col("l_orderkey") % 500 == 1, F.lit(float("inf"))).when(F.col("l_orderkey") % 500 == 2, F.lit(float("-inf"))).otherwise(F.col("l_quantity"))
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(x.alias("quantity"), F.lit(1.0).alias("constant"), F.col("l_extendedprice").alias("price"))


@register("edge_histograms", _hist_sql(_EDGE_LONG))
def q_edge_histograms(spark, sf_dir):
    return D.histograms(_edge_frame(spark, sf_dir), columns=_EDGE)


@register("edge_box_stats", _box_sql(_EDGE_LONG))
def q_edge_box_stats(spark, sf_dir):
    b = D.box_stats(spark, _edge_frame(spark, sf_dir), columns=_EDGE)
    return b.select("column", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_fliers")


@register("edge_density", _density_sql(_EDGE_LONG))
def q_edge_density(spark, sf_dir):
    d = D.density_curves(_edge_frame(spark, sf_dir), columns=_EDGE)
    return d.select("column", "point", "x", F.round("density_count", 4).alias("density_count"))


def _pair_sql(name: str, x: str, y: str) -> str:
    pb = DEFAULT_ROLES.pair_bins
    return (
        O.BASE.rstrip("\n") + ",\n"
        f"xy AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM feat WHERE {x} IS NOT NULL AND {y} IS NOT NULL),\n"
        "st AS (SELECT min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax FROM xy),\n"
        "rng AS (SELECT CASE WHEN xmin = xmax THEN xmin - 0.5 ELSE xmin END AS xlo, CASE WHEN xmin = xmax THEN xmax + 0.5 ELSE xmax END AS xhi, "
        "CASE WHEN ymin = ymax THEN ymin - 0.5 ELSE ymin END AS ylo, CASE WHEN ymin = ymax THEN ymax + 0.5 ELSE ymax END AS yhi FROM st)\n"
        f"SELECT '{name}' AS pair, {bin_sql('x', 'xlo', 'xhi', pb)} AS bin_x, {bin_sql('y', 'ylo', 'yhi', pb)} AS bin_y, count(*) AS n_rows "
        "FROM xy, rng GROUP BY bin_x, bin_y"
    )


_RANGES: dict = {}


def _ranges(spark, sf_dir, feat):
    """The axes of all pairs, once per session."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    if key not in _RANGES:
        _RANGES[key] = D.pair_ranges(feat)
    return _RANGES[key]


for _name, _x, _y in D.PAIRS:
    def _mk(name=_name):
        def fn(spark, sf_dir):
            feat = featured_trips(spark, sf_dir)
            return D.pair_table(feat, name, DEFAULT_ROLES.pair_bins, _ranges(spark, sf_dir, feat))

        return fn

    register(f"pair_{_name}", _pair_sql(_name, _x, _y))(_mk())


_SAMPLE_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
_PER_CELL = 3


def _pair_sample_sql(name: str, x: str, y: str) -> str:
    cells = _pair_sql(name, x, y)
    keys = ", ".join(_SAMPLE_KEYS)
    base = cells[: cells.index("SELECT '" + name)].replace("AS y FROM feat", f"AS y, {keys} FROM feat")
    pb = DEFAULT_ROLES.pair_bins
    return (
        base.rstrip() + f",\nbinned AS (SELECT {bin_sql('x', 'xlo', 'xhi', pb)} AS bin_x, {bin_sql('y', 'ylo', 'yhi', pb)} AS bin_y, {keys}, x, y FROM xy, rng)\n"
        f"SELECT '{name}' AS pair, *, CAST(row_number() OVER (PARTITION BY bin_x, bin_y ORDER BY md5(concat_ws('|', '42', {', '.join(f'CAST({k} AS VARCHAR)' for k in _SAMPLE_KEYS)})), x, y) AS INTEGER) AS pos "
        f"FROM binned QUALIFY pos <= {_PER_CELL}"
    )


for _name, _x, _y in D.PAIRS:
    def _mk_sample(name=_name):
        def fn(spark, sf_dir):
            feat = featured_trips(spark, sf_dir)
            return D.pair_sample(feat, name, _SAMPLE_KEYS, _PER_CELL, 42, DEFAULT_ROLES.pair_bins, _ranges(spark, sf_dir, feat))

        return fn

    register(f"pair_sample_{_name}", _pair_sample_sql(_name, _x, _y))(_mk_sample())
