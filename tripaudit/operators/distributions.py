"""Distribution summaries of the numeric columns.

All numeric columns are handled together in long form ``(column, value)``
(an ``unpivot``, i.e. an Expand feeding a partial aggregate in the same
stage), so one scan serves every column. Per-column constants (min, max,
n, stddev) live in a small stats table whose size is the number of
configured columns; it is broadcast explicitly into the binning step.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_ROLES, TripRoles
from ..functions.exprs import nan_to_null
from .quantiles import exact_quantiles


def _q(name: str):
    return F.col(f"`{name}`")


def _num(name: str):
    """The column as DOUBLE; NaN and infinities are missing (a chart has no place for them)."""
    x = nan_to_null(_q(name).cast("double"))
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def numeric_long(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, value DOUBLE) for the present columns, missing values removed."""
    cols = [c for c in columns if c in df.columns]
    wide = df.select(*[_num(c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "value").where(F.col("value").isNotNull())


QUANTILE_PROBS = (0.25, 0.5, 0.75)
APPROX_ACCURACY = 1000
#: Size of the KLL sketches of the profile: their rank error stays under the 3 / ``APPROX_ACCURACY`` that the brackets are wide.
PROFILE_KLL = 2000


def numeric_stat_exprs(columns: list[str], probs: tuple[float, ...] = QUANTILE_PROBS, accuracy: int = APPROX_ACCURACY) -> list:
    """Aggregates of one profile pass over the numeric columns (wide form).

    Usable in ``agg`` or as observed metrics of a write (``DataFrame.observe``).
    The approximate percentiles only seed the exact quantile search; they come
    from KLL sketches, at a third of the time of ``percentile_approx``.
    """
    from .quantiles import bracket_probs

    out = []
    for i, c in enumerate(columns):
        x = _num(c)
        sketch = F.kll_sketch_agg_double(x, F.lit(PROFILE_KLL))
        guess = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in bracket_probs(probs, accuracy)])
        out += [
            F.count(x).alias(f"n__{i}"),
            F.min(x).alias(f"min__{i}"),
            F.max(x).alias(f"max__{i}"),
            F.stddev_samp(x).alias(f"sd__{i}"),
            F.when(F.count(x) > 0, guess).alias(f"pa__{i}"),
        ]
    return out


def stats_from_row(columns: list[str], row: dict) -> dict:
    """column -> {n, min, max, sd, approx} from the aggregate row."""
    out = {}
    for i, c in enumerate(columns):
        out[c] = {
            "n": int(row[f"n__{i}"] or 0),
            "min": row[f"min__{i}"],
            "max": row[f"max__{i}"],
            "sd": row[f"sd__{i}"],
            "approx": list(row[f"pa__{i}"]) if row[f"pa__{i}"] is not None else None,
        }
    return out


def numeric_stats(df: DataFrame, columns: tuple[str, ...]) -> dict:
    """One aggregate pass (one small row to the driver)."""
    cols = [c for c in columns if c in df.columns]
    row = df.agg(*numeric_stat_exprs(cols)).collect()[0].asDict()
    return stats_from_row(cols, row)


def _range(st: dict) -> tuple[float, float]:
    lo, hi = st["min"], st["max"]
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def bin_columns(df: DataFrame, specs: list[tuple[str, F.Column, float, float]], bins: int, kept: list[tuple[str, F.Column]] | None = None) -> DataFrame:
    """Bin of each value among edges e_i = i*step + lo, step = (hi - lo)/bins.

    ``specs``: (output name, value expression, lo, hi). e_i <= v < e_{i+1};
    the last bin is closed; NULL stays NULL. A floor estimate is corrected
    by one step either way so edge values land exactly where an explicit
    edge search would put them. ``kept``: other columns to carry along. Written as three projections so each stage
    computes its inputs once (smaller generated code than one nested CASE).
    """
    names = [n for n, _, _, _ in specs] + [n for n, _ in kept or ()]
    also = [F.col(n) for n, _ in kept or ()]
    first = [c.alias(n) for n, c in kept or ()]
    for n, v, lo, hi in specs:
        step = (hi - lo) / float(bins)
        b0 = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(step)).cast("int"), F.lit(0)), F.lit(bins - 1))
        first += [F.when(v.isNotNull(), b0).alias(f"__b_{n}"), v.alias(f"__v_{n}")]
    s1 = df.select(*first)
    second = list(also)
    for n, _, lo, hi in specs:
        step = (hi - lo) / float(bins)
        b0, v = F.col(f"__b_{n}"), F.col(f"__v_{n}")
        second += [F.when((b0 > 0) & (v < b0 * F.lit(step) + F.lit(lo)), b0 - 1).otherwise(b0).alias(f"__d_{n}"), v.alias(f"__v_{n}")]
    s2 = s1.select(*second)
    third = list(also)
    for n, _, lo, hi in specs:
        step = (hi - lo) / float(bins)
        d, v = F.col(f"__d_{n}"), F.col(f"__v_{n}")
        third.append(F.when((d < bins - 1) & (v >= (d + 1) * F.lit(step) + F.lit(lo)), d + 1).otherwise(d).alias(n))
    return s2.select(*third).select(*names)


def histograms(
    df: DataFrame, roles: TripRoles = DEFAULT_ROLES, columns: tuple[str, ...] | None = None, stats: dict | None = None
) -> DataFrame:
    """``hist_bins`` equal-width bins per column, every bin listed.

    Edges come from the profile as literals, so binning is a projection and
    the only shuffle is the partial/final count of at most columns x bins
    groups.
    """
    bins = roles.hist_bins
    cols = [c for c in (columns or roles.eda_numeric) if c in df.columns]
    stats = stats if stats is not None else numeric_stats(df, tuple(cols))
    cols = [c for c in cols if stats[c]["n"] > 0]
    spark = df.sparkSession
    grid_rows = []
    specs = []
    for c in cols:
        lo, hi = _range(stats[c])
        step = (hi - lo) / float(bins)
        specs.append((c, _num(c), lo, hi))
        for b in range(bins):
            grid_rows.append((c, b, b * step + lo, hi if b == bins - 1 else (b + 1) * step + lo))
    grid = spark.createDataFrame(grid_rows, "column string, bin int, bin_lo double, bin_hi double")
    if not cols:
        return grid.withColumn("n_rows", F.lit(0).cast("bigint"))
    long = bin_columns(df, specs, bins).unpivot([], cols, "column", "bin").where(F.col("bin").isNotNull())
    counts = long.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n_rows"))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "bin_lo", "bin_hi", F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows")
    )


def box_stats(
    spark: SparkSession,
    df: DataFrame,
    roles: TripRoles = DEFAULT_ROLES,
    columns: tuple[str, ...] | None = None,
    buckets: int = 4096,
    stats: dict | None = None,
    exact: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Quartiles (exact, linear interpolation), whiskers and flier counts.

    ``exact=False`` takes the quartiles from ``percentile_approx`` instead
    (one pass, bounded memory, rank error at most n / ``accuracy``).

    whisker_lo = smallest value >= q1 - whis*IQR (q1 if that is above q1),
    whisker_hi likewise; fliers lie outside the whiskers.
    """
    cols = [c for c in (columns or roles.eda_numeric) if c in df.columns]
    stats = stats if stats is not None else numeric_stats(df, tuple(cols))
    cols = [c for c in cols if stats[c]["n"] > 0]
    long = numeric_long(df, tuple(cols))
    bounds = {c: (stats[c]["n"], stats[c]["min"], stats[c]["max"]) for c in cols}
    if exact:
        approx = {c: stats[c]["approx"] for c in cols}
        qs = exact_quantiles(spark, long, QUANTILE_PROBS, bounds, buckets=buckets, approx=approx)
    else:  # opt-in: one sketch pass, rank error at most n / accuracy
        probs = F.array(*[F.lit(p) for p in QUANTILE_PROBS])
        got = long.groupBy("column").agg(F.percentile_approx("value", probs, accuracy).alias("q")).collect()
        qs = {r["column"]: dict(zip(QUANTILE_PROBS, r["q"])) for r in got}
    rows = []
    for k in cols:
        d = qs[k]
        q1, med, q3 = d[0.25], d[0.5], d[0.75]
        iqr = q3 - q1
        rows.append((k, bounds[k][0], q1, med, q3, q1 - roles.box_whis * iqr, q3 + roles.box_whis * iqr))
    quart = spark.createDataFrame(rows, "column string, n bigint, q1 double, median double, q3 double, fence_lo double, fence_hi double")
    v = F.col("value")
    agg = long.join(F.broadcast(quart), "column").groupBy("column").agg(
        F.min(F.when(v >= F.col("fence_lo"), v)).alias("wlo"),
        F.max(F.when(v <= F.col("fence_hi"), v)).alias("whi"),
        F.count_if(v < F.col("fence_lo")).alias("below_fence"),
        F.count_if(v < F.col("q1")).alias("below_q1"),
        F.count_if(v > F.col("fence_hi")).alias("above_fence"),
        F.count_if(v > F.col("q3")).alias("above_q3"),
    )
    j = agg.join(F.broadcast(quart), "column")
    lo_in = F.col("wlo").isNotNull() & (F.col("wlo") <= F.col("q1"))
    hi_in = F.col("whi").isNotNull() & (F.col("whi") >= F.col("q3"))
    return j.select(
        "column",
        "n",
        "q1",
        "median",
        "q3",
        F.when(lo_in, F.col("wlo")).otherwise(F.col("q1")).alias("whisker_lo"),
        F.when(hi_in, F.col("whi")).otherwise(F.col("q3")).alias("whisker_hi"),
        (F.when(lo_in, F.col("below_fence")).otherwise(F.col("below_q1"))
         + F.when(hi_in, F.col("above_fence")).otherwise(F.col("above_q3"))).cast("bigint").alias("n_fliers"),
    )


#: Bandwidths beyond which a kernel counts as zero (its share is below 3e-16 there).
KERNEL_REACH = 8.5


def density_columns(stats: dict, columns: list[str]) -> tuple[list[str], list[str]]:
    """The columns that have a density curve, and those that don't: a constant one, or fewer than two values."""
    has = [c for c in columns if stats[c]["n"] >= 2 and stats[c]["sd"] is not None and stats[c]["sd"] > 0]
    return has, [c for c in columns if c not in has]


#: Width of a density bin in bandwidths, and moments kept of each.
BIN_WIDTH, MOMENTS = 0.25, 12


def density_error_bound(moments: int = MOMENTS, width: float = BIN_WIDTH) -> float:
    """Most that the expansion of one value's kernel (peak 1) can be off.

    The k-th derivative of exp(-z^2/2) is He_k(z) exp(-z^2/2) up to its sign,
    and |He_k(z)| exp(-z^2/4) <= 1.0865 sqrt(k!) (Cramer), so the remainder
    after K terms at |u| <= width/2 is at most 1.0865 (width/2)^K / sqrt(K!).
    """
    return 1.0865 * (width / 2) ** moments / math.sqrt(math.factorial(moments))


def _hermite(moments: int) -> list[list[int]]:
    """Coefficients of He_0 .. He_(moments-1): He_(k+1)(z) = z He_k(z) - k He_(k-1)(z)."""
    out = [[1], [0, 1]]
    for k in range(1, moments - 1):
        shifted, before = [0, *out[k]], [*out[k - 1], 0, 0]
        out.append([x - k * y for x, y in zip(shifted, before, strict=True)])
    return out[:moments]


def density_moments(df: DataFrame, stats: dict, columns: list[str], moments: int = MOMENTS, width: float = BIN_WIDTH) -> DataFrame:
    """(column, bin, m0 .. m(moments-1)): sums of the powers of (value - bin centre) / bandwidth.

    Bins are ``width`` bandwidths wide, from the minimum on. States of parts
    of the data add up; only occupied bins have a row.
    """
    place = F.col("place")
    # the places are columns before they are unpivoted, so that a column's arithmetic stands once in the generated
    # code of the sums: with a copy for each use it passed the size up to which the JVM compiles a method
    wide = df.select(*[((_num(c) - F.lit(stats[c]["min"])) / F.lit(_bandwidth(stats[c]) * width)).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column", "place").where(place.isNotNull())
    long = long.select("column", F.floor(place).alias("bin"), ((place - F.floor(place) - 0.5) * F.lit(width)).alias("u1"))
    for k in range(2, moments):
        long = long.withColumn(f"u{k}", F.col(f"u{k - 1}") * F.col("u1"))
    return long.groupBy("column", "bin").agg(F.count(F.lit(1)).cast("double").alias("m0"), *[F.sum(f"u{k}").alias(f"m{k}") for k in range(1, moments)])


def _bandwidth(st: dict) -> float:
    """Scott's factor n^(-1/5) times the sample stddev."""
    return st["sd"] * float(st["n"]) ** -0.2


def density_curves(
    df: DataFrame, roles: TripRoles = DEFAULT_ROLES, columns: tuple[str, ...] | None = None, stats: dict | None = None,
    moments: int = MOMENTS, width: float = BIN_WIDTH,
) -> DataFrame:
    """Gaussian KDE on ``kde_grid_points`` points over [min, max], scaled to counts.

    Values are reduced to moments in bins of a quarter bandwidth, in one
    partial aggregate. A bin's kernels at a point z bandwidths from its centre
    sum to exp(-z^2/2) times sum_k He_k(z) m_k / k!, a polynomial in z. Cost
    is one pass of sums over the rows and then a number of bins times points
    that grows with the range over the bandwidth, not with the rows. Each
    value's kernel is off by ``density_error_bound`` (7e-16) at most, and is
    left out beyond ``KERNEL_REACH`` bandwidths. A constant column has no
    curve (``density_columns``). Counts scaling: density * n * histogram bin
    width.
    """
    g = roles.kde_grid_points
    spark = df.sparkSession
    cols = [c for c in (columns or roles.eda_numeric) if c in df.columns]
    stats = stats if stats is not None else numeric_stats(df, tuple(cols))
    cols, _ = density_columns(stats, cols)
    if not cols:
        return spark.createDataFrame([], "column string, point int, x double, density double, density_count double")
    grid_rows, facts = [], []
    for c in cols:
        n, lo, hi = (stats[c][k] for k in ("n", "min", "max"))
        h, step = _bandwidth(stats[c]), (hi - lo) / float(g - 1)
        facts.append((c, lo, hi, step, h))
        grid_rows += [(c, i, hi if i == g - 1 else float(i) * step + lo, n, h, (hi - lo) / float(roles.hist_bins)) for i in range(g)]
    grid = spark.createDataFrame(grid_rows, "column string, point int, x double, n bigint, h double, width double")
    binned = density_moments(df, stats, cols, moments, width).join(F.broadcast(spark.createDataFrame(facts, "column string, lo double, hi double, step double, h double")), "column")
    hermite = _hermite(moments)
    powers = [sum((F.col(f"m{k}") * (hermite[k][j] / math.factorial(k)) for k in range(j + 2, moments, 2)), F.col(f"m{j}") * (1 / math.factorial(j))).alias(f"c{j}") for j in range(moments)]
    centre = F.col("lo") + (F.col("bin") + 0.5) * F.lit(width) * F.col("h")
    sums = binned.select("column", "lo", "hi", "step", "h", centre.alias("centre"), *powers)
    reach = F.lit(KERNEL_REACH + width / 2) * F.col("h")
    first = F.greatest(F.ceil((F.col("centre") - reach - F.col("lo")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("centre") + reach - F.col("lo")) / F.col("step")), F.lit(g - 1)).cast("int")
    touched = sums.withColumn("point", F.explode(F.when(first <= last, F.sequence(first, last))))
    x = F.when(F.col("point") == g - 1, F.col("hi")).otherwise(F.col("point").cast("double") * F.col("step") + F.col("lo"))
    z = F.col("z")
    value = F.col(f"c{moments - 1}")
    for j in reversed(range(moments - 1)):
        value = F.col(f"c{j}") + z * value
    curve = touched.withColumn("z", (x - F.col("centre")) / F.col("h")).groupBy("column", "point").agg(F.sum(F.exp(F.lit(-0.5) * z * z) * value).alias("s"))
    dens = F.coalesce(F.col("s"), F.lit(0.0)) / (F.col("n") * F.col("h") * F.lit((2 * math.pi) ** 0.5))
    return grid.join(curve, ["column", "point"], "left").select(
        "column", "point", "x", dens.alias("density"), (dens * F.col("n") * F.col("width")).alias("density_count")
    )


PAIRS = (
    ("distance_fare", "trip_distance", "fare_amount"),
    ("duration_distance", "trip_duration_min", "trip_distance"),
    ("fare_discrepancy", "fare_amount", "fare_discrepancy"),
)


def pair_ranges(df: DataFrame, pairs=PAIRS) -> dict[str, dict]:
    """[min, max] of both axes of every pair, over the rows that have both: one aggregate for all pairs."""
    aggs = []
    for name, xcol, ycol in pairs:
        x, y = _num(xcol), _num(ycol)
        both = x.isNotNull() & y.isNotNull()
        for axis, v in (("x", x), ("y", y)):
            aggs += [f(F.when(both, v)).alias(f"{name}__{axis}{tag}") for f, tag in ((F.min, "min"), (F.max, "max"))]
    row = df.agg(*aggs).collect()[0].asDict()
    return {name: {k: row[f"{name}__{k}"] for k in ("xmin", "xmax", "ymin", "ymax")} for name, _, _ in pairs}


def pair_bins(df: DataFrame, pair: str, xcol: str, ycol: str, bins: int = 50, ranges: dict | None = None) -> DataFrame:
    """2-D binned counts of (x, y) over each axis's [min, max].

    Replaces a scatter plot: the cell table has at most bins^2 rows whatever
    the row count. Rows with a missing coordinate are left out. The ranges
    come as literals (``pair_ranges``; taken here if not given), one pass
    bins and counts.
    """
    xy = df.select(_num(xcol).alias("x"), _num(ycol).alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )
    st = (ranges or pair_ranges(df, ((pair, xcol, ycol),)))[pair]
    if st["xmin"] is None:
        return df.sparkSession.createDataFrame([], "pair string, bin_x int, bin_y int, n_rows bigint")
    xlo, xhi = _range({"min": st["xmin"], "max": st["xmax"]})
    ylo, yhi = _range({"min": st["ymin"], "max": st["ymax"]})
    cells = (
        bin_columns(xy, [("bin_x", F.col("x"), xlo, xhi), ("bin_y", F.col("y"), ylo, yhi)], bins)
        .groupBy("bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return cells.select(F.lit(pair).alias("pair"), "bin_x", "bin_y", "n_rows")


def pair_table(df: DataFrame, which: str, bins: int = 50, ranges: dict | None = None) -> DataFrame:
    for name, x, y in PAIRS:
        if name == which:
            return pair_bins(df, name, x, y, bins, ranges)
    raise KeyError(which)


def pair_sample(df: DataFrame, which: str, keys: tuple[str, ...], per_cell: int = 3, seed: int = 42, bins: int = 50, ranges: dict | None = None) -> DataFrame:
    """A repeatable sample of ``per_cell`` rows from every cell of a pair table, with the keys and both values.

    The rows of a cell with the least hashes of seed and keys, so the sample
    depends on the data alone. Spark limits each cell in every task before the
    shuffle (up to 1,000 rows a cell), so a crowded cell sends that many rows a
    task; rows that repeat a key tie and come in the order of their values.
    """
    name, xcol, ycol = next(p for p in PAIRS if p[0] == which)
    st = (ranges or pair_ranges(df, ((name, xcol, ycol),)))[name]
    rows = df.select(*keys, _num(xcol).alias("x"), _num(ycol).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    if st["xmin"] is None:
        return rows.select(F.lit(name).alias("pair"), F.lit(0).alias("bin_x"), F.lit(0).alias("bin_y"), F.lit(0).alias("pos"), *keys, "x", "y").limit(0)
    xlo, xhi = _range({"min": st["xmin"], "max": st["xmax"]})
    ylo, yhi = _range({"min": st["ymin"], "max": st["ymax"]})
    kept = [(k, F.col(k)) for k in (*keys, "x", "y")]
    cells = bin_columns(rows, [("bin_x", F.col("x"), xlo, xhi), ("bin_y", F.col("y"), ylo, yhi)], bins, kept)
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    pos = F.row_number().over(Window.partitionBy("bin_x", "bin_y").orderBy(order, "x", "y"))
    return cells.withColumn("pos", pos).where(F.col("pos") <= per_cell).select(F.lit(name).alias("pair"), "bin_x", "bin_y", "pos", *keys, "x", "y")
