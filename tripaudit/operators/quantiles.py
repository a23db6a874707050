"""Exact quantiles without a single-task value map.

Spark's exact ``percentile`` keeps a value -> count map of the whole group in
the task that merges it: fine for a few thousand distinct values, not for a
continuous column over 100 TB. Here the order statistics needed for linear
interpolation are found by distributed histogram refinement:

1. per key: n, min, max (one aggregate);
2. every wanted rank starts in the interval [min, max];
3. each round buckets the values inside the open intervals (a broadcast join
   with the interval table, whose size is #keys x #ranks) and counts, per
   bucket, rows, min and max with a partial + final aggregate; the driver
   receives at most #intervals x ``buckets`` rows;
4. the bucket holding the rank becomes the next interval; a bucket whose
   min equals its max resolves the rank.

Values are finite. min and max of an interval always land in different
buckets, so every round divides its width by the number of buckets or leaves
fewer distinct values: with 4096 buckets a width of 2^1024 falls below the
least difference of two doubles, 2^-1074, within 175 rounds, and the loop
ends by construction (typically after 1-3 rounds).
Interpolation follows numpy's default ('linear', symmetric lerp).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def virtual_index(n: int, q: float) -> float:
    """numpy 'linear' method: (n - 1) * q, written as numpy computes it."""
    return n * q + (1 + q * (1 - 1 - 1)) - 1


def lerp(a: float, b: float, t: float) -> float:
    diff = b - a
    if a == b:
        return a
    return b - diff * (1 - t) if t >= 0.5 else a + diff * t


def order_statistics(
    spark: SparkSession,
    long_df: DataFrame,
    ranks: dict,
    bounds: dict,
    key: str = "column",
    value: str = "value",
    buckets: int = 4096,
    brackets: dict | None = None,
) -> dict:
    """Values at the given 0-based ranks, per key.

    ``ranks``: key -> set of ranks; ``bounds``: key -> (n, min, max) from a
    previous aggregate. ``long_df`` holds (key, value) with NULLs removed.
    ``brackets`` (optional): (key, rank) -> (lo, hi), a guess such as two
    approximate percentiles around the rank; the first round counts the rows
    below ``lo`` exactly and checks that the rank falls inside, otherwise the
    target restarts from [min, max]. Returns {(key, rank): value}.
    """
    found: dict = {}
    # open targets: (key, rank) -> [lo, hi, below]; below None = still to count
    open_: dict = {}
    for k, rs in ranks.items():
        n, lo, hi = bounds[k]
        for r in rs:
            if lo == hi:
                found[(k, r)] = lo
            elif brackets and (k, r) in brackets and brackets[(k, r)][0] is not None:
                blo, bhi = brackets[(k, r)]
                open_[(k, r)] = [max(lo, blo), min(hi, bhi), None] if blo <= bhi else [lo, hi, 0]
            else:
                open_[(k, r)] = [lo, hi, 0]
    while open_:
        intervals = sorted({(k, lo, hi, below) for (k, _r), (lo, hi, below) in open_.items()}, key=repr)
        iid = {iv: i for i, iv in enumerate(intervals)}
        iv_rows = [(i, k, float(lo), float(hi), below is None) for (k, lo, hi, below), i in iid.items()]
        iv_df = spark.createDataFrame(iv_rows, "__iid int, __key string, __lo double, __hi double, __count_below boolean")
        v = F.col(value).cast("double")
        lo_c, hi_c = F.col("__lo"), F.col("__hi")
        joined = long_df.join(
            F.broadcast(iv_df),
            (F.col(key) == F.col("__key")) & (v <= hi_c) & ((v >= lo_c) | F.col("__count_below")),
            "inner",
        )
        half = hi_c / 2 - lo_c / 2  # halves: the width itself may exceed the largest double
        inside = F.when(half > 0, F.least(F.floor((v / 2 - lo_c / 2) / half * buckets).cast("int"), F.lit(buckets - 1))).otherwise(F.when(v > lo_c, F.lit(buckets - 1)).otherwise(F.lit(0)))
        bucket = F.when(v < lo_c, F.lit(-1)).otherwise(inside)
        hist = (
            joined.groupBy("__iid", bucket.alias("__b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"))
            .collect()
        )
        per_iv: dict = {}
        below_n: dict = {}
        for row in hist:
            if row["__b"] == -1:
                below_n[row["__iid"]] = row["n"]
            else:
                per_iv.setdefault(row["__iid"], []).append((row["__b"], row["n"], row["mn"], row["mx"]))
        for lst in per_iv.values():
            lst.sort()
        nxt: dict = {}
        for (k, r), (lo, hi, below) in open_.items():
            i = iid[(k, lo, hi, below)]
            cum = below if below is not None else below_n.get(i, 0)
            located = False
            if r >= cum:
                for _b, cnt, mn, mx in per_iv.get(i, []):
                    if r < cum + cnt:
                        if mn == mx:
                            found[(k, r)] = mn
                        else:
                            nxt[(k, r)] = [mn, mx, cum]
                        located = True
                        break
                    cum += cnt
            if not located:
                if below is not None:  # pragma: no cover - ranks are always inside [0, n)
                    raise RuntimeError(f"rank {r} of {k} not located")
                _n, mn, mx = bounds[k]
                nxt[(k, r)] = [mn, mx, 0]  # the guess missed: restart from the full range
        open_ = nxt
    return found


def bracket_probs(probs: tuple[float, ...], accuracy: int) -> list[float]:
    """Probabilities just below and above each wanted one (3 / accuracy apart)."""
    eps = 3.0 / accuracy
    out = []
    for p in probs:
        out.extend((max(0.0, p - eps), min(1.0, p + eps)))
    return out


def exact_quantiles(
    spark: SparkSession,
    long_df: DataFrame,
    probs: tuple[float, ...],
    bounds: dict,
    key: str = "column",
    value: str = "value",
    buckets: int = 4096,
    approx: dict | None = None,
) -> dict:
    """{key: {p: quantile}} with numpy's default interpolation.

    ``approx`` (optional): key -> list of approximate percentiles at
    ``bracket_probs(probs, accuracy)``, used to start near the answer.
    """
    need: dict = {}
    plan: dict = {}
    brackets: dict = {}
    for k, (n, _lo, _hi) in bounds.items():
        if n == 0:
            continue
        for j, p in enumerate(probs):
            vi = virtual_index(n, p)
            prev = math.floor(vi)
            prev = min(max(prev, 0), n - 1)
            nxt = min(prev + 1, n - 1)
            gamma = vi - math.floor(vi)
            plan[(k, p)] = (prev, nxt, gamma)
            need.setdefault(k, set()).update((prev, nxt))
            if approx and approx.get(k):
                lo, hi = approx[k][2 * j], approx[k][2 * j + 1]
                for r in (prev, nxt):
                    brackets[(k, r)] = (lo, hi)
    stats = order_statistics(spark, long_df, need, bounds, key, value, buckets, brackets)
    out: dict = {}
    for (k, p), (a, b, g) in plan.items():
        out.setdefault(k, {})[p] = lerp(stats[(k, a)], stats[(k, b)], g)
    return out
