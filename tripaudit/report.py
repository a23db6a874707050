"""The EDA and sanity tables as one set (the charts' data, not the charts).

Sections follow the three report families: univariate (histograms, density
curves, box statistics of every present numeric column), temporal (trips per
hour, mean fare per weekday) and bivariate (three 2-D pair tables). A section
whose inputs are missing is skipped and named in ``skipped`` (A12).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DEFAULT_ROLES, TripRoles
from .operators import anomalies as A
from .operators import distributions as D
from .operators import summaries as S
from .sources.sink import write_report

TEMPORAL_REQUIRES = ("pickup_hour", "pickup_dayofweek", "trip_duration_min", "fare_amount")
BIVARIATE_REQUIRES = ("trip_distance", "fare_amount", "trip_duration_min", "fare_discrepancy")


@dataclass
class Tables:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    skipped: list[tuple[str, str]] = field(default_factory=list)


def sanity_tables(featured: DataFrame) -> dict[str, DataFrame]:
    """A1-A3: the checks printed after the transform."""
    return {
        "null_counts": S.null_counts(featured),
        "negative_durations": S.negative_durations(featured),
        "flag_domains": S.flag_domains(featured),
    }


def eda_tables(spark: SparkSession, featured: DataFrame, roles: TripRoles = DEFAULT_ROLES, stats: dict | None = None) -> Tables:
    out = Tables()
    cols = tuple(c for c in roles.eda_numeric if c in featured.columns)
    if cols:
        stats = stats if stats is not None else D.numeric_stats(featured, cols)
        out.tables["histograms"] = D.histograms(featured, roles, cols, stats)
        out.tables["density_curves"] = D.density_curves(featured, roles, cols, stats)
        _, flat = D.density_columns(stats, list(cols))
        out.skipped += [(f"density:{c}", "fewer than two different values") for c in flat]
        out.tables["box_stats"] = D.box_stats(spark, featured, roles, cols, stats=stats)
    else:
        out.skipped.append(("univariate", ",".join(roles.eda_numeric)))
    missing = [c for c in TEMPORAL_REQUIRES if c not in featured.columns]
    if missing:
        out.skipped.append(("temporal", ",".join(missing)))
    else:
        out.tables["trips_by_hour"] = S.trips_by_hour(featured)
        out.tables["fare_by_weekday"] = S.fare_by_weekday(featured, roles)
    missing = [c for c in BIVARIATE_REQUIRES if c not in featured.columns]
    if missing:
        out.skipped.append(("bivariate", ",".join(missing)))
    else:
        ranges = D.pair_ranges(featured)
        for name, x, y in D.PAIRS:
            out.tables[f"pair_{name}"] = D.pair_bins(featured, name, x, y, roles.pair_bins, ranges)
    return out


ANOMALY_REQUIRES = (
    "trip_distance", "fare_amount", "total_amount", "trip_duration_min", "avg_speed_mph", "fare_discrepancy",
    "tip_amount", "passenger_count", "is_cash_with_tip", "pickup_hour", "pickup_dayofweek",
)


def anomaly_tables(spark: SparkSession, featured: DataFrame, roles: TripRoles = DEFAULT_ROLES, stats: dict | None = None) -> Tables:
    """The counts of every flag, and the anomaly tables."""
    out = Tables()
    missing = [c for c in ANOMALY_REQUIRES if c not in featured.columns]
    if missing:
        out.skipped.append(("anomalies", ",".join(missing)))
        return out
    flagged = A.add_anomaly_flags(featured, A.duration_fences(spark, featured, roles, stats=stats), roles)
    counts = [F.struct(F.lit(c).alias("flag"), F.sum(c).cast("bigint").alias("n_rows")) for c in A.ANOMALY_FLAGS]
    out.tables = {
        "anomaly_counts": flagged.agg(F.array(*counts).alias("a")).select(F.inline("a")),
        "anomaly_overlap": A.anomaly_overlap(flagged),
        "discrepancy_bands": A.discrepancy_bands(flagged, roles),
        "tip_anomalies": A.tip_anomalies(flagged),
        "demand_profile": A.demand_profile(S.trips_by_hour(featured)),
        "fare_by_weekday_clean": A.fare_by_weekday_clean(flagged, roles),
        "pair_correlations": A.pair_correlations(flagged),
        "anomaly_ranking": A.anomaly_ranking(flagged),
    }
    return out


def write_tables(tables: dict[str, DataFrame], out_dir: str) -> list[str]:
    """One Parquet folder per table under ``out_dir``."""
    written = []
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        write_report(df, path)
        written.append(path)
    return written
