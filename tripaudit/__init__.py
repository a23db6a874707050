"""tripaudit: trip-record quality and profiling on Spark.

Public entry points (all take and return Spark DataFrames):

* ``build_plan`` / ``apply_plan`` / ``conform``  - profile once, then narrow and drop as a projection
* ``add_features``                              - derived columns and quality flags (rule registry)
* ``histograms`` / ``density_curves`` / ``box_stats`` / ``pair_bins`` - distribution summaries
* ``add_anomaly_flags`` and the anomaly tables   - the checks the written reports describe
* ``read_all`` / ``audit_files`` / ``file_listing`` - monthly files with drifting schemas
* ``run_incremental_ingest``                    - the same chain on an incremental file stream
"""

from .config import DEFAULT_ROLES, TripRoles
from .operators.anomalies import add_anomaly_flags, duration_fences
from .operators.conform import apply_plan, conform, optimize
from .operators.distributions import box_stats, density_curves, histograms, pair_bins
from .operators.features import add_features, feature_manifest
from .plans.profile import build_plan
from .sources.files import MonthlyLayout, audit_files, file_listing, read_all, read_month
from .streaming.ingest import run_incremental_ingest

__all__ = [
    "DEFAULT_ROLES", "TripRoles", "add_anomaly_flags", "duration_fences", "apply_plan", "conform", "optimize",
    "box_stats", "density_curves", "histograms", "pair_bins", "add_features", "feature_manifest",
    "build_plan", "MonthlyLayout", "audit_files", "file_listing", "read_all", "read_month",
    "run_incremental_ingest",
]
