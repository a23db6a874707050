"""Batch entry point over monthly trip files.

    python -m tripaudit.run --raw <dir> --out <dir> [--year Y --month M | --all]
                            [--taxi-type green] [--layout flat|partitioned]

list files -> audit -> read (one month, or every configured month with
schema drift) -> profile + conform (with footprint report) -> derive
features -> sanity checks -> EDA and anomaly tables and the featured trips
(partitioned by the file they came from) written under ``--out``. Every step is a Spark job; the driver only receives the file
audit, the one-row profile and the small summary tables it prints.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .config import DEFAULT_ROLES, TripRoles
from .operators.conform import apply_plan, footprint_aggregates, footprint_from_row, footprint_report, type_changes
from .operators.distributions import numeric_stats
from .operators.features import add_features, feature_manifest
from .plans.profile import distinct_aggregates, plan_from_profile, profile_aggregates
from .plans.store import write_plan
from .report import anomaly_tables, eda_tables, sanity_tables, write_tables
from .sources import files as FS
from .sources.sink import read_trips, write_report, write_trips


def run(spark: SparkSession, raw: str, out: str, roles: TripRoles = DEFAULT_ROLES, year: int | None = None,
        month: int | None = None, layout: str = "flat", echo=print) -> dict:
    lay = FS.MonthlyLayout(raw, None if layout == "flat" else FS.PARTITION_KEY)
    listing = [r["file_name"] for r in FS.file_listing(spark, lay).select("file_name").collect()]
    echo(f"available files: {sorted(listing)}")
    if year is not None and month is not None:
        names = [roles.file_name(year, month)]
    else:
        names = [*(roles.file_name(y, m) for y, m in roles.periods()), roles.unknown_file_name()]
    checks = FS.audit_files(spark, lay, names, with_bytes=True)
    df = FS.read_checked(spark, lay, checks)
    write_report(FS.audit_frame(spark, checks), f"{out}/reports/file_audit")
    if df is None:
        echo("no readable file for the requested period")
        return {"status": "no_data", "audit": [(c.file_name, c.status) for c in checks]}

    # one pass: conformance profile and the string bytes of the footprint
    row = df.agg(*profile_aggregates(df, roles), *distinct_aggregates(df, roles), *footprint_aggregates(df)).collect()[0].asDict()
    plan = plan_from_profile(df, roles, row)
    write_plan(spark, plan, f"{out}/plan.json")
    conformed = apply_plan(df, plan, roles)
    measured = footprint_from_row(df, row, int(row["__rows"]))
    report = footprint_report(spark, df, conformed, measured).collect()[0].asDict()
    echo(f"footprint report: {json.dumps(report)}")
    write_report(type_changes(spark, df, conformed, plan), f"{out}/reports/type_changes")

    featured = add_features(conformed, roles)
    manifest = feature_manifest(conformed.columns, roles)
    skipped_rules = [m for m in manifest if m[1] == "skipped"]
    for rule, _, outputs, missing in skipped_rules:
        echo(f"skipped rule {rule} ({outputs}): missing {missing}")

    # the reports cover the whole table, earlier runs included, so their statistics come from it
    write_trips(featured, f"{out}/trips", [c.file_name for c in checks if c.status == "ok"], by_file=True)
    trips = read_trips(spark, f"{out}/trips")
    cols = tuple(c for c in roles.eda_numeric if c in trips.columns)
    stats = numeric_stats(trips, cols)
    write_report(FS.load_counts(df, checks), f"{out}/reports/load_counts")

    sanity = sanity_tables(trips)
    for name, t in sanity.items():
        echo(f"{name}: {[tuple(r) for r in t.collect()]}")
    eda = eda_tables(spark, trips, roles, stats)
    for section, missing in eda.skipped:
        echo(f"skipped {section} analysis: missing {missing}")
    anomalies = anomaly_tables(spark, trips, roles, stats)
    for section, missing in anomalies.skipped:
        echo(f"skipped {section}: missing {missing}")
    written = write_tables({**sanity, **eda.tables, **anomalies.tables}, f"{out}/reports")
    return {"status": "ok", "report": report, "written": written, "skipped": eda.skipped + anomalies.skipped, "skipped_rules": skipped_rules}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tripaudit.run")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--year", type=int)
    ap.add_argument("--month", type=int)
    ap.add_argument("--taxi-type", default=DEFAULT_ROLES.taxi_type)
    ap.add_argument("--year-start", type=int, default=DEFAULT_ROLES.year_start)
    ap.add_argument("--year-end", type=int, default=DEFAULT_ROLES.year_end)
    ap.add_argument("--layout", choices=("flat", "partitioned"), default="flat")
    a = ap.parse_args(argv)
    roles = DEFAULT_ROLES.with_(taxi_type=a.taxi_type, year_start=a.year_start, year_end=a.year_end)
    spark = SparkSession.builder.appName("tripaudit").getOrCreate()
    res = run(spark, a.raw, a.out, roles, a.year, a.month, a.layout)
    return 0 if res["status"] == "ok" else 1


if __name__ == "__main__":
    sys.exit(main())
