"""The ``trips`` table: a trip-shaped view derived from ``lineitem``.

Every value is a pure function of one ``lineitem`` row, so the view is a
single projection over the scan (no shuffle) and its size grows with the
input. Money and distances are multiples of 0.25, hence float32 sums are
exact in any order. The same formulas are written in SQL for the oracle
(``tripaudit.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bound_methods

KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
SOURCE_COLUMNS = KEYS + ("l_quantity", "l_shipdate")


def _d(x: float) -> Column:
    return F.lit(float(x)).cast("double")


def _hash() -> Column:
    return F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_suppkey") * 31 + F.col("l_linenumber") * 17


def _pickup(h: Column) -> Column:
    return F.timestamp_add("SECOND", h % 86400, F.col("l_shipdate"))


def sources_of_trips(lineitem: DataFrame) -> DataFrame:
    """The few columns that a trip is made of, with its pickup time: what has to be moved to put trips in another place."""
    return lineitem.select(*SOURCE_COLUMNS, _pickup(_hash()).alias("lpep_pickup_datetime"))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    li = lineitem.select(*SOURCE_COLUMNS)
    q = F.col("l_quantity")
    df = li.withColumn("_h", _hash())
    h = F.col("_h")

    pickup = _pickup(h)
    secs = (
        F.when(h % 97 == 0, F.lit(0).cast("bigint"))
        .when(h % 101 == 0, -(h % 600))
        .when(h % 499 == 0, F.lit(84000).cast("bigint"))
        .otherwise(60 + h % 5400)
    )
    fare_base = F.when(h % 53 == 0, -q).when(h % 1511 == 0, _d(320)).otherwise(q * 1.5 + 3)
    fare = F.when(h % 59 == 0, F.lit(None).cast("double")).otherwise(fare_base)
    total_base = F.when(h % 59 == 0, _d(0)).otherwise(fare_base)
    extra = (h % 3) * 0.5
    tip = F.when((h % 2003 == 0) | (h % 3022 == 0), _d(64)).when(h % 4 == 0, q * 0.25).otherwise(_d(0))
    null_d = F.lit(None).cast("double")
    cols = {
        "VendorID": 1 + h % 2,
        "store_and_fwd_flag": F.when(h % 50 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "trip_type": 1 + h % 2,
        "ehail_fee": null_d,
        "airport_fee": null_d,
        "lpep_pickup_datetime": pickup,
        "lpep_dropoff_datetime": F.timestamp_add("SECOND", secs, pickup),
        "passenger_count": F.when(h % 23 == 0, null_d)
        .when(h % 29 == 0, _d(0))
        .when(h % 401 == 0, _d(8))
        .otherwise((1 + h % 6).cast("double")),
        "RatecodeID": F.when(h % 23 == 0, null_d).when(h % 211 == 0, _d(99)).otherwise((1 + h % 6).cast("double")),
        "PULocationID": 1 + h % 265,
        "DOLocationID": F.when(h % 13 == 0, 1 + h % 265).otherwise(
            1 + (F.col("l_partkey") * 13 + F.col("l_suppkey")) % 265
        ),
        "payment_type": F.when(h % 23 == 0, null_d)
        .when(h % 307 == 0, _d(0))
        .otherwise((1 + (h + F.col("l_linenumber")) % 6).cast("double")),
        "trip_distance": F.when(h % 1009 == 0, _d(80000)).when(h % 37 == 0, _d(0)).otherwise(q * 0.25),
        "fare_amount": fare,
        "extra": extra,
        "mta_tax": _d(0.5),
        "tip_amount": tip,
        "tolls_amount": F.when(h % 20 == 0, _d(6.5)).otherwise(_d(0)),
        "improvement_surcharge": _d(1.0),
        "congestion_surcharge": F.when(h % 23 == 0, null_d).when(h % 5 == 0, _d(2.75)).otherwise(_d(0)),
        "cbd_congestion_fee": F.when(
            F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'"), _d(0.75)
        ).otherwise(null_d),
        "total_amount": total_base + extra + 1.5 + tip + F.when(h % 71 == 0, _d(5)).otherwise(_d(0)),
    }
    return df.select(*KEYS, *[c.alias(n) for n, c in cols.items()])


def with_string_times(trips_df: DataFrame) -> DataFrame:
    """Adds string-typed ``tpep_*`` columns (some unparseable) for the parse step."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    bad = F.col("l_orderkey") % 31 == 0
    return trips_df.withColumns(
        {
            "tpep_pickup_datetime": F.when(bad, F.lit("not a time")).otherwise(F.date_format("lpep_pickup_datetime", fmt)),
            "tpep_dropoff_datetime": F.date_format("lpep_dropoff_datetime", fmt),
        }
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_methods(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw ``trips`` view for a scale-factor directory."""
    return trips_from_lineitem(read_table(spark, sf_dir, "lineitem"))
