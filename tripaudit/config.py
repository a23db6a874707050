"""Roles, code lists and thresholds.

Everything the engine needs to know about a trip table lives in one frozen
dataclass that is passed explicitly (no module singleton). Values marked as
fixed below must stay equal to the behaviour being reproduced; values marked
"ours" are our own defaults for checks that only exist as prose.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --------------------------------------------------------------------------
# Fixed values (must equal the reproduced behaviour; stated plainly, in order)
# --------------------------------------------------------------------------
FILE_NAME_TEMPLATE = "{taxi_type}_tripdata_{year}-{month:02d}.parquet"
TAXI_TYPES = ("yellow", "green", "fhv")
DEFAULT_TAXI_TYPE = "green"
DEFAULT_YEAR_START = 2021
DEFAULT_YEAR_END = 2025
DEFAULT_MONTHS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)

COLUMNS_TO_DROP = ("VendorID", "store_and_fwd_flag", "trip_type", "ehail_fee")

# column -> target kind; "Int8" is a nullable 8-bit integer, "int16" a
# non-nullable 16-bit integer, "float32" a 4-byte float.
NARROW_TARGETS = (
    ("RatecodeID", "Int8"),
    ("passenger_count", "Int8"),
    ("PULocationID", "int16"),
    ("DOLocationID", "int16"),
    ("payment_type", "Int8"),
    ("trip_distance", "float32"),
    ("fare_amount", "float32"),
    ("tip_amount", "float32"),
    ("total_amount", "float32"),
    ("extra", "float32"),
    ("mta_tax", "float32"),
    ("tolls_amount", "float32"),
    ("improvement_surcharge", "float32"),
    ("congestion_surcharge", "float32"),
    ("cbd_congestion_fee", "float32"),
)

CATEGORICAL_COLUMNS = ("payment_type",)
CATEGORY_RATIO_LIMIT = 0.005

DATETIME_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")

FARE_COMPONENTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
)

ZONE_MIN, ZONE_MAX = 1, 263
VALID_RATE_CODES = (1, 2, 3, 4, 5, 6)
VALID_PAYMENT_TYPES = (1, 2, 3, 4, 5, 6)
CASH_PAYMENT = 2
FREE_PAYMENTS = (3, 6)

EDA_NUMERIC = (
    "trip_duration_min",
    "trip_distance",
    "avg_speed_mph",
    "fare_amount",
    "total_amount",
    "fare_discrepancy",
    "tip_amount",
    "passenger_count",
)

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# cast-loss tolerance of the float check
FLOAT_RTOL = 1e-4
FLOAT_ATOL = 1e-6

# histogram / density settings
HIST_BINS = 50
KDE_GRID_POINTS = 200
BOX_WHIS = 1.5

# pickup / dropoff role -> candidate column names, first present wins
PICKUP_CANDIDATES = ("lpep_pickup_datetime", "tpep_pickup_datetime")
DROPOFF_CANDIDATES = ("lpep_dropoff_datetime", "tpep_dropoff_datetime")

# --------------------------------------------------------------------------
# Ours: thresholds for the checks described only in prose
# --------------------------------------------------------------------------
MAX_DISTANCE_MILES = 50.0  # the prose names 50 miles
MAX_SPEED_MPH = 100.0  # ours
MAX_TIP = 20.0  # prose: "most tips are 0-20"
PASSENGER_OUTLIER = (7, 9)  # prose: "values of 7-9"
IDLE_DISTANCE = 0.1  # ours: "near-zero distance"
IDLE_DURATION_MIN = 1400.0  # prose: "~1,400 min"
DISCREPANCY_BANDS = (10.0, 20.0)  # prose: "near 0", "10-20", "tail"
HIGH_FARE = 300.0  # prose: "$300+"
PAIR_BINS = 50  # ours: resolution of the 2-D pair tables
BROADCAST_CODES = 65536  # ours: largest code table that is broadcast; larger ones are joined by a shuffle


@dataclass(frozen=True)
class TripRoles:
    """Configuration passed to every operator."""

    taxi_type: str = DEFAULT_TAXI_TYPE
    year_start: int = DEFAULT_YEAR_START
    year_end: int = DEFAULT_YEAR_END
    months: tuple[int, ...] = DEFAULT_MONTHS
    file_name_template: str = FILE_NAME_TEMPLATE
    columns_to_drop: tuple[str, ...] = COLUMNS_TO_DROP
    narrow_targets: tuple[tuple[str, str], ...] = NARROW_TARGETS
    categorical_columns: tuple[str, ...] = CATEGORICAL_COLUMNS
    category_ratio_limit: float = CATEGORY_RATIO_LIMIT
    broadcast_codes: int = BROADCAST_CODES
    datetime_columns: tuple[str, ...] = DATETIME_COLUMNS
    datetime_formats: tuple[str, ...] = ()
    fare_components: tuple[str, ...] = FARE_COMPONENTS
    zone_range: tuple[int, int] = (ZONE_MIN, ZONE_MAX)
    rate_codes: tuple[int, ...] = VALID_RATE_CODES
    payment_types: tuple[int, ...] = VALID_PAYMENT_TYPES
    cash_payment: int = CASH_PAYMENT
    free_payments: tuple[int, ...] = FREE_PAYMENTS
    eda_numeric: tuple[str, ...] = EDA_NUMERIC
    day_names: tuple[str, ...] = DAY_NAMES
    pickup_candidates: tuple[str, ...] = PICKUP_CANDIDATES
    dropoff_candidates: tuple[str, ...] = DROPOFF_CANDIDATES
    float_rtol: float = FLOAT_RTOL
    float_atol: float = FLOAT_ATOL
    hist_bins: int = HIST_BINS
    kde_grid_points: int = KDE_GRID_POINTS
    pair_bins: int = PAIR_BINS
    box_whis: float = BOX_WHIS
    max_distance: float = MAX_DISTANCE_MILES
    max_speed: float = MAX_SPEED_MPH
    max_tip: float = MAX_TIP
    passenger_outlier: tuple[int, int] = PASSENGER_OUTLIER
    idle_distance: float = IDLE_DISTANCE
    idle_duration: float = IDLE_DURATION_MIN
    discrepancy_bands: tuple[float, float] = DISCREPANCY_BANDS
    high_fare: float = HIGH_FARE
    def with_(self, **kw) -> "TripRoles":
        return replace(self, **kw)

    def narrow_target(self, column: str) -> str | None:
        return dict(self.narrow_targets).get(column)

    def file_name(self, year: int, month: int) -> str:
        return self.file_name_template.format(taxi_type=self.taxi_type, year=year, month=month)

    @property
    def timestamp_columns(self) -> tuple[str, ...]:
        """Every column that a string timestamp is parsed in: the listed ones and the pickup and dropoff candidates."""
        return tuple(dict.fromkeys((*self.datetime_columns, *self.pickup_candidates, *self.dropoff_candidates)))

    def unknown_file_name(self) -> str:
        """The file of rows without a pickup time: the template with ``unknown`` for its period."""
        head = self.file_name_template.split("{year}")[0].format(taxi_type=self.taxi_type)
        return f"{head}unknown.parquet"

    def periods(self) -> list[tuple[int, int]]:
        """Year-major, then month, as the batch reader visits them."""
        return [(y, m) for y in range(self.year_start, self.year_end + 1) for m in self.months]


DEFAULT_ROLES = TripRoles()
