"""Declared schemas and fixed values of the trip data model.

Schemas are declared, never inferred.  Timestamps are zone-less
(``TIMESTAMP_NTZ``) and hold UTC wall time end to end.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# These must equal the reference pipeline's values for
# identical results.
# --------------------------------------------------------------------------
SCOPE_COLUMN = "payment_type"
SCOPE_VALUE = "Credit Card"

MIN_SECONDS, MAX_SECONDS = 60, 4 * 3600
MIN_MILES, MAX_MILES = 0.1, 100.0
MIN_FARE, MAX_FARE = 3.25, 500.0
MIN_AREA, MAX_AREA = 1, 77

PROBLEM_NAMES = (
    "missing_start_ts",
    "bad_duration",
    "bad_distance",
    "bad_fare",
    "bad_tips",
    "bad_pickup_area",
)

DEFAULT_TAXI_ID = "unknown"
DEFAULT_COMPANY = "Unknown"          # silver default
FEATURE_DEFAULT_COMPANY = "unknown"  # feature default (differs on purpose)

TIP_THRESHOLD = 0.20
AIRPORT_AREAS = (56, 76)
DOWNTOWN_AREAS = (8, 32, 33)
UNKNOWN_AREA = -1

OUTCOME_GRACE_DAYS = 1
VAL_FRAC = 0.10
TEST_FRAC = 0.10
QUANTILE_RELATIVE_ERROR = 0.001

REQUESTS_FOLDER = "live_trips"
OUTCOMES_FOLDER = "ground_truth"
HISTORICAL_DATASET = "trips"
LIVE_DATASET = "live_trips"

FEATURE_COLUMNS = [
    "hour", "day_of_week", "is_weekend",
    "trip_miles", "trip_minutes", "avg_speed_mph",
    "fare", "fare_per_mile", "extras", "tolls", "has_extras",
    "pickup_area", "dropoff_area", "is_airport", "is_downtown", "same_area",
    "company",
]
ID_COLUMNS = ["unique_key", "trip_start_ts"]
# --------------------------------------------------------------------------

S, L, D = T.StringType(), T.LongType(), T.DoubleType()
TS = T.TimestampNTZType()


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMA = _struct([
    ("unique_key", S),
    ("taxi_id", S),
    ("trip_start_timestamp", TS),
    ("trip_seconds", L),
    ("trip_miles", D),
    ("pickup_community_area", L),
    ("dropoff_community_area", L),
    ("fare", D),
    ("tips", D),
    ("tolls", D),
    ("extras", D),
    ("payment_type", S),
    ("company", S),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

SILVER_SCHEMA = _struct([
    ("unique_key", S),
    ("taxi_id", S),
    ("trip_start_ts", TS),
    ("trip_seconds", L),
    ("trip_miles", D),
    ("fare", D),
    ("tips", D),
    ("pickup_community_area", L),
    ("dropoff_community_area", L),
    ("tolls", D),
    ("extras", D),
    ("company", S),
])
SILVER_COLUMNS = SILVER_SCHEMA.fieldNames()

# Total order used to keep one deterministic row per key in silver.
SILVER_ORDER = [
    "trip_start_ts", "taxi_id", "trip_seconds", "trip_miles", "fare", "tips",
    "pickup_community_area", "dropoff_community_area", "tolls", "extras", "company",
]

GOLD_SCHEMA = _struct([
    ("unique_key", S),
    ("trip_start_ts", TS),
    ("split", S),
    ("hour", L),
    ("day_of_week", L),
    ("is_weekend", L),
    ("trip_miles", D),
    ("trip_minutes", D),
    ("avg_speed_mph", D),
    ("fare", D),
    ("fare_per_mile", D),
    ("extras", D),
    ("tolls", D),
    ("has_extras", L),
    ("pickup_area", L),
    ("dropoff_area", L),
    ("is_airport", L),
    ("is_downtown", L),
    ("same_area", L),
    ("company", S),
    ("label", L),
])
GOLD_COLUMNS = GOLD_SCHEMA.fieldNames()

# Landing records arrive as JSON lines; every value is read as text and
# typed later with the coercion functions (numbers may be JSON strings).
REQUEST_COLUMNS = [c for c in RAW_COLUMNS if c != "tips"]
REQUEST_SCHEMA = _struct([(c, S) for c in REQUEST_COLUMNS])
OUTCOME_COLUMNS = ["unique_key", "tips", "trip_total", "trip_end_timestamp"]
OUTCOME_SCHEMA = _struct([(c, S) for c in OUTCOME_COLUMNS])
EVENT_DATE = "event_date"

REJECT_SCHEMA = T.StructType([
    T.StructField("unique_key", S, True),
    T.StructField("problems", T.ArrayType(S, False), False),
    T.StructField("raw", T.MapType(S, S, True), False),
])
