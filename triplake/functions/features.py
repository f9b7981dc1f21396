"""Row-level features and label as native Columns (no pandas in the path).

``feature_columns()`` returns the seventeen features in their fixed order;
each is a pure function of one silver row, so the same Columns serve batch
DataFrames, streaming DataFrames and single-row scoring frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from triplake.schemas import (
    AIRPORT_AREAS,
    DOWNTOWN_AREAS,
    FEATURE_COLUMNS,
    FEATURE_DEFAULT_COMPANY,
    TIP_THRESHOLD,
    UNKNOWN_AREA,
)
from triplake.functions.scalars import strip_whitespace



def _nan_to_null(c: Column) -> Column:
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("bigint")


def feature_columns(ts: str = "trip_start_ts") -> list[Column]:
    """The seventeen feature Columns, in ``FEATURE_COLUMNS`` order."""
    t = F.col(ts)
    dow = F.weekday(t)                                   # Monday = 0
    miles = _nan_to_null(F.col("trip_miles"))
    seconds = _nan_to_null(F.col("trip_seconds"))
    hours = seconds / F.lit(3600.0)
    fare = _nan_to_null(F.col("fare"))
    extras = F.coalesce(_nan_to_null(F.col("extras")), F.lit(0.0))
    tolls = F.coalesce(_nan_to_null(F.col("tolls")), F.lit(0.0))
    pickup = F.coalesce(F.col("pickup_community_area").cast("bigint"), F.lit(UNKNOWN_AREA).cast("bigint"))
    dropoff = F.coalesce(F.col("dropoff_community_area").cast("bigint"), F.lit(UNKNOWN_AREA).cast("bigint"))
    cols = {
        "hour": F.hour(t).cast("bigint"),
        "day_of_week": dow.cast("bigint"),
        "is_weekend": _flag(dow >= 5),
        "trip_miles": miles,
        "trip_minutes": seconds / F.lit(60.0),
        "avg_speed_mph": F.when(hours > 0, miles / hours).otherwise(F.lit(0.0)),
        "fare": fare,
        "fare_per_mile": F.when(miles > 0, fare / miles).otherwise(F.lit(0.0)),
        "extras": extras,
        "tolls": tolls,
        "has_extras": _flag(extras > 0),
        "pickup_area": pickup,
        "dropoff_area": dropoff,
        "is_airport": _flag(pickup.isin(*AIRPORT_AREAS) | dropoff.isin(*AIRPORT_AREAS)),
        "is_downtown": _flag(pickup.isin(*DOWNTOWN_AREAS) | dropoff.isin(*DOWNTOWN_AREAS)),
        "same_area": _flag((pickup == dropoff) & (pickup != F.lit(UNKNOWN_AREA))),
        "company": strip_whitespace(F.coalesce(F.col("company"), F.lit(FEATURE_DEFAULT_COMPANY))),
    }
    return [cols[name].alias(name) for name in FEATURE_COLUMNS]


def label_column(tips: str = "tips", fare: str = "fare", threshold: float = TIP_THRESHOLD) -> Column:
    """1 when tips / fare > threshold (strictly), else 0.

    Division semantics follow floating point: fare = 0 gives +inf (label 1)
    when tips > 0 and NaN (label 0) when tips = 0; null or NaN inputs give 0.
    """
    t = _nan_to_null(F.col(tips))
    f = _nan_to_null(F.col(fare))
    ratio_above = F.when(f == 0, t > 0).otherwise(F.try_divide(t, f) > F.lit(float(threshold)))
    return _flag(ratio_above).alias("label")


def build_features(df: DataFrame, keep: list[str] | None = None, ts: str = "trip_start_ts") -> DataFrame:
    """Exactly the feature columns, one row per input row; ``keep`` in front."""
    return df.select(*[F.col(c) for c in (keep or [])], *feature_columns(ts))
