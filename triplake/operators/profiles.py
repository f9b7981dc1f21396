"""Profiles of raw trips (extent, payment mix, dirtiness, tip histogram).

All are single-pass aggregates with map-side partial aggregation; the
only shuffle of size is the distinct-key count in ``dirtiness``, which
Catalyst plans as a two-level aggregate hashed on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from triplake.sources.historical import time_window
from triplake.schemas import SCOPE_VALUE


def extent(raw: DataFrame, ts: str = "trip_start_timestamp") -> DataFrame:
    return raw.agg(F.min(ts).alias("first_trip"), F.max(ts).alias("last_trip"))


def payment_mix(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Per payment type: trips, average tip (2 dp), share with a tip (3 dp); busiest first."""
    rows = time_window(raw, start, end)
    return (rows.groupBy("payment_type").agg(
                F.count(F.lit(1)).alias("trips"),
                F.round(F.avg("tips"), 2).alias("avg_tip"),
                F.round(F.count_if(F.col("tips") > 0) / F.count(F.lit(1)), 3).alias("share_with_tip"))
            .orderBy(F.col("trips").desc()))


def dirtiness(raw: DataFrame, start=None, end=None) -> DataFrame:
    """Counts of suspicious values and of duplicate keys (null keys count as duplicates)."""
    rows = time_window(raw, start, end)
    c = F.col
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c("trip_seconds").isNull() | (c("trip_seconds") < 60)).alias("bad_duration"),
        F.count_if(c("trip_miles").isNull() | (c("trip_miles") < 0.1)).alias("bad_distance"),
        F.count_if(c("fare").isNull() | (c("fare") <= 0)).alias("bad_fare"),
        F.count_if(c("pickup_community_area").isNull()).alias("no_pickup_area"),
        F.count_if(c("dropoff_community_area").isNull()).alias("no_dropoff_area"),
        (F.count(F.lit(1)) - F.count_distinct(c("unique_key"))).alias("duplicates"),
    )


def tip_histogram(raw: DataFrame, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Card trips with fare > 0: tip/fare rounded to 0.1, every bucket (or the first ``limit``)."""
    rows = time_window(raw, start, end).where(
        (F.col("payment_type") == SCOPE_VALUE) & (F.col("fare") > 0))
    bucket = F.round(F.try_divide(F.col("tips"), F.col("fare")), 1).alias("tip_pct_bucket")
    out = (rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("trips"))
           .orderBy(F.col("tip_pct_bucket").asc_nulls_first()))
    return out if limit is None else out.limit(limit)
