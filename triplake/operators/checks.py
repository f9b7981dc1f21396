"""Quality checks of one silver run (uniqueness, nulls, date range)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def for_run(silver: DataFrame, run_id: str | None) -> DataFrame:
    return silver if run_id is None else silver.where(F.col("run_id") == F.lit(run_id))


def uniqueness(silver: DataFrame, run_id: str | None = None, key: str = "unique_key") -> DataFrame:
    rows = for_run(silver, run_id)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))


def nulls(silver: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = for_run(silver, run_id)
    return rows.agg(
        F.count_if(F.col("trip_start_ts").isNull()).alias("null_start"),
        F.count_if(F.col("fare").isNull()).alias("null_fare"),
        F.count_if(F.col("tips").isNull()).alias("null_tips"),
    )


def date_range(silver: DataFrame, start, end, run_id: str | None = None,
               ts: str = "trip_start_ts") -> DataFrame:
    """First/last trip and rows outside ``[start, end)``; ``in_range`` when none are."""
    rows = for_run(silver, run_id)
    t = F.col(ts)
    lo = F.lit(f"{start} 00:00:00").cast(T.TimestampNTZType())
    hi = F.lit(f"{end} 00:00:00").cast(T.TimestampNTZType())
    out = rows.agg(
        F.min(t).alias("first_trip"),
        F.max(t).alias("last_trip"),
        F.count_if(t < lo).alias("rows_before_start"),
        F.count_if(t >= hi).alias("rows_after_end"),
        F.count_if(t.isNull()).alias("rows_without_start"),
    )
    ok = (F.col("rows_before_start") + F.col("rows_after_end") + F.col("rows_without_start")) == 0
    return out.withColumn("in_range", ok)


def all_checks(silver: DataFrame, run_id: str | None = None, start=None, end=None,
               key: str = "unique_key", ts: str = "trip_start_ts") -> DataFrame:
    """Every check of one run in a single pass (one row).

    One aggregate: the distinct-key count becomes a partial aggregate
    hashed on the key, the rest are plain partial counts.
    """
    rows = for_run(silver, run_id)
    t = F.col(ts)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(t.isNull()).alias("null_start"),
        F.count_if(F.col("fare").isNull()).alias("null_fare"),
        F.count_if(F.col("tips").isNull()).alias("null_tips"),
        F.min(t).alias("first_trip"),
        F.max(t).alias("last_trip"),
    ]
    if start is not None and end is not None:
        lo = F.lit(f"{start} 00:00:00").cast(T.TimestampNTZType())
        hi = F.lit(f"{end} 00:00:00").cast(T.TimestampNTZType())
        aggs.append(F.count_if((t < lo) | (t >= hi)).alias("rows_outside_window"))
    return rows.agg(*aggs)
