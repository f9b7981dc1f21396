"""Leakage-free time split: cut days from the data, then a CASE column.

Cut days are quantiles of the trip start, floored to the UTC day.

* ``exact`` (default): rows per start day (partial counts, hashed by day),
  a running sum over those few thousand day counts, and the first day that
  reaches each share.  Flooring is monotone, so the day of the k-th start
  equals the k-th start day.
* ``approx``: ``percentile_approx`` over epoch seconds with relative error
  0.001, as a Greenwald-Khanna sketch per partition.

Only two dates ever reach the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from triplake.functions.scalars import ntz_seconds
from triplake.schemas import QUANTILE_RELATIVE_ERROR, TEST_FRAC, VAL_FRAC


def check_fractions(val_frac: float, test_frac: float) -> None:
    if not (0 < val_frac < 1 and 0 < test_frac < 1 and 0 < val_frac + test_frac < 1):
        raise ValueError("val_frac and test_frac must each be in (0, 1) and sum below 1")


def cut_days_frame(df: DataFrame, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC,
                   ts: str = "trip_start_ts", method: str = "exact") -> DataFrame:
    """One row ``(val_start date, test_start date)``."""
    return _cuts(df, val_frac, test_frac, ts, method).drop("first_day")


def _cuts(df: DataFrame, val_frac: float, test_frac: float, ts: str, method: str) -> DataFrame:
    """One aggregate pass: both cut days and the first start day."""
    check_fractions(val_frac, test_frac)
    q_val, q_test = 1.0 - val_frac - test_frac, 1.0 - test_frac
    t = F.col(ts)
    if method == "exact":
        days = (df.select(F.to_date(t).alias("_d")).where("_d IS NOT NULL")
                .groupBy("_d").agg(F.count(F.lit(1)).alias("_n")))
        so_far = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        days = days.select("_d", F.sum("_n").over(so_far).alias("_upto"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
        reached = lambda q: F.min(F.when(F.col("_upto") >= F.ceil(F.lit(q) * F.col("_all")), F.col("_d")))
        return days.agg(reached(q_val).alias("val_start"), reached(q_test).alias("test_start"),
                        F.min("_d").alias("first_day"))
    if method == "approx":
        secs = ntz_seconds(t).alias("_s")
        accuracy = int(round(1.0 / QUANTILE_RELATIVE_ERROR))
        q = df.select(secs, F.to_date(t).alias("_day")).agg(
            F.percentile_approx("_s", [q_val, q_test], accuracy).alias("_q"),
            F.min("_day").alias("first_day"))
        day = lambda i: F.date_from_unix_date(F.floor(F.col("_q")[i] / F.lit(86400)).cast("int"))
        return q.select(day(0).alias("val_start"), day(1).alias("test_start"), "first_day")
    raise ValueError(f"unknown method {method!r}")


def approx_rank_errors(df: DataFrame, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC,
                       ts: str = "trip_start_ts") -> DataFrame:
    """One row ``(val_within, test_within)``: whether the sketch's cuts lie within the relative error of their ranks."""
    q_val, q_test = 1.0 - val_frac - test_frac, 1.0 - test_frac
    secs = df.select(ntz_seconds(F.col(ts)).alias("_s")).where("_s IS NOT NULL")
    sketch = F.percentile_approx("_s", [q_val, q_test], int(round(1.0 / QUANTILE_RELATIVE_ERROR)))
    v, t = secs.agg(sketch.alias("_q")).first()["_q"] or (None, None)
    n, e = F.count(F.lit(1)), QUANTILE_RELATIVE_ERROR
    # one row more, as ranks are whole
    within = lambda cut, share: ((F.count_if(F.col("_s") <= F.lit(cut)) + 1 >= n * (share - e))
                                 & (F.count_if(F.col("_s") < F.lit(cut)) - 1 <= n * (share + e)))
    return secs.agg(within(v, q_val).alias("val_within"), within(t, q_test).alias("test_within"))


def cut_dates(df: DataFrame, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC,
              ts: str = "trip_start_ts", method: str = "exact",
              strict: bool = True) -> tuple[dt.date, dt.date]:
    """``(val_start, test_start)`` on the driver (the only collected values).

    ``strict`` rejects cuts that leave train or val empty.
    """
    row = _cuts(df, val_frac, test_frac, ts, method).first()
    if row is None or row["val_start"] is None or row["test_start"] is None:
        raise ValueError("cannot compute split dates: no rows with a start time")
    v, t = row["val_start"], row["test_start"]
    if strict and (v <= row["first_day"] or t <= v):
        raise ValueError(f"split dates {v}, {t} leave train or val empty; "
                         "widen the window or pass strict=False")
    return v, t


def split_column(val_start: dt.date | str, test_start: dt.date | str,
                 ts: str = "trip_start_ts") -> Column:
    """'train' before val_start, 'val' before test_start, else 'test' (null ts -> test)."""
    t = F.col(ts)
    v = F.lit(f"{val_start} 00:00:00").cast(T.TimestampNTZType())
    s = F.lit(f"{test_start} 00:00:00").cast(T.TimestampNTZType())
    return F.when(t < v, F.lit("train")).when(t < s, F.lit("val")).otherwise(F.lit("test"))


def assign_split(df: DataFrame, val_start, test_start, ts: str = "trip_start_ts") -> DataFrame:
    return df.withColumn("split", split_column(val_start, test_start, ts))
