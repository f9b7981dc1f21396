"""Historical source: a typed raw-trips table read over a half-open window.

Windows are UTC days whatever the session's time zone: the bound is written
as a literal of the column's own type (an instant for TIMESTAMP, a wall time
for TIMESTAMP_NTZ), so the predicate stays on the bare column and reaches
the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake.functions.scalars import to_naive_ts
from triplake.operators.route import conform_raw
from triplake.schemas import RAW_COLUMNS


def ts_literal(value, dtype: T.DataType | None = None) -> F.Column:
    """A date / datetime / ISO string (UTC) as a literal: an instant for TIMESTAMP, else TIMESTAMP_NTZ."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        text = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = str(value)
    if isinstance(dtype, T.TimestampType):
        return F.lit(f"{text}{'' if ':' in text else ' 00:00:00'}+00:00").cast(T.TimestampType())
    return F.lit(text).cast(T.TimestampNTZType())


def time_window(df: DataFrame, start=None, end=None, ts: str = "trip_start_timestamp") -> DataFrame:
    """``start <= ts < end`` in UTC; a None bound is open.  Text columns are parsed first (nothing is pushed then)."""
    dtype = df.schema[ts].dataType
    c = F.col(ts) if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else to_naive_ts(F.col(ts), dtype)
    out = df
    if start is not None:
        out = out.where(c >= ts_literal(start, dtype))
    if end is not None:
        out = out.where(c < ts_literal(end, dtype))
    return out


def utc_wall_times(df: DataFrame) -> DataFrame:
    """Every TIMESTAMP column as the zone-less wall time in UTC; the rest as it is."""
    return df.select(*[to_naive_ts(F.col(f.name), f.dataType).alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields])


def open_raw(spark: SparkSession, source) -> DataFrame:
    """A raw table with all its columns: a DataFrame, a table name or a Parquet path."""
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def read_historical(spark: SparkSession, source, start=None, end=None) -> DataFrame:
    """The 13 raw columns of ``source`` in ``[start, end)``, in the typed RAW shape."""
    df = open_raw(spark, source)
    return conform_raw(time_window(df.select(*[c for c in RAW_COLUMNS if c in df.columns]), start, end))
