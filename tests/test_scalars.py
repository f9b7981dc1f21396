"""Coercion of dirty strings (F1-F6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from triplake.functions.scalars import default_strip, to_bigint, to_double, to_naive_ts

S = T.StringType()

CASES_NUM = [
    ("", None, None), (None, None, None), ("abc", None, None),
    ("12.0", 12.0, 12), ("12.7", 12.7, 12), ("-0.5", -0.5, 0), (" 5 ", 5.0, 5),
    ("1e3", 1000.0, 1000), ("nan", None, None), ("5d", None, None), ("1_000", None, None),
    ("-12.7", -12.7, -12), ("1e30", 1e30, None),
    ("inf", float("inf"), None), ("-Infinity", float("-inf"), None), ("1e400", float("inf"), None),
]


@pytest.mark.parametrize("text,as_double,as_bigint", CASES_NUM)
def test_numbers(spark, text, as_double, as_bigint):
    df = spark.createDataFrame([(text,)], "v string")
    r = df.select(to_double(F.col("v"), S).alias("d"), to_bigint(F.col("v"), S).alias("i")).first()
    assert r.d == as_double and r.i == as_bigint


CASES_TS = [
    ("2022-04-01 08:30:00 UTC", dt.datetime(2022, 4, 1, 8, 30)),
    ("2022-04-01T08:30:00Z", dt.datetime(2022, 4, 1, 8, 30)),
    ("2022-04-01T08:30:00", dt.datetime(2022, 4, 1, 8, 30)),
    ("2022-04-01 08:30:00+05:00", dt.datetime(2022, 4, 1, 3, 30)),
    ("2022-04-01 08:30:00-0130", dt.datetime(2022, 4, 1, 10, 0)),
    ("2022-04-01 08:30:00.250000", dt.datetime(2022, 4, 1, 8, 30, 0, 250000)),
    ("2022-04-01", dt.datetime(2022, 4, 1)),
    ("2022", None), ("2022-1-1", None), ("2022-13-01", None), ("2022-W13-5", None), ("2022-091", None),
    ("20220101", dt.datetime(2022, 1, 1)), ("2022-04-01T08", dt.datetime(2022, 4, 1, 8)),
    ("20220401T083000,1234567Z", dt.datetime(2022, 4, 1, 8, 30, 0, 123456)), ("20220431", None),
    ("", None), (None, None), ("garbage", None),
]


@pytest.mark.parametrize("text,expected", CASES_TS)
def test_timestamps(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(to_naive_ts(F.col("v"), S).alias("t")).first().t == expected


def test_timestamps_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("2022-04-01 08:30:00+05:00",)], "v string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(to_naive_ts(F.col("v"), S).alias("t")).first().t == dt.datetime(2022, 4, 1, 3, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("text,expected", [
    (" Flash Cab ", "Flash Cab"), ("\tA\n", "A"), ("", "Unknown"), ("  ", ""), (None, "Unknown"),
    (" B　", "B"),
])
def test_default_strip(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(default_strip(F.col("v"), "Unknown").alias("c")).first().c == expected
