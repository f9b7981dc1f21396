"""What reading and pairing live records costs, and that the cheaper ways give the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from test_bytes_moved import moved, static_plans  # noqa: F401
from triplake.functions.scalars import to_bigint, to_double, to_naive_ts
from triplake.operators.join import join_outcomes

S = T.StringType()


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_usual_spellings_are_read_by_one_match(spark):
    df = spark.createDataFrame([("1",)], "v string").repartition(2)
    for read, first in ((to_naive_ts, r"CASE WHEN RLIKE(v#N, ^\d{4}-\d{2}-\d{2} "), (to_double, r"RLIKE(v#N, ^[+-]?\d++")):
        text = plan(df.select(read(F.col("v"), S).alias("r")))
        at = text.replace(text.split("v#")[1].split(",")[0], "N")
        assert first in at
        assert "regexp_extract" not in at.split(first)[1].split(" WHEN ")[0] and "trim" not in at.split(first)[1].split(" WHEN ")[0]


@pytest.mark.parametrize("text,number,whole", [
    ("5\n", 5.0, 5), ("5\u0085", 5.0, 5), ("5 ", 5.0, 5), ("\t-7.25 ", -7.25, -7), ("+3.", 3.0, 3), (".5", 0.5, 0), ("1e-2", 0.01, 0),
    ("1E5x", None, None), ("5f", None, None), ("0x1p3", None, None), ("--1", None, None), ("e5", None, None), ("", None, None),
    ("٣", None, None), ("1e999", float("inf"), None)])
def test_numbers_in_odd_spellings(spark, text, number, whole):
    r = spark.createDataFrame([(text,)], "v string").select(to_double(F.col("v"), S).alias("d"), to_bigint(F.col("v"), S).alias("i")).first()
    assert (r.d, r.i) == (number, whole)


@pytest.mark.parametrize("text,want", [
    ("2022-04-01 08:30:00 UTC", dt.datetime(2022, 4, 1, 8, 30)), ("2022-04-01 08:30:00", dt.datetime(2022, 4, 1, 8, 30)),
    ("2022-04-01 08:30:00 UTC\n", dt.datetime(2022, 4, 1, 8, 30)), ("2022-04-01 08:30:00 utc", None), ("2022-02-30 08:30:00 UTC", None),
    ("2022-04-01 24:00:00 UTC", None), ("2022-04-01 08:30:60 UTC", None), ("2022-04-01 08:30:00 UTC x", None),
    (" 2022-04-01 08:30:00 UTC", None), ("2022-04-01 08:30:00.5 UTC", dt.datetime(2022, 4, 1, 8, 30, 0, 500000))])
def test_timestamps_near_the_usual_spelling(spark, text, want):
    assert spark.createDataFrame([(text,)], "v string").select(to_naive_ts(F.col("v"), S).alias("t")).first().t == want


def test_null_safe_pairing_moves_each_input_once(spark, static_plans):  # noqa: F811
    schema = "unique_key string, trip_start_timestamp timestamp_ntz, fare double, tips double"
    t = dt.datetime(2022, 4, 1)
    req = spark.createDataFrame([("a", t, 2.0, None), ("a", t, 1.0, None), (None, t, 4.0, None), (None, t, 3.0, None), ("", t, 5.0, None),
                                 ("x", t, 6.0, None)], schema)
    out = spark.createDataFrame([("a", 8.0), ("a", 7.0), (None, 2.0), (None, None), ("", 9.0), ("y", 1.0)], "unique_key string, tips double")
    joined = join_outcomes(req, out, null_safe=True)
    assert joined.columns == req.columns and joined.schema["unique_key"].dataType == S
    assert sorted(map(str, ((r.unique_key, r.fare, r.tips) for r in joined.collect()))) == sorted(map(str, [
        ("a", 1.0, 7.0), (None, 3.0, None), ("", 5.0, 9.0)]))
    for method in ("min_struct", "window"):
        assert len(moved(join_outcomes(req, out, null_safe=True, method=method))) == 2
