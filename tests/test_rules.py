"""Rules and three-way routing, table-driven over text rides."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import RAW_TEXT_COLUMNS, ride, text_frame
from triplake.operators.route import clean_projection, flag, reject_records, rejected_rows, route_counts, valid_rows
from triplake.schemas import SILVER_SCHEMA

CASES = [
    (ride("ok"), []),
    (ride("short", seconds="59.9"), ["bad_duration"]),
    (ride("edge-low", seconds="60", miles="0.1", fare="3.25", tips="0", pick="1"), []),
    (ride("edge-high", seconds="14400", miles="100", fare="500", pick="77.9"), []),
    (ride("long", seconds="14401"), ["bad_duration"]),
    (ride("no-fare", fare=None), ["bad_fare"]),
    (ride("cheap", fare="3.2"), ["bad_fare"]),
    (ride("tip-back", tips="-0.01"), ["bad_tips"]),
    (ride("far", miles="100.5", pick="78"), ["bad_distance", "bad_pickup_area"]),
    (ride("nowhere", drop="99", pick="77"), []),
    (ride("offset", start="2019-11-30T23:45:00+02:00"), []),
    (ride("broken", start="not a time", seconds=None, miles="x", fare="nan", tips="", pick="0"),
     ["missing_start_ts", "bad_duration", "bad_distance", "bad_fare", "bad_tips", "bad_pickup_area"]),
]


@pytest.fixture(scope="module")
def flagged(spark):
    return flag(text_frame(spark, [r for r, _ in CASES]))


def test_problems_by_case_in_rule_order(flagged):
    assert {r.unique_key: r.problems for r in flagged.collect()} == {r["unique_key"]: p for r, p in CASES}


def test_valid_and_rejected_split_the_scope(flagged):
    keys = lambda df: {r.unique_key for r in df.collect()}
    good = {r["unique_key"] for r, p in CASES if not p}
    assert keys(valid_rows(flagged)) == good
    assert keys(rejected_rows(flagged)) == {r["unique_key"] for r, _ in CASES} - good


def test_other_payments_are_filtered_whatever_their_problems(spark):
    rows = [ride("a"), ride("b", pay="Cash"), ride("c", pay=None, fare=None), ride("d", pay="credit card"), ride("e", tips="-3")]
    c = route_counts(text_frame(spark, rows)).first()
    assert (c.input_rows, c.filtered_rows, c.rejected_rows, c.valid_rows) == (5, 3, 1, 1)


def test_an_instant_is_a_start(spark):
    df = text_frame(spark, [ride()]).withColumn("trip_start_timestamp", F.timestamp_seconds(F.lit(1575157500)))
    assert flag(df).first().problems == []
    assert clean_projection(valid_rows(flag(df))).first().trip_start_ts == dt.datetime(2019, 11, 30, 23, 45)


def test_reject_record_holds_every_field_as_text(flagged):
    r = {x.unique_key: x for x in reject_records(flagged).collect()}["no-fare"]
    assert list(r.raw) and set(r.raw) == set(RAW_TEXT_COLUMNS)
    assert r.raw["fare"] is None and r.raw["tolls"] is None and r.raw["trip_miles"] == "7.75"


def test_silver_types_and_defaults(spark):
    rows = [ride("x", taxi="", tolls="?", extras=None, company="\tGreen Cabs "), ride("y", taxi=None, company=None, tolls="1.5")]
    out = clean_projection(valid_rows(flag(text_frame(spark, rows))))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]
    x, y = sorted(out.collect(), key=lambda r: r.unique_key)
    assert (x.taxi_id, x.tolls, x.extras, x.company) == ("unknown", 0.0, 0.0, "Green Cabs")
    assert (y.taxi_id, y.tolls, y.company) == ("unknown", 1.5, "Unknown")
    assert (x.trip_seconds, x.pickup_community_area, x.fare) == (1860, 41, 22.25)
