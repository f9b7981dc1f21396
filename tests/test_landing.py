"""Live path on a small landing of its own: windows, grace days, keys, pairing."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import ride, text_frame
from triplake import lake as lk
from triplake.operators.join import join_outcomes, pending_requests
from triplake.operators.route import conform_raw
from triplake.schemas import OUTCOMES_FOLDER, RAW_COLUMNS, REQUESTS_FOLDER
from triplake.sources.landing import day_folders, read_live, read_pending, read_requests
from triplake.streaming.join import run_stream_join

# (day, key, fare) and (day of arrival, key, tips); the window is 3 to 5 May
REQUESTS = [("2020-05-02", "early", "9"), ("2020-05-03", "first", "10"), ("2020-05-04", "last", "20"), ("2020-05-04", "slow", "30"),
            ("2020-05-04", "first", "11"), ("2020-05-04", "never", "40"), ("2020-05-05", "after", "50"),
            ("2020-05-03", None, "60"), ("2020-05-04", None, "61"), ("2020-05-04", None, "61")]
OUTCOMES = [("2020-05-03", "first", "1.5"), ("2020-05-04", "first", "1.25"), ("2020-05-05", "last", "2"), ("2020-05-06", "slow", "3"),
            ("2020-05-04", None, "7"), ("2020-05-05", "after", "5")]


def _land(spark, root, folder, rows):
    for day in {r["event_date"] for r in rows}:
        lines = spark.createDataFrame([(json.dumps({k: v for k, v in r.items() if k != "event_date"}),)
                                       for r in rows if r["event_date"] == day], "value string")
        lines.write.text(f"{lk.landing_root(root, folder)}/event_date={day}")


@pytest.fixture(scope="module")
def landing(spark):
    root = lk.scratch_dir(spark, "test-landing")
    requests = [{k: v for k, v in ride(key, f"{day} 10:00:00 UTC", fare=fare).items() if k != "tips"} | {"event_date": day}
                for day, key, fare in REQUESTS]
    _land(spark, root, REQUESTS_FOLDER, requests)
    _land(spark, root, OUTCOMES_FOLDER, [{"unique_key": k, "tips": t, "event_date": d} for d, k, t in OUTCOMES])
    return root


WINDOW = ("2020-05-03", "2020-05-05")


def test_days_of_a_window_end_exclusive(spark, landing):
    days = day_folders(spark, lk.landing_root(landing, REQUESTS_FOLDER), dt.date(2020, 5, 3), dt.date(2020, 5, 5))
    assert [d[-10:] for d in days] == ["2020-05-03", "2020-05-04"]
    assert day_folders(spark, lk.landing_root(landing, "missing"), dt.date(2020, 5, 3), dt.date(2020, 5, 5)) == []
    assert read_requests(spark, landing, *WINDOW).count() == 8
    assert read_requests(spark, landing, "2031-01-01", "2031-02-01").count() == 0


@pytest.mark.parametrize("grace, keys", [(0, {"first"}), (1, {"first", "last"}), (2, {"first", "last", "slow"})])
def test_grace_days_let_late_outcomes_in(spark, landing, grace, keys):
    got = {r.unique_key: (r.fare, r.tips) for r in read_live(spark, landing, *WINDOW, grace_days=grace).collect()}
    assert set(got) == keys
    assert got["first"] == (10.0, 1.25)  # earliest request, smallest tip
    streamed = run_stream_join(spark, landing, lk.scratch_dir(spark, "test-landing-stream"), *WINDOW,
                               grace_days=grace, partitions=2, files_per_batch=1)
    assert {r.unique_key: (r.fare, r.tips) for r in streamed.collect()} == got


def test_null_keys_pair_only_when_asked(spark, landing):
    keys = [r.unique_key for r in read_live(spark, landing, *WINDOW, null_safe=True).collect()]
    assert sorted(keys, key=str) == sorted([None, "first", "last"], key=str)


def test_every_request_without_a_key_is_pending(spark, landing):
    got = [r.unique_key for r in read_pending(spark, landing, *WINDOW).collect()]
    assert sorted(got, key=str) == sorted([None, None, None, "never", "slow"], key=str)


def test_conform_types_text_and_drops_the_rest(spark):
    df = text_frame(spark, [ride("k", seconds="12.9", pick="", drop="7.0")]).withColumn("more", F.lit(1))
    out = conform_raw(df)
    assert out.columns == RAW_COLUMNS
    r = out.first()
    assert (r.trip_seconds, r.pickup_community_area, r.dropoff_community_area) == (12, None, 7)
    assert r.trip_start_timestamp == dt.datetime(2019, 11, 30, 23, 45)


def test_join_of_empty_sides(spark):
    req = conform_raw(text_frame(spark, [ride("only")]))
    none = spark.createDataFrame([], "unique_key string, tips double")
    assert join_outcomes(req, none).count() == 0 and pending_requests(req, none).count() == 1
    assert join_outcomes(req.limit(0), none).count() == 0 and pending_requests(req.limit(0), none).count() == 0
