"""Stored instants: windows, days and texts are UTC in every session time zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ride, text_frame
from triplake import lake as lk
from triplake.operators.route import conform_raw, flag, reject_records
from triplake.plans.export import run_export
from triplake.schemas import OUTCOME_SCHEMA, OUTCOMES_FOLDER, REQUEST_SCHEMA, REQUESTS_FOLDER
from triplake.sources.historical import read_historical
from triplake.sources.landing import read_landing

STARTS = ["2022-01-01 00:30:00", "2021-12-31 23:59:59.5", "2022-01-01 23:59:59", "2022-01-02 00:00:00", None]


@pytest.fixture(params=["UTC", "America/Chicago", "Asia/Kolkata"])
def zoned(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    typed = conform_raw(text_frame(spark, [ride(f"k{i}", s, fare=None if i == 0 else "9") for i, s in enumerate(STARTS)]))
    instant = lambda c: F.concat(c.cast("string"), F.lit("+00:00")).cast("timestamp")
    start = F.col("trip_start_timestamp")
    yield typed.withColumn("trip_end_timestamp", instant(F.timestamp_add("MINUTE", F.lit(15), start))).withColumn(
        "trip_total", F.lit(99.0)).withColumn("tract", F.lit("t")).withColumn("trip_start_timestamp", instant(start))
    spark.conf.set("spark.sql.session.timeZone", old)


def test_window_and_types(spark, zoned):
    path = lk.scratch_dir(spark, "test-zones")
    zoned.write.parquet(path)
    df = read_historical(spark, path, "2022-01-01", "2022-01-02")
    assert "PushedFilters: [IsNotNull(trip_start_timestamp), GreaterThanOrEqual" in df._jdf.queryExecution().toString()
    got = {r.unique_key: r.trip_start_timestamp for r in df.collect()}
    assert got == {"k0": dt.datetime(2022, 1, 1, 0, 30), "k2": dt.datetime(2022, 1, 1, 23, 59, 59)}


def test_reject_text_is_utc(zoned):
    r = reject_records(flag(zoned)).where("unique_key = 'k0'").first()
    assert r.raw["trip_start_timestamp"] == "2022-01-01 00:30:00"


@pytest.mark.parametrize("stage", [True, False])
def test_export_keeps_stored_values(spark, zoned, stage):
    root = lk.scratch_dir(spark, "test-zones-lake")
    run_export(spark, zoned, root, "2022-01-01", "2022-01-02", stage=stage)
    out = read_landing(spark, root, OUTCOMES_FOLDER, "2022-01-01", "2022-01-02", OUTCOME_SCHEMA)
    rows = {r.unique_key: r for r in out.collect()}
    assert set(rows) == {"k0", "k2"}
    assert rows["k0"].trip_end_timestamp == "2022-01-01 00:45:00 UTC" and float(rows["k0"].trip_total) == 99.0
    lines = spark.read.json(f"{lk.landing_root(root, REQUESTS_FOLDER)}/event_date=2022-01-01")
    assert {"tract", "trip_end_timestamp"} <= set(lines.columns) and not {"tips", "trip_total"} & set(lines.columns)
    req = read_landing(spark, root, REQUESTS_FOLDER, "2022-01-01", "2022-01-02", REQUEST_SCHEMA)
    assert {r.trip_start_timestamp for r in req.collect()} == {"2022-01-01 00:30:00 UTC", "2022-01-01 23:59:59 UTC"}
