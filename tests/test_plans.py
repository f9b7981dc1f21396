"""Plan shape: shuffles, pushdown and pruning that the scale design relies on."""

import contextlib
import io
import re

import pytest

from conftest import SF0001
from triplake import lake as lk
from triplake.operators.route import reject_records, route_counts
from triplake.operators.split import cut_days_frame
from triplake.plans.clean import clean_frames, flag_with_counts
from triplake.sources.fixture import trips_raw
from triplake.sources.historical import read_historical


@pytest.fixture(scope="module")
def raw_table(spark):
    path = lk.scratch_dir(spark, "test-plans")
    trips_raw(spark, SF0001).write.parquet(path)
    return path


@pytest.fixture()
def static_plans(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_silver_has_one_shuffle_and_pushes_scope(spark, raw_table, static_plans):
    silver = clean_frames(spark.read.parquet(raw_table))[0]
    assert exchanges(silver) == ["hashpartitioning"]
    plan = formatted(silver)
    assert "EqualTo(payment_type,Credit Card)" in plan
    assert "array_compact" not in silver._jdf.queryExecution().executedPlan().toString()


def test_rejects_have_no_shuffle(spark, raw_table, static_plans):
    rejects = reject_records(flag_with_counts(spark.read.parquet(raw_table))[1])
    assert exchanges(rejects) == []


def test_window_reaches_the_scan(spark, raw_table, static_plans):
    plan = formatted(read_historical(spark, raw_table, "1996-01-01", "2001-01-01"))
    assert "GreaterThanOrEqual(trip_start_timestamp,1996-01-01T00:00)" in plan
    assert "LessThan(trip_start_timestamp,2001-01-01T00:00)" in plan


def test_counts_and_cut_days_read_few_columns(spark, raw_table, static_plans):
    raw = spark.read.parquet(raw_table)
    plan = formatted(route_counts(raw))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "company" not in read and "unique_key" not in read
    silver_path = lk.scratch_dir(spark, "test-plans-silver")
    clean_frames(raw)[0].write.parquet(silver_path)
    cuts = formatted(cut_days_frame(spark.read.parquet(silver_path)))
    assert re.search(r"ReadSchema: struct<([^>]*)>", cuts).group(1) == "trip_start_ts:timestamp_ntz"
    assert "partial_count" in cuts and "percentile" not in cuts
