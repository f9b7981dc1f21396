"""Lake helpers: run ids, run windows, concurrent actions."""

import datetime as dt

import pytest

from triplake import lake as lk
from triplake.plans.checks import parse_run_window


def test_run_id_and_window_round_trip():
    rid = lk.make_run_id(dt.date(2022, 1, 1), dt.date(2022, 1, 8), "20260101-120000")
    assert rid == "2022-01-01_2022-01-08_20260101-120000"
    assert parse_run_window(rid) == ("2022-01-01", "2022-01-08")
    assert parse_run_window(lk.make_run_id(None, None, "20260101-120000")) == (None, None)


def test_run_timestamp_format():
    assert lk.run_timestamp(dt.datetime(2026, 9, 30, 15, 30, 0)) == "20260930-153000"


def test_zone_paths():
    assert lk.silver_dir("L", "trips", "r") == "L/silver/trips/run_id=r"
    assert lk.rejects_dir("L", "trips", "r") == "L/rejected/trips/run_id=r"
    assert lk.gold_dir("L/gold/x", "v1") == "L/gold/x/v1"


def test_run_concurrently_returns_in_order_and_raises():
    assert lk.run_concurrently(lambda: 1, lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        lk.run_concurrently(lambda: 1, lambda: 1 / 0)


def test_write_text_refuses_to_overwrite(spark):
    path = f"{lk.scratch_dir(spark, 'test-text')}/_note.json"
    lk.write_text(spark, path, '{"a": 1}')
    assert lk.read_text(spark, path) == '{"a": 1}'
    with pytest.raises(Exception):
        lk.write_text(spark, path, "again")


def test_a_stream_session_leaves_the_caller_as_it_is(spark):
    from triplake.streaming.dedupe import own_session
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert own_session(spark, 3).conf.get(key) == "3" and spark.conf.get(key) == before


def test_scratch_is_refused_where_executors_do_not_share_it():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lk.scratch_dir(Session())


def test_local_sessions_get_a_scratch_folder(spark):
    assert lk.scratch_dir(spark, "x").startswith(lk.checkpoint_root(spark))
