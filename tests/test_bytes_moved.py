"""What the trips' joins, the staged copy of a run and the landings move between tasks."""

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F, types as T

from conftest import SF0001, ride, text_frame
from triplake import lake as lk
from triplake.catalog import queries as q
from triplake.operators.route import conform_raw
from triplake.plans import clean
from triplake.sources.fixture import trips_raw
from triplake.sources.silver import read_rejects, read_silver_run

LINES = [(k, p, 25, i, 3.0, 1000.5, 0.05, tax, flag, status, dt.datetime(1997, m, 5)) for i, (k, p, tax, flag, status, m) in enumerate([
    (1, 7, 0.0, "N", "O", 1), (1, 8, 0.02, "R", "F", 2), (2, 7, 0.04, "N", "F", 2), (2, 8, 0.0, None, "O", 3), (3, 7, 0.0, "A", None, 3),
    (3, 8, None, None, None, 4), (None, 7, 0.0, "A", "F", 4), (2, None, 0.0, "A", "F", 1), (4, 7, 0.0, "N", None, 5)])]
ORDERS = [(1, 90), (2, 167), (2, 78), (3, None), (4, -13), (None, 5)]
PARTS = [(7, "Brand#11"), (8, None)]


@pytest.fixture(scope="module")
def tables(spark):
    root = lk.scratch_dir(spark, "test-tables")
    li = T.StructType([T.StructField(n, t) for n, t in (
        [(n, T.LongType()) for n in ("l_orderkey", "l_partkey", "l_suppkey")] + [("l_linenumber", T.IntegerType())]
        + [(n, T.DoubleType()) for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
        + [("l_returnflag", T.StringType()), ("l_linestatus", T.StringType()), ("l_shipdate", T.TimestampNTZType())])])
    for name, rows, schema in (("lineitem", LINES, li),
                               ("orders", ORDERS, "o_orderkey long, o_custkey long"),
                               ("part", PARTS, "p_partkey long, p_brand string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture()
def static_plans(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def moved(df) -> list[str]:
    """The columns that each exchange moves."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", buf.getvalue())


def test_the_joins_of_the_trips_move_neither_their_texts_nor_customers(spark, tables, static_plans):
    rows = moved(trips_raw(spark, tables))
    assert len(rows) == 4
    assert not any(c in r for r in rows for c in ("l_returnflag", "l_linestatus", "o_custkey"))


def test_the_trips_of_null_and_repeated_keys(spark, tables):
    got = sorted((r.unique_key, str(r.payment_type), str(r.dropoff_community_area)) for r in trips_raw(spark, tables).collect())
    card, cash = "Credit Card", "Cash"
    assert got == sorted([
        ("1-0", cash, "None"), ("1-1", card, "None"), ("2-2", "None", "77"), ("2-2", "None", "None"), ("2-3", cash, "77"),
        ("2-3", cash, "None"), ("3-4", card, "None"), ("3-5", "None", "None"), ("4-8", "None", "None")])


def test_trips_dealt_by_month_are_the_same_and_dealt_before_they_are_made(spark, tables):
    by_month = trips_raw(spark, tables, "month")
    assert sorted(map(str, by_month.collect())) == sorted(map(str, trips_raw(spark, tables).collect()))
    above, below = by_month._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions [_day")
    assert "AS unique_key" in above and "AS unique_key" not in below and "trunc(" in below


def test_a_landing_with_broken_lines_deals_no_made_trips(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(q, "write_landings", lambda trips, root, lines, day: dealt.append(day))
    q._Lake(spark, SF0001).broken_live()
    assert dealt == [None]


def test_a_staged_copy_holds_only_flags_of_rows_out_of_scope(spark, monkeypatch):
    raw = conform_raw(text_frame(spark, [ride("a"), ride("b", fare="-5"), ride("c", pay="Cash"), ride("d", pay=None), ride("a", fare="30")]))
    staged = []
    delete = lk.delete_folder
    monkeypatch.setattr(clean.lake, "delete_folder", lambda s, p: (staged.extend(s.read.parquet(p).collect()), delete(s, p)))
    runs = {m: clean.run_clean(spark, raw, lk.scratch_dir(spark, f"test-stage-{m}"), "d", run_ts="20260101-000000", materialize=m)
            for m in ("rescan", "stage")}
    out = [r for r in staged if not r["_in_scope"]]
    assert len(staged) == 5 and len(out) == 2
    assert all(v is None for r in out for k, v in r.asDict().items() if k not in ("_in_scope", "_ok"))
    assert runs["rescan"]["counts"] == runs["stage"]["counts"]
    for read, folder in ((read_silver_run, "silver"), (read_rejects, "rejected")):
        a, b = (sorted(map(str, read(spark, runs[m][folder]).collect())) for m in runs)
        assert a == b and a


def test_runs_over_the_joined_tables_join_them_once(spark, monkeypatch):
    modes = []
    monkeypatch.setattr(q, "run_clean", lambda *a, materialize="rescan", **k: modes.append(materialize))
    lake = q._Lake(spark, SF0001)
    lake.silver_run(), lake.window_run()
    assert modes == ["stage", "stage"]


def test_rejects_of_a_staged_copy_are_not_dealt_again(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(clean, "write_rejects", lambda df, path: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()),
                                                                  df.write.json(path)))
    raw = conform_raw(text_frame(spark, [ride("a"), ride("b", fare="-5")])).withColumn("fare", F.col("fare") + 0)
    clean.run_clean(spark, raw, lk.scratch_dir(spark, "test-not-dealt"), "d", run_ts="20260101-000000", materialize="stage")
    assert len(plans) == 1 and "Rebalance" not in plans[0]
