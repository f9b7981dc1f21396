"""Sketches beside the runs and bucketed tables: results, and plans without a shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, ride, text_frame
from triplake import lake as lk, runs
from triplake.operators.dedupe import keep_first
from triplake.operators.join import first_requests, join_outcomes, pending_requests
from triplake.operators.route import conform_raw
from triplake.operators.sketch import sketch_rank_errors, sketched_cut_days, start_sketch
from triplake.operators.split import cut_days_frame
from triplake.plans.clean import run_clean, start_sketches
from triplake.sources.bucketed import add_run_keys, keys_in_several_runs, write_bucketed
from triplake.sources.fixture import trips_raw
from triplake.sources.silver import read_silver_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.fixture(scope="module")
def dataset(spark):
    lake = lk.scratch_dir(spark, "layout")
    raw = trips_raw(spark, SF0001)
    for k in range(3):  # overlapping parts of the trips
        run_clean(spark, raw.where(f"pickup_community_area % 4 <> {k}"), lake, "trips", run_ts=f"20260101-00000{k}")
    return lk.silver_root(lake, "trips")


def test_merged_sketches_give_the_cut_days_of_all_runs(spark, dataset):
    sketches = start_sketches(spark, dataset)
    assert sketches.count() == 3 == len(runs.committed_ids(spark, dataset))
    rows = read_silver_table(spark, dataset)
    r = sketch_rank_errors(rows, sketches).first()
    assert r.val_error <= 0.001 and r.test_error <= 0.001
    # the cuts of one run's few thousand rows are exact: nothing is left out of its sketch
    one = runs.committed_ids(spark, dataset)[0]
    same(sketched_cut_days(start_sketches(spark, dataset, one)), cut_days_frame(read_silver_table(spark, dataset, one)))


def test_rank_error_of_many_skewed_parts(spark):
    rng = random.Random(3)
    frame = spark.range(300_000).selectExpr("id", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, pow(id % 1009, 2)) AS trip_start_ts")
    parts = [frame.where(f"id % 12 = {k}").agg(start_sketch().alias("sketch")) for k in range(12)]
    sketches = parts[0]
    for p in parts[1:]:
        sketches = sketches.unionByName(p)
    for val, test in ((0.1, 0.1), (rng.random() / 2, 0.3)):
        r = sketch_rank_errors(frame, sketches, val, test).first()
        assert max(r) <= 0.001


def test_keys_in_several_runs_without_a_shuffle(spark, dataset):
    path = lk.scratch_dir(spark, "keys")
    assert add_run_keys(spark, "layout_keys", path, dataset, 4) == runs.committed_ids(spark, dataset)
    assert add_run_keys(spark, "layout_keys", path, dataset, 4) == []
    got = keys_in_several_runs(spark.table("layout_keys"))
    assert "Exchange" not in plan(got)
    want = (read_silver_table(spark, dataset).groupBy("unique_key").agg(
        F.count(F.lit(1)).alias("n_runs"), F.min("run_id").alias("first_run"), F.max("run_id").alias("last_run")).where("n_runs > 1"))
    same(got, want)
    assert got.where("n_runs = 3").count() > 0
    spark.sql("DROP TABLE layout_keys")


def test_joins_over_bucketed_tables_shuffle_nothing(spark):
    rng = random.Random(7)
    keys = [None, *(f"k{i}" for i in range(40))]
    requests = conform_raw(text_frame(spark, [ride(rng.choice(keys), fare=str(rng.randint(5, 9))) for _ in range(200)]))
    outcomes = spark.createDataFrame([(rng.choice(keys[:25]), float(rng.randint(0, 5))) for _ in range(90)], "unique_key string, tips double")
    req = write_bucketed(requests, "layout_requests", lk.scratch_dir(spark, "req"), 4)
    out = write_bucketed(outcomes, "layout_outcomes", lk.scratch_dir(spark, "out"), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for got, want in ((join_outcomes(req, out), join_outcomes(requests, outcomes)),
                          (pending_requests(req, out), pending_requests(requests, outcomes)),
                          (first_requests(req), first_requests(requests)),
                          (keep_first(req, ["unique_key"], method="window"), keep_first(requests, ["unique_key"], method="window"))):
            assert "Exchange" not in plan(got)
            same(got, want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE layout_requests"), spark.sql("DROP TABLE layout_outcomes")
