"""Jobs end to end at sf0.001 in a scratch lake: counts, properties, immutability."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, ride, text_frame
from triplake import lake as lk
from triplake.operators.dedupe import keep_first
from triplake.operators.route import conform_raw, route_counts
from triplake.plans.clean import clean_frames, run_clean
from triplake.plans.export import run_export
from triplake.plans.gold import MANIFEST_NAME, run_gold
from triplake.schemas import HISTORICAL_DATASET, LIVE_DATASET, OUTCOMES_FOLDER, REQUESTS_FOLDER, SILVER_ORDER
from triplake.sources.fixture import keyless, trips_raw, trips_stored
from triplake.sources.historical import time_window
from triplake.sources.landing import read_live
from triplake.sources.silver import read_gold, read_rejects, read_silver_run


@pytest.fixture(scope="module")
def raw(spark):
    return trips_raw(spark, SF0001)


def test_golden_counts(spark, raw):
    c = route_counts(raw).first()
    assert (c.input_rows, c.rejected_rows, c.valid_rows) == (6000, 1085, 2845)
    assert c.filtered_rows + c.rejected_rows + c.valid_rows == c.input_rows
    silver, _ = clean_frames(raw)
    assert silver.count() == 2521


def test_silver_keys_unique_and_methods_agree(spark, raw):
    silver, _ = clean_frames(raw)
    assert silver.groupBy("unique_key").count().where("count > 1").count() == 0
    valid = clean_frames(raw, dedupe_method="min_struct")[0]
    alt = clean_frames(raw, dedupe_method="window")[0]
    assert valid.exceptAll(alt).count() == 0 and alt.exceptAll(valid).count() == 0


def test_keep_first_picks_first_in_order(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "x"), (None, 4, "y")],
                               "k string, x int, y string")
    for method in ("window", "min_struct"):
        got = sorted(((r.k or ""), r.x, r.y) for r in keep_first(df, ["k"], ["x"], method=method).collect())
        assert got == [("", 4, "y"), ("k", 1, "a")]


def test_clean_then_gold_jobs(spark, raw):
    out_lake = lk.scratch_dir(spark, "test-lake")
    run = run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000000")
    counts = run["counts"]
    assert counts["valid_rows"] == 2845 and counts["rejected_rows"] == 1085
    assert read_silver_run(spark, run["silver"]).count() == 2521
    rej = read_rejects(spark, run["rejected"])
    assert rej.count() == 1085 and rej.where(F.size("problems") == 0).count() == 0
    observed = run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000009", counts="observe")
    assert observed["counts"] == counts
    staged = run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000010", materialize="stage")
    assert staged["counts"] == counts
    assert read_silver_run(spark, staged["silver"]).exceptAll(read_silver_run(spark, run["silver"])).count() == 0
    # a second run with the same id refuses to overwrite
    with pytest.raises(Exception):
        run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000000")

    gold_root = f"{out_lake}/gold/tip_label"
    m = run_gold(spark, run["silver"], gold_root, "v1", git_commit="abc")
    assert m["split_rule"]["val_start"] == "2000-05-10" and m["split_rule"]["test_start"] == "2001-02-08"
    assert {k: v["rows"] for k, v in m["splits"].items()} == {"train": 2015, "val": 253, "test": 253}
    assert m["splits"]["train"]["label_rate"] == 0.3677
    gold = read_gold(spark, lk.gold_dir(gold_root, "v1"))
    t = gold.groupBy("split").agg(F.min("trip_start_ts").alias("lo"), F.max("trip_start_ts").alias("hi"))
    b = {r.split: (r.lo, r.hi) for r in t.collect()}
    assert b["train"][1] < b["val"][0] and b["val"][1] < b["test"][0]
    on_disk = json.loads(lk.read_text(spark, f"{lk.gold_dir(gold_root, 'v1')}/{MANIFEST_NAME}"))
    assert on_disk["feature_columns"] == m["feature_columns"]
    with pytest.raises(FileExistsError):
        run_gold(spark, run["silver"], gold_root, "v1")


def test_export_then_live_clean(spark, raw):
    out_lake = lk.scratch_dir(spark, "test-live")
    run_export(spark, trips_stored(raw), out_lake, "1998-01-01", "1998-02-01")
    live = read_live(spark, out_lake, "1998-01-01", "1998-02-01")
    assert live.count() > 0
    run = run_clean(spark, live, out_lake, LIVE_DATASET, "1998-01-01", "1998-02-01", materialize="stage")
    assert run["counts"]["input_rows"] == live.count()
    silver = read_silver_run(spark, run["silver"])
    assert silver.count() <= run["counts"]["valid_rows"]
    assert silver.select(F.count_distinct("unique_key")).first()[0] == silver.count()
    assert SILVER_ORDER[0] == "trip_start_ts"


def test_staged_copies_go_when_outputs_are_committed(spark, raw):
    from triplake.lake import checkpoint_root, hadoop_fs
    def copies():
        p, fs = hadoop_fs(spark, checkpoint_root(spark))
        names = [str(x.getPath().getName()) for x in fs.listStatus(p)]
        return [n for n in names if "clean-stage" in n or "holdout" in n]
    before = copies()
    out_lake = lk.scratch_dir(spark, "test-copies")
    run_export(spark, trips_stored(raw), out_lake, "1998-01-01", "1998-01-05")
    run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000011", materialize="stage")
    assert copies() == before


def test_command_line_jobs(spark, raw):
    from triplake.plans import checks as check_job, clean as clean_job, export as export_job, gold as gold_job
    base = lk.scratch_dir(spark, "test-cli")
    raw_path = f"{base}/raw"
    trips_stored(raw).write.parquet(raw_path)
    out = clean_job.main(["--source", "historical", "--raw", raw_path, "--start_date", "1996-01-01",
                          "--end_date", "2001-01-01", "--out_lake", base, "--run_ts", "20260101-000000"])
    assert out["run_id"] == "1996-01-01_2001-01-01_20260101-000000"
    m = gold_job.main(["--silver_path", out["silver"], "--gold_root", f"{base}/gold/t", "--version", "v1"])
    assert sum(v["rows"] for v in m["splits"].values()) == read_silver_run(spark, out["silver"]).count()
    check_job.main(["--dataset_root", f"{base}/silver/trips", "--target_run", out["run_id"]])
    from triplake.plans import profiling as profile_job
    profile_job.main(["--raw", raw_path, "--start_date", "1996-01-01", "--end_date", "2001-01-01"])
    row = check_job.run_all_checks(spark, f"{base}/silver/trips", out["run_id"]).first()
    assert row.n_rows == row.n_keys and row.null_fare == 0 and row.rows_outside_window == 0
    export_job.main(["--raw", raw_path, "--holdout_start", "1998-01-01", "--holdout_end", "1998-03-01",
                     "--out_lake", base])
    live = clean_job.main(["--source", "live", "--start_date", "1998-01-01", "--end_date", "1998-03-01",
                           "--out_lake", base, "--run_ts", "20260101-000001"])
    assert live["counts"]["input_rows"] > 0
    for bad in (["--start_date", "2001-01-01", "--end_date", "1996-01-01"],
                ["--start_date", "19960101", "--end_date", "2001-01-01"],
                ["--start_date", "1996-01-01", "--end_date", "2001-01-01", "--run_ts", "2026-01-01"]):
        with pytest.raises(SystemExit):
            clean_job.main(["--raw", raw_path, "--out_lake", base, *bad])


@pytest.mark.parametrize("files_per_batch", [None, 20])
def test_streams_equal_batch(spark, raw, files_per_batch):
    from triplake.operators.join import first_requests
    from triplake.sources.landing import read_requests
    from triplake.streaming.clean import run_stream_clean
    from triplake.streaming.dedupe import run_stream_firsts
    from triplake.streaming.join import run_stream_join
    window = ("1998-01-01", "1998-03-01")
    out_lake = lk.scratch_dir(spark, "test-stream")
    run_export(spark, trips_stored(keyless(raw)), out_lake, "1998-01-01", "1998-03-01")
    opts = {"partitions": 2, "files_per_batch": files_per_batch}
    same = lambda a, b: a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
    batch = read_live(spark, out_lake, *window)
    firsts = run_stream_firsts(spark, out_lake, lk.scratch_dir(spark, "test-stream-dd"), "requests", *window, **opts)
    assert same(firsts, first_requests(read_requests(spark, out_lake, *window)))
    joined = run_stream_join(spark, out_lake, lk.scratch_dir(spark, "test-stream-join"), *window, **opts)
    assert same(joined, batch)
    if files_per_batch:
        out = run_stream_clean(spark, out_lake, out_lake, *window, "20260101-000000", **opts)
        assert same(read_silver_run(spark, out["silver"]), clean_frames(batch)[0])
        rejects = read_rejects(spark, out["rejected"])
        assert rejects.count() > 0 and rejects.where(F.size("problems") == 0).count() == 0


def test_reject_lines_keep_null_fields(spark, raw):
    out_lake = lk.scratch_dir(spark, "test-rejects")
    run = run_clean(spark, raw, out_lake, HISTORICAL_DATASET, run_ts="20260101-000002")
    lines = spark.read.text(run["rejected"])
    sample = [json.loads(r.value) for r in lines.where(F.col("value").contains('"company":null')).limit(3).collect()]
    assert sample and all(set(s) == {"unique_key", "problems", "raw"} for s in sample)
    assert all(len(s["raw"]) == 13 and s["raw"]["company"] is None for s in sample)


def test_joined_plus_pending_equals_distinct_requests(spark, raw):
    from triplake.sources.landing import read_pending, read_requests
    from triplake.sources.sinks import outcome_records, request_records, write_landing
    out_lake = lk.scratch_dir(spark, "test-live-split")
    trips = time_window(trips_stored(raw), "1997-01-01", "1997-04-01")
    write_landing(request_records(trips), lk.landing_root(out_lake, REQUESTS_FOLDER))
    write_landing(outcome_records(trips.where("trip_seconds % 3 = 0")), lk.landing_root(out_lake, OUTCOMES_FOLDER))
    joined = read_live(spark, out_lake, "1997-01-01", "1997-04-01").count()
    pending = read_pending(spark, out_lake, "1997-01-01", "1997-04-01").count()
    keys = read_requests(spark, out_lake, "1997-01-01", "1997-04-01").select("unique_key").distinct().count()
    assert pending > 0 and joined > 0 and joined + pending == keys


def test_a_second_export_replaces_its_days_only(spark, raw):
    from triplake.sources.landing import read_requests
    root = lk.scratch_dir(spark, "test-exp")
    run_export(spark, trips_stored(raw), root, "1998-01-01", "1998-01-15")
    whole = read_requests(spark, root, "1998-01-01", "1998-01-15").count()
    run_export(spark, trips_stored(raw), root, "1998-01-05", "1998-01-08", stage=False)
    assert read_requests(spark, root, "1998-01-01", "1998-01-15").count() == whole > 0


def test_concurrent_profiles_equal_sequential(spark, raw):
    from triplake.plans.profiling import collect_profiles, run_profile
    together = collect_profiles(raw, "1996-01-01", "2001-01-01")
    one_by_one = {k: df.collect() for k, df in run_profile(raw, "1996-01-01", "2001-01-01").items()}
    assert together == one_by_one
    assert together["dirtiness"][0].total > 0


def test_a_landing_is_one_pass_over_its_source(spark):
    from pyspark.sql import types as T
    passes = spark.sparkContext.accumulator(0)

    def seen(company):
        passes.add(1)
        return company

    raw = spark.createDataFrame(
        [(f"r{i}", dt.datetime(1998, 1, 1 + i % 3, 9, i), dt.datetime(1998, 1, 1 + i % 3, 10), float(i), float(i) + 5, "c") for i in range(12)],
        "unique_key string, trip_start_timestamp timestamp_ntz, trip_end_timestamp timestamp_ntz, tips double, trip_total double, company string")
    counted = raw.withColumn("company", F.udf(seen, T.StringType()).asNondeterministic()("company"))
    root = lk.scratch_dir(spark, "test-one-pass")
    out = run_export(spark, counted, root, "1998-01-01", "1998-02-01", stage=False)
    assert passes.value == 12
    keys = {f"r{i}" for i in range(12)}
    for folder in ("requests", "outcomes"):
        assert {r.unique_key for r in spark.read.json(out[folder]).collect()} == keys
        days = [n for n in lk.list_names(spark, out[folder]) if n.startswith("event_date=")]
        assert sorted(days) == [f"event_date=1998-01-0{d}" for d in (1, 2, 3)]
        assert all(n.endswith(".gz") for d in days for n in lk.list_names(spark, f"{out[folder]}/{d}") if n.startswith("part-"))
    assert sorted(lk.list_names(spark, f"{root}/landing")) == sorted(out[f].rsplit("/", 1)[1] for f in out)  # nothing else stays


def test_a_landing_without_trips_has_its_folders(spark):
    raw = spark.createDataFrame([], "unique_key string, trip_start_timestamp timestamp_ntz, trip_end_timestamp timestamp_ntz, "
                                    "tips double, trip_total double")
    out = run_export(spark, raw, lk.scratch_dir(spark, "test-no-trips"), "1998-01-01", "1998-02-01", stage=False)
    assert all(lk.path_exists(spark, out[f]) for f in out)


def test_rejects_are_compressed(spark):
    raw = conform_raw(text_frame(spark, [ride(f"r{i}", fare="-5") for i in range(40)]))
    run = run_clean(spark, raw, lk.scratch_dir(spark, "test-rejects-gz"), "d", run_ts="20260101-000000")
    names = [n for n in lk.list_names(spark, run["rejected"]) if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert spark.read.json(run["rejected"]).count() == 40
