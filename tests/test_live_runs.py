"""Incremental live runs: the ledger carries what is open, each landing day is read once."""

import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest

from test_stream_state import day, land, request
from triplake import lake as lk, runs
from triplake.plans import live
from triplake.plans.live import increments, read_open_requests, run_live
from triplake.schemas import LIVE_DATASET, OUTCOMES_FOLDER, REQUESTS_FOLDER
from triplake.sources.landing import read_live, read_pending
from triplake.sources.silver import read_silver_table


def land_trips(root, days, last):
    """Trips of a day whose outcomes land 0 to 7 days later, or never; some keys come again, one request a day has none."""
    for i in days:
        land(root, REQUESTS_FOLDER, i, [request(f"k{i}-{j}", i) for j in range(10)] + [request(None, i)]
             + ([request(f"k{i - 3}-{j}", i, "99") for j in range(3, 9)] if i >= 3 else []))
        for late in range(8):
            if i + late < last:
                land(root, OUTCOMES_FOLDER, i + late, [{"unique_key": f"k{i}-{late}", "tips": str(late)}])


def rows(df):
    return sorted(((r.unique_key, r.fare, r.tips) for r in df.collect()), key=str)


def silver(spark, out):
    return read_silver_table(spark, lk.silver_root(out, LIVE_DATASET))


@pytest.fixture
def landing(spark):
    root = lk.scratch_dir(spark, "live-runs")
    land_trips(root, range(20), 22)
    return root


def test_union_of_runs_is_the_join_and_days_are_read_once(spark, landing):
    whole = read_live(spark, landing, day(0), day(20), grace_days=2)
    joined, open_ = rows(whole), sorted(str(r.unique_key) for r in read_pending(spark, landing, day(0), day(20), grace_days=2).collect())
    out = lk.scratch_dir(spark, "live-out")
    local = landing.removeprefix("file:")
    for k, (start, end) in enumerate([(0, 5), (5, 6), (6, 14), (14, 20)]):
        m = run_live(spark, landing, out, day(end), day(0), grace_days=2, compact_after=3)
        assert (m["start"], m["end"], m["extra"]["ledger"]) == (day(start), day(end), str(k + 1))
        # what a run has read may go
        for i in range(start, end):
            shutil.rmtree(f"{local}/landing/{REQUESTS_FOLDER}/event_date={day(i)}")
        for i in range(start + 2 if start else 0, end + 2):
            shutil.rmtree(f"{local}/landing/{OUTCOMES_FOLDER}/event_date={day(i)}", ignore_errors=True)
    table = silver(spark, out)
    assert rows(table) == joined and len(joined) > 100
    assert table.select("run_id").distinct().count() == 4
    assert sorted(str(r.unique_key) for r in read_open_requests(spark, out).collect()) == open_ and len(open_) > 40
    assert len(increments(spark, out)) == 4


def test_a_rerun_adds_nothing(spark, landing):
    out = lk.scratch_dir(spark, "live-rerun")
    first = run_live(spark, landing, out, day(8), day(0))
    before = rows(silver(spark, out))
    assert run_live(spark, landing, out, day(8), day(0)) == first and rows(silver(spark, out)) == before
    with pytest.raises(ValueError):
        run_live(spark, landing, out, day(5))
    run_live(spark, landing, out, day(9))
    assert run_live(spark, landing, out, day(8)) == first and len(increments(spark, out)) == 2


def test_a_killed_run_leaves_the_ledger_as_it_was(spark, landing, monkeypatch):
    out = lk.scratch_dir(spark, "live-killed")
    run_live(spark, landing, out, day(8), day(0))
    state = rows(silver(spark, out)), sorted(map(str, read_open_requests(spark, out).collect()))

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(runs.Run, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            run_live(spark, landing, out, day(12))
    assert (rows(silver(spark, out)), sorted(map(str, read_open_requests(spark, out).collect()))) == state
    run_live(spark, landing, out, day(12))
    whole = lk.scratch_dir(spark, "live-whole")
    run_live(spark, landing, whole, day(8), day(0))
    run_live(spark, landing, whole, day(12))
    assert rows(silver(spark, out)) == rows(silver(spark, whole))


def test_of_two_runs_after_the_same_one_goes_on(spark, landing):
    out = lk.scratch_dir(spark, "live-race")
    run_live(spark, landing, out, day(4), day(0))

    def go(end):
        try:
            return run_live(spark, landing, out, day(end))
        except FileExistsError:
            return None

    with ThreadPoolExecutor(2) as pool:
        done = [m for m in pool.map(go, (8, 9)) if m]
    versions = [m["extra"]["ledger"] for m in increments(spark, out)]
    assert len(set(versions)) == len(versions) and len(done) >= 1
    keys = [r.unique_key for r in silver(spark, out).collect()]
    assert len(keys) == len(set(keys))


def test_open_items_of_new_and_old(spark):
    """Settled keys stay settled; a pending request is the first of its key, an early outcome too."""
    requests = spark.createDataFrame([(k, f"2021-03-05 0{h}:00:00", f) for k, h, f in (
        ("settled", 1, 1.0), ("pending", 1, 2.0), ("new", 2, 3.0), ("new", 1, 4.0), ("early", 1, 5.0))],
        "unique_key string, trip_start_timestamp string, fare double")
    frame = lambda rows: spark.createDataFrame(rows, "unique_key string, trip_start_timestamp string, fare double").selectExpr(
        "*", *[f"cast(null as string) AS {c}" for c in live.REQUEST_COLUMNS if c not in ("unique_key", "trip_start_timestamp", "fare")])
    outcomes = spark.createDataFrame([("settled", 1.0), ("pending", 2.0), ("early", 1.0), ("orphan", 9.0)], live.EARLY_SCHEMA)
    items = live.open_items(frame(requests.collect()), outcomes, frame([("pending", "2021-03-06 01:00:00", 8.0)]),
                            spark.createDataFrame([("early", 7.0)], live.EARLY_SCHEMA),
                            spark.createDataFrame([("settled",), ("older",)], live.SETTLED_SCHEMA))
    got = sorted(((r.unique_key, r.fare, r.o_key, r.o_tips) for r in items.collect()), key=str)
    assert got == sorted([("pending", 8.0, "pending", 2.0), ("early", 5.0, "early", 7.0), ("new", 4.0, None, None),
                          (None, None, "orphan", 9.0)], key=str)
    assert "LeftSemi" in items._jdf.queryExecution().optimizedPlan().toString()
