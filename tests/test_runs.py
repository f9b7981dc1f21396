"""Runs become visible by one commit: claims, killed and failing writers, races, the catalog table."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest

from conftest import SF0001
from triplake import lake as lk, runs
from triplake.plans import clean as clean_job
from triplake.plans.clean import run_clean
from triplake.sources.catalog_table import catalog_runs, create_runs_table, register_runs, silver_of_runs
from triplake.sources.fixture import trips_raw
from triplake.sources.silver import list_runs, read_silver_run, read_silver_table
from triplake.sources.sinks import write_silver

DATASET = "trips"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(trips_raw(spark, SF0001).limit(400).collect(), trips_raw(spark, SF0001).schema)


def names(spark, folder):
    return [n for n in lk.list_names(spark, folder) if not n.startswith((".", "_"))]


def test_one_of_many_creates_a_file_and_it_is_whole(spark):
    path = f"{lk.scratch_dir(spark, 'once')}/marker.json"

    def create(i):
        try:
            lk.create_once(spark, path, f"writer {i} " * 500)
        except FileExistsError:
            return None
        return f"writer {i} " * 500

    with ThreadPoolExecutor(16) as pool:
        won = [x for x in pool.map(create, range(32)) if x]
    assert len(won) == 1 and lk.read_text(spark, path) == won[0]
    assert lk.list_names(spark, path.rsplit("/", 1)[0]) == ["marker.json"]  # no draft stays


def test_two_writers_of_one_run_id(spark, raw):
    lake = lk.scratch_dir(spark, "two-writers")

    def write(_):
        try:
            return run_clean(spark, raw, lake, DATASET, "2000-01-01", "2001-01-01", "20260101-000000")
        except FileExistsError:
            return None

    with ThreadPoolExecutor(3) as pool:
        done = [r for r in pool.map(write, range(3)) if r]
    assert len(done) == 1
    root = lk.silver_root(lake, DATASET)
    assert runs.committed_ids(spark, root) == [done[0]["run_id"]]
    m = runs.manifest(spark, root, done[0]["run_id"])
    silver = read_silver_run(spark, done[0]["silver"])
    assert m["counts"]["silver_rows"] == silver.count() > 0 and m["counts"]["input_rows"] == 400
    assert m["folders"] == {"silver": done[0]["silver"], "rejected": done[0]["rejected"]}


def test_killed_reject_write_leaves_no_visible_run(spark, raw):
    lake = lk.scratch_dir(spark, "killed")
    root = lk.silver_root(lake, DATASET)
    first = run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000")
    killed = lk.make_run_id(None, None, "20260102-000000")
    folders = {"silver": lk.silver_dir(lake, DATASET, killed), "rejected": lk.rejects_dir(lake, DATASET, killed)}
    left = runs.writing(spark, root, killed, folders)
    left.__enter__()  # and never left, as in a process that dies
    write_silver(read_silver_run(spark, first["silver"]), folders["silver"])

    seen = [r.run_id for r in list_runs(spark, root).collect()]
    assert seen == [first["run_id"]]
    assert {r.run_id for r in read_silver_table(spark, root).select("run_id").distinct().collect()} == set(seen)
    for read in (lambda: read_silver_run(spark, folders["silver"]), lambda: read_silver_table(spark, root, killed)):
        with pytest.raises(runs.UncommittedRun):
            read()
    with pytest.raises(FileExistsError):  # its id is taken until it is cleaned up
        run_clean(spark, raw, lake, DATASET, run_ts="20260102-000000")
    assert runs.clean_abandoned(spark, root) == []  # it may still be at work
    assert runs.clean_abandoned(spark, root, dt.timedelta(0)) == [killed]
    assert names(spark, root) == [f"run_id={first['run_id']}"]
    again = run_clean(spark, raw, lake, DATASET, run_ts="20260102-000000")
    assert again["run_id"] == killed and runs.clean_abandoned(spark, root, dt.timedelta(0)) == []
    assert len(runs.committed_ids(spark, root)) == 2 and read_silver_run(spark, again["silver"]).count() > 0


def test_failing_writer_takes_back_what_it_wrote(spark, raw, monkeypatch):
    lake = lk.scratch_dir(spark, "failing")
    root = lk.silver_root(lake, DATASET)

    def broken(rejects, path):
        rejects.select("unique_key").limit(1).write.parquet(path)
        raise OSError("disk gone")

    monkeypatch.setattr(clean_job, "write_rejects", broken)
    with pytest.raises(OSError):
        run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000")
    assert names(spark, root) == [] and runs.committed_ids(spark, root) == []
    assert not lk.path_exists(spark, lk.rejects_dir(lake, DATASET, "open_open_20260101-000000"))
    assert list_runs(spark, root).count() == 0 and read_silver_table(spark, root).count() == 0
    monkeypatch.undo()
    assert run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000")["counts"]["input_rows"] == 400


def test_writer_whose_claim_was_cleaned_up_cannot_commit(spark, raw):
    lake = lk.scratch_dir(spark, "late")
    root = lk.silver_root(lake, DATASET)
    with pytest.raises(runs.UncommittedRun):
        run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000",
                  before_commit=lambda: runs.clean_abandoned(spark, root, dt.timedelta(0)) and {})
    assert runs.committed_ids(spark, root) == []


def test_folder_of_another_is_never_removed(spark, raw):
    lake = lk.scratch_dir(spark, "others")
    folder = lk.silver_dir(lake, DATASET, "open_open_20260101-000000")
    raw.select("unique_key").write.parquet(folder)
    with pytest.raises(FileExistsError):
        run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000")
    assert spark.read.parquet(folder).count() == 400


def test_catalog_table_lists_and_prunes_runs(spark, raw):
    lake, table = lk.scratch_dir(spark, "catalog's"), "silver_runs_test"
    root = lk.silver_root(lake, DATASET)
    a = run_clean(spark, raw, lake, DATASET, run_ts="20260101-000000")
    create_runs_table(spark, table, root)
    b = run_clean(spark, raw, lake, DATASET, "1996-01-01", "2001-01-01", "20260101-000001", table=table)
    c = run_clean(spark, raw, lake, DATASET, "1996-01-01", "2001-01-01", "20260101-000002")
    listed = catalog_runs(spark, table)
    assert {r.run_id for r in listed.collect()} == {a["run_id"], b["run_id"]}
    assert register_runs(spark, table, root) == [c["run_id"]] and register_runs(spark, table, root) == []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan(catalog_runs(spark, table))
    one = silver_of_runs(spark, table, b["run_id"])
    assert "(1 paths)" in plan(one) and "(3 paths)" not in plan(one)
    assert one.select(*read_silver_run(spark, b["silver"]).columns).exceptAll(read_silver_run(spark, b["silver"])).count() == 0
    assert silver_of_runs(spark, table).count() == sum(read_silver_run(spark, r["silver"]).count() for r in (a, b, c))
    spark.sql(f"DROP TABLE {table}")
