"""Streams on Spark's state store: results, bounded state, restart, late rows."""

import datetime as dt
import json
import os

import pytest

from conftest import ride
from triplake import lake as lk
from triplake.schemas import OUTCOMES_FOLDER, REQUESTS_FOLDER
from triplake.streaming.state import MATCHED, PENDING, read_settled, run_keep_first, run_outer_join, settled

FIRST = dt.date(2021, 3, 1)
OPTIONS = {"partitions": 2, "files_per_batch": 4}


def day(i):
    return (FIRST + dt.timedelta(days=i)).isoformat()


def land(root, folder, i, records, late=False):
    """One file of one day; files arrive in the order of their days, late ones after all."""
    path = f"{lk.landing_root(root, folder).removeprefix('file:')}/event_date={day(i)}"
    os.makedirs(path, exist_ok=True)
    name = f"{path}/part-{len(os.listdir(path))}.json"
    with open(name, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    seconds = 1_700_000_000 + (10_000 if late else i)
    os.utime(name, (seconds, seconds))


def request(key, i, fare="10"):
    return {k: v for k, v in ride(key, f"{day(i)} 10:00:00 UTC", fare=fare).items() if k != "tips"}


def land_days(root, days):
    """Each day: five trips (one key twice), two requests without a key that are equal; outcomes at once, late or never."""
    for i in days:
        keys = [f"k{i}-{j}" for j in range(5)]
        land(root, REQUESTS_FOLDER, i, [request(k, i) for k in keys] + [request(keys[0], i, "9")] + [request(None, i)] * 2)
        outcomes = [{"unique_key": keys[0], "tips": "2"}, {"unique_key": keys[0], "tips": "1"}, {"unique_key": keys[1], "tips": "3"},
                    {"unique_key": None, "tips": "8"}]
        if i > 0:
            outcomes += [{"unique_key": f"k{i - 1}-2", "tips": "4"}, {"unique_key": f"k{i - 1}-1", "tips": "0"}]  # a day late; again
        if i > 1:
            outcomes += [{"unique_key": f"k{i - 2}-3", "tips": "5"}]  # after the grace
        land(root, OUTCOMES_FOLDER, i, outcomes)


def expected(days):
    """(day, key, fare, tips, outcome day, status) of every request."""
    rows = []
    for i in days:
        rows += [(day(i), f"k{i}-0", 9.0, 1.0, day(i), MATCHED), (day(i), f"k{i}-1", 10.0, 3.0, day(i), MATCHED),
                 (day(i), f"k{i}-2", 10.0, 4.0, day(i + 1), MATCHED), (day(i), f"k{i}-3", 10.0, None, None, PENDING),
                 (day(i), f"k{i}-4", 10.0, None, None, PENDING)] + [(day(i), None, 10.0, None, None, PENDING)] * 2
    return sorted(rows, key=str)


def outcome_rows(spark, out, last):
    rows = settled(read_settled(spark, out)).where(f"event_date < '{day(last)}'").collect()
    text = lambda v: None if v is None else str(v)
    return sorted(((str(r.event_date), r.unique_key, r.fare, r.tips, text(r.outcome_date), r.status) for r in rows), key=str)


@pytest.fixture(scope="module")
def month(spark):
    root = lk.scratch_dir(spark, "stream-month")
    land_days(root, range(24))
    return root


def test_outer_join_restarts_where_it_stopped(spark, month):
    whole = lk.scratch_dir(spark, "outer-whole")
    run = run_outer_join(spark, month, whole, **OPTIONS)
    assert run.batches >= 3 and run.late_rows == 0
    want = expected(range(18))
    assert outcome_rows(spark, whole, 18) == want
    # matched and pending together are the distinct requests
    assert len(want) == 18 * 7 and sum(r[-1] == PENDING for r in want) == 18 * 4

    root, out = lk.scratch_dir(spark, "stream-parts"), lk.scratch_dir(spark, "outer-parts")
    for days in (range(0, 9), range(9, 10), range(10, 24)):
        land_days(root, days)
        assert run_outer_join(spark, root, out, **OPTIONS).late_rows == 0
    assert run_outer_join(spark, root, out, **OPTIONS).batches == 0  # nothing new
    assert outcome_rows(spark, out, 18) == want


def test_state_does_not_grow_with_the_stream(spark, month):
    short, long = lk.scratch_dir(spark, "short"), lk.scratch_dir(spark, "long")
    land_days(short, range(12))
    most = []
    for root in (short, month):
        for run in (run_keep_first, run_outer_join):
            done = run(spark, root, lk.scratch_dir(spark, "state"), **OPTIONS)
            most.append((max(done.state_rows), done.batches))
    (a, n), (b, m), (c, k), (d, j) = most
    assert k == 2 * n and j == 2 * m  # twice the batches
    assert 0 < c <= a and 0 < d <= b + 7  # a day's requests more or less


def test_keep_first_per_day_and_late_rows(spark):
    root, out = lk.scratch_dir(spark, "stream-late"), lk.scratch_dir(spark, "late")
    land_days(root, range(8))
    assert run_keep_first(spark, root, out, **OPTIONS).late_rows == 0
    rows = lambda: sorted((str(r.event_date), str(r.unique_key), r.fare) for r in
                          read_settled(spark, out).where(f"event_date < '{day(6)}'").collect())
    want = sorted((day(i), k, 9.0 if k.endswith("-0") else 10.0) for i in range(6) for k in [*(f"k{i}-{j}" for j in range(5)), "None"])
    assert rows() == want
    land(root, REQUESTS_FOLDER, 2, [request("k2-0", 2, "1"), request("new", 2), request("new", 2)], late=True)
    run = run_keep_first(spark, root, out, **OPTIONS)
    assert run.late_rows == 2 and run.batches == 1  # rows of one key are reduced before they are found late
    assert rows() == want


def test_observed_counts_agree_with_what_is_written(spark, month):
    from triplake.operators.route import route_counts
    from triplake.streaming.route import routed, run_stream_route
    joined, out = lk.scratch_dir(spark, "route-joined"), lk.scratch_dir(spark, "route")
    run_outer_join(spark, month, joined, **OPTIONS)
    batches = run_stream_route(spark, joined, out, partitions=2, files_per_batch=3)
    first = {r.batch: r for r in batches.collect()}
    assert len(first) >= 3 and all(r.agrees for r in first.values())
    matched = read_settled(spark, joined).where(f"status = '{MATCHED}'")
    want = route_counts(matched).first().asDict()
    assert {c: sum(r[c] for r in first.values()) for c in want} == want and want["valid_rows"] > 0
    # the last micro-batch is replayed, as after a crash before its commit
    last = max(first)
    local = out.removeprefix("file:")
    for name in (f"{local}/_checkpoint/commits/{last}", f"{local}/_checkpoint/commits/.{last}.crc"):
        if os.path.exists(name):
            os.unlink(name)
    again = {r.batch: r for r in run_stream_route(spark, joined, out, partitions=2, files_per_batch=3).collect()}
    assert again == first and routed(spark, out).count() == want["input_rows"]


def test_old_versions_of_the_state_go(spark, month):
    out = lk.scratch_dir(spark, "retained")
    run = run_outer_join(spark, month, out, **{**OPTIONS, "files_per_batch": 2})
    kept = [n for n in os.listdir(f"{out.removeprefix('file:')}/_checkpoint/commits") if n.isdigit()]
    assert run.batches >= 10 and len(kept) <= 4
