"""Lines of a landing that are no records: fail, or rejects of their own; no line is lost."""

import json
import os

import pytest

from test_stream_state import day, request
from triplake import lake as lk, runs
from triplake.plans.clean import run_clean
from triplake.schemas import OUTCOMES_FOLDER, REQUESTS_FOLDER, REQUEST_SCHEMA
from triplake.sources.landing import BAD_LINE, good_lines, read_landing, read_live, read_live_and_bad_lines
from triplake.sources.silver import read_rejects, read_silver_run

BAD = ['{"unique_key": "k0"', "no json", '"text"', "[1, 2]", '{"unique_key": "k1",}}', "\u0000", "{]"]


def write(root, folder, i, lines):
    path = f"{lk.landing_root(root, folder).removeprefix('file:')}/event_date={day(i)}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-{len(os.listdir(path))}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def landing(spark):
    root = lk.scratch_dir(spark, "bad-lines")
    for i in range(3):
        records = [json.dumps(request(f"k{i}-{j}", i)) for j in range(4)]
        write(root, REQUESTS_FOLDER, i, records[:2] + BAD + records[2:] + ["{}", json.dumps({**request(None, i), "more": [1]})])
        write(root, OUTCOMES_FOLDER, i, [json.dumps({"unique_key": f"k{i}-{j}", "tips": "1"}) for j in range(3)] + BAD[:2])
    return root


def test_every_line_is_a_record_or_bad(spark, landing):
    rows = read_landing(spark, landing, REQUESTS_FOLDER, day(0), day(2), REQUEST_SCHEMA, "keep")
    bad = [r[BAD_LINE] for r in rows.collect() if r[BAD_LINE] is not None]
    assert sorted(bad) == sorted(BAD * 2)
    assert good_lines(rows).count() == 2 * 6 and BAD_LINE not in good_lines(rows).columns
    assert read_landing(spark, landing, REQUESTS_FOLDER, "2031-01-01", "2031-01-02", REQUEST_SCHEMA, "keep").count() == 0


def test_a_bad_line_fails_by_default(spark, landing):
    with pytest.raises(Exception, match="MALFORMED"):
        read_live(spark, landing, day(0), day(3)).count()
    with pytest.raises(ValueError):
        read_landing(spark, landing, REQUESTS_FOLDER, day(0), day(2), REQUEST_SCHEMA, "drop")


def test_bad_lines_are_rejects_of_the_run(spark, landing):
    joined, bad = read_live_and_bad_lines(spark, landing, day(0), day(3), grace_days=0)
    lake = lk.scratch_dir(spark, "bad-run")
    run = run_clean(spark, joined, lake, "live_trips", day(0), day(3), "20260101-000000", materialize="stage", more_rejects=bad)
    assert sorted(r.unique_key for r in read_silver_run(spark, run["silver"]).collect()) == [f"k{i}-{j}" for i in range(3) for j in range(3)]
    rejects = [(r.problems, r.raw["folder"], r.raw["event_date"], r.raw["line"]) for r in read_rejects(spark, run["rejected"]).collect()]
    assert sorted(rejects) == sorted([([BAD_LINE], REQUESTS_FOLDER, day(i), x) for i in range(3) for x in BAD]
                                     + [([BAD_LINE], OUTCOMES_FOLDER, day(i), x) for i in range(3) for x in BAD[:2]])
    counts = runs.manifest(spark, lk.silver_root(lake, "live_trips"), run["run_id"])["counts"]
    assert counts["more_rejects"] == 27 and counts["rejected_rows"] == 0 and counts["silver_rows"] == 9
