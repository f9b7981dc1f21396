"""How the two sides of a streaming join advance."""

import threading

from conftest import ride, text_frame
from test_stream_state import OPTIONS, expected, land, land_days, outcome_rows
from triplake import lake as lk
from triplake.operators.route import conform_raw
from triplake.schemas import OUTCOMES_FOLDER
from triplake.streaming import join as stream_join
from triplake.streaming.state import run_outer_join


def test_both_sides_of_the_outer_join_advance_by_the_same_days(spark):
    root = lk.scratch_dir(spark, "two-files")
    land_days(root, range(24))
    even = run_outer_join(spark, root, lk.scratch_dir(spark, "even"), **OPTIONS)
    for i in range(24):  # the days' outcomes in a second file too, as late ones are
        land(root, OUTCOMES_FOLDER, i, [{"unique_key": f"k{i}-0", "tips": "2"}])
    out = lk.scratch_dir(spark, "two-files-out")
    run = run_outer_join(spark, root, out, **OPTIONS)
    assert run.batches == even.batches and run.late_rows == 0
    assert max(run.state_rows) <= max(even.state_rows) + 7
    assert outcome_rows(spark, out, 18) == expected(range(18))


def test_the_two_streams_of_a_join_run_side_by_side(spark, monkeypatch):
    both, sides = threading.Barrier(2, timeout=20), {}
    one = spark.createDataFrame([("a", 1.0)], "unique_key string, tips double")

    def firsts(s, lake, out, side, start, end, *rest):
        both.wait()  # broken if one waits for the other
        sides[side] = (out.rsplit("/", 1)[1], str(start), str(end))
        return conform_raw(text_frame(spark, [ride("a")])) if side == "requests" else one
    monkeypatch.setattr(stream_join, "run_stream_firsts", firsts)
    joined = stream_join.run_stream_join(spark, "lake", "out", "2022-01-01", "2022-02-01", grace_days=1)
    assert [(r.unique_key, r.tips) for r in joined.collect()] == [("a", 1.0)]
    assert sides == {"requests": ("requests", "2022-01-01", "2022-02-01"), "outcomes": ("outcomes", "2022-01-01", "2022-02-02")}
