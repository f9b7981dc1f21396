"""What an incremental run moves."""

import datetime as dt

from conftest import ride, text_frame
from test_bytes_moved import moved, static_plans  # noqa: F401
from triplake import lake as lk
from triplake.operators.route import conform_raw
from triplake.plans import clean, live
from triplake.sources.silver import read_rejects, read_silver_run


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def items(spark, settled):
    t = dt.datetime(2022, 4, 1)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    row = lambda k, fare: tuple({"unique_key": k, "trip_start_timestamp": t, "fare": fare}.get(c) for c in live.PENDING_SCHEMA.fieldNames())
    return live.open_items(frame([row("a", 2.0), row("a", 1.0), row("p", 1.0), row("s", 1.0), row("e", 1.0)], live.PENDING_SCHEMA),
                           frame([("a", 2.0), ("a", 1.0), ("s", 1.0), ("e", 0.5), ("o", 3.0)], live.EARLY_SCHEMA),
                           frame([row("p", 9.0)], live.PENDING_SCHEMA), frame([("e", 5.0)], live.EARLY_SCHEMA),
                           None if settled is None else frame([(k,) for k in settled], live.SETTLED_SCHEMA))


def test_open_items_reduce_old_and_new_at_once(spark, static_plans):  # noqa: F811
    got = sorted(map(str, ((r.unique_key, r.fare, r.o_key, r.o_tips) for r in items(spark, ["s", "old"]).collect())))
    assert got == sorted(map(str, [("a", 1.0, "a", 1.0), ("p", 9.0, None, None), ("e", 1.0, "e", 5.0), (None, None, "o", 3.0)]))
    first = items(spark, None)
    assert len(moved(first)) == 2  # one exchange a side, and no look at keys where nothing is settled
    assert ("s", "s") in {(r.unique_key, r.o_key) for r in first.collect()}
    assert sum("min" in c for c in moved(items(spark, ["s"]))) == 2  # the first request and the first outcome, once each


def test_rejects_of_a_source_that_is_staged_are_not_dealt(spark, monkeypatch):
    raw = conform_raw(text_frame(spark, [ride("a"), ride("b", fare="-5"), ride("c", pay="Cash"), ride("a", fare="30")]))
    runs = {m: clean.run_clean(spark, raw, lk.scratch_dir(spark, f"test-{m}"), "d", run_ts="20260101-000000", materialize=m)
            for m in ("rescan", "staged")}
    assert runs["rescan"]["counts"] == runs["staged"]["counts"]
    for read, folder in ((read_silver_run, "silver"), (read_rejects, "rejected")):
        a, b = (sorted(map(str, read(spark, runs[m][folder]).collect())) for m in runs)
        assert a == b and a
    plans = []
    monkeypatch.setattr(clean, "write_rejects", lambda df, path: (plans.append(plan(df)), df.write.json(path)))
    clean.run_clean(spark, raw, lk.scratch_dir(spark, "test-staged"), "d", run_ts="20260101-000000", materialize="staged")
    assert len(plans) == 1 and "Rebalance" not in plans[0]
