"""Property tests: parsing vs Python, deterministic reruns, cut days vs brute force."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from conftest import SF0001
from triplake.functions.scalars import to_bigint, to_double
from triplake.operators.split import cut_dates, cut_days_frame
from triplake.plans.clean import clean_frames
from triplake.sources.fixture import trips_raw

number_text = st.one_of(
    st.floats(allow_nan=False, allow_infinity=False).map(repr),
    st.integers(min_value=-10**12, max_value=10**12).map(str),
    st.tuples(st.sampled_from(["", " ", "\t"]), st.integers(-999, 999), st.sampled_from(["", ".", ".5", "e2", "E-1"]),
              st.sampled_from(["", " ", "\n"])).map(lambda t: f"{t[0]}{t[1]}{t[2]}{t[3]}"),
    st.text(alphabet="0123456789.eE+- _xabnif", max_size=8),
    st.sampled_from(["inf", "-Infinity", " +INF ", "nan", "1e400", "-1e-400", "infinit"]),
)


def python_double(s):
    """What Python's float() gives, with NaN and digit-group underscores treated as invalid."""
    if s is None or "_" in s:
        return None
    try:
        v = float(s)
    except ValueError:
        return None
    return None if math.isnan(v) else v


@settings(max_examples=3, deadline=None)
@given(st.lists(number_text, min_size=50, max_size=200))
def test_to_double_matches_python_float(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.d for r in df.select(to_double(F.col("v"), T.StringType()).alias("d")).collect()]
    want = [python_double(t) for t in texts]
    for t, g, w in zip(texts, got, want):
        assert g == w, (t, g, w)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(min_value=-1e15, max_value=1e15, allow_nan=False), min_size=20, max_size=100))
def test_to_bigint_truncates_toward_zero(spark, values):
    df = spark.createDataFrame([(repr(v),) for v in values], "v string")
    got = [r.i for r in df.select(to_bigint(F.col("v"), T.StringType()).alias("i")).collect()]
    assert got == [int(v) for v in values]


def test_clean_is_deterministic_across_runs(spark):
    raw = trips_raw(spark, SF0001)
    a = clean_frames(raw)[0]
    b = clean_frames(raw.repartition(7))[0]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_exact_cut_days_equal_brute_force(spark):
    silver = clean_frames(trips_raw(spark, SF0001))[0]
    days = sorted(r.d for r in silver.select(F.to_date("trip_start_ts").alias("d")).collect())
    n = len(days)

    def disc(p):  # smallest value whose cumulative share reaches p
        return days[max(0, math.ceil(p * n) - 1)]

    v, t = cut_dates(silver)
    assert (v, t) == (disc(0.8), disc(0.9))
    a_v, a_t = cut_dates(silver, method="approx")
    assert a_v <= a_t
    # the sketch's rank error is bounded: at most 0.1% of rows (plus one day's rows) off
    for cut, p in ((a_v, 0.8), (a_t, 0.9)):
        below = sum(1 for d in days if d < cut)
        at_or_below = sum(1 for d in days if d <= cut)
        assert below - 0.001 * n - 1 <= p * n <= at_or_below + 0.001 * n + 1


def test_cut_days_reject_a_window_that_leaves_train_empty(spark):
    one_day = spark.createDataFrame([(dt.datetime(2022, 1, 1, h),) for h in range(24)], "trip_start_ts timestamp_ntz")
    with pytest.raises(ValueError):
        cut_dates(one_day)
    v, t = cut_dates(one_day, strict=False)
    assert v == t == dt.date(2022, 1, 1)
    with pytest.raises(ValueError):
        cut_days_frame(one_day, val_frac=-0.1, test_frac=0.3)
    empty = one_day.where("false")
    with pytest.raises(ValueError):
        cut_dates(empty)


@st.composite
def ts_text(draw):
    value = draw(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1)))
    sep = draw(st.sampled_from([" ", "T"]))
    frac = draw(st.booleans())
    text = value.strftime(f"%Y-%m-%d{sep}%H:%M:%S") + (f".{value.microsecond:06d}" if frac else "")
    if not frac:
        value = value.replace(microsecond=0)
    zone = draw(st.sampled_from(["", " UTC", "Z", "offset"]))
    if zone == "offset":
        minutes = draw(st.integers(-14 * 60, 14 * 60))
        sign = "-" if minutes < 0 else "+"
        text += f"{sign}{abs(minutes) // 60:02d}:{abs(minutes) % 60:02d}"
        value = value - dt.timedelta(minutes=minutes)
    else:
        text += zone
    return text, value


@settings(max_examples=3, deadline=None)
@given(st.lists(ts_text(), min_size=50, max_size=200))
def test_timestamp_text_round_trips_to_utc(spark, cases):
    from triplake.functions.scalars import to_naive_ts
    df = spark.createDataFrame([(t,) for t, _ in cases], "v string")
    got = [r.t for r in df.select(to_naive_ts(F.col("v"), T.StringType()).alias("t")).collect()]
    for (text, want), g in zip(cases, got):
        assert g == want, (text, g, want)
