"""Golden counts from FIXTURES.md at all three scale factors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from triplake.operators.gold import split_summary, to_gold
from triplake.operators.profiles import dirtiness
from triplake.operators.route import route_counts
from triplake.operators.split import assign_split, cut_dates
from triplake.plans.clean import clean_frames
from triplake.sources.fixture import trips_raw

GOLDEN = {
    # raw, card, valid, rejected, silver, duplicates, val_from, test_from, (rows, label rate) per split
    "sf0.001": (6000, 3930, 2845, 1085, 2521, 1401, "2000-05-10", "2001-02-08",
                {"train": (2015, 0.3677), "val": (253, 0.3913), "test": (253, 0.3636)}),
    "sf0.01": (60000, 40074, 25474, 14600, 22640, 14168, "2000-05-01", "2001-01-28",
               {"train": (18110, 0.3671), "val": (2264, 0.3874), "test": (2266, 0.3544)}),
    "sf0.1": (600000, 399875, 255790, 144085, 227115, 143139, "2000-05-02", "2001-01-27",
              {"train": (181646, 0.3716), "val": (22753, 0.3680), "test": (22716, 0.3741)}),
}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_golden_counts(spark, sf):
    raw_n, card, valid, rejected, silver_n, dups, v_from, t_from, splits = GOLDEN[sf]
    raw = trips_raw(spark, f"/root/testdata/{sf}")
    c = route_counts(raw).first()
    assert (c.input_rows, c.input_rows - c.filtered_rows, c.valid_rows, c.rejected_rows) == (raw_n, card, valid, rejected)
    assert dirtiness(raw).first().duplicates == dups
    silver = clean_frames(raw)[0]
    assert silver.count() == silver_n
    v, t = cut_dates(silver)
    assert (v, t) == (dt.date.fromisoformat(v_from), dt.date.fromisoformat(t_from))
    got = {r.split: (r.rows, r.label_rate) for r in split_summary(to_gold(assign_split(silver, v, t))).collect()}
    assert got == splits
