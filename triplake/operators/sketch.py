"""Cut days from mergeable sketches: one KLL sketch of the start times a run, merged over any set of runs.

A sketch of ``SKETCH_K`` items is some 100 KB whatever the run's size; a rank
read from it (or from many merged) is off by less than 0.001 of all rows.  So
the cut days of a union of runs need no row of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from triplake.functions.scalars import ntz_seconds
from triplake.operators.split import check_fractions
from triplake.schemas import QUANTILE_RELATIVE_ERROR, TEST_FRAC, VAL_FRAC

#: Items kept a level: a normalized rank error of about 0.0007.
SKETCH_K = 8000


def start_sketch(ts: str = "trip_start_ts", k: int = SKETCH_K) -> Column:
    """Aggregate: the sketch (binary) of the start times, in epoch seconds; nulls are left out."""
    return F.kll_sketch_agg_bigint(ntz_seconds(F.col(ts)), F.lit(k))


def _quantiles(sketches: DataFrame, val_frac: float, test_frac: float, column: str) -> DataFrame:
    """One row of the two cuts in epoch seconds, from all sketches merged."""
    check_fractions(val_frac, test_frac)
    cut = lambda q: F.kll_sketch_get_quantile_bigint("_s", F.lit(q))
    return sketches.agg(F.kll_merge_agg_bigint(column).alias("_s")).select(
        cut(1.0 - val_frac - test_frac).alias("val_cut"), cut(1.0 - test_frac).alias("test_cut"))


def sketched_cut_days(sketches: DataFrame, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC,
                      column: str = "sketch") -> DataFrame:
    """One row ``(val_start date, test_start date)``."""
    day = lambda c: F.date_from_unix_date(F.floor(F.col(c) / F.lit(86400)).cast("int"))
    cuts = _quantiles(sketches, val_frac, test_frac, column)
    return cuts.select(day("val_cut").alias("val_start"), day("test_cut").alias("test_start"))


def sketch_rank_errors(df: DataFrame, sketches: DataFrame, val_frac: float = VAL_FRAC, test_frac: float = TEST_FRAC,
                       ts: str = "trip_start_ts", column: str = "sketch") -> DataFrame:
    """One row ``(val_error, test_error)``: how far, as a share of the rows of ``df``, the cuts are from the ranks asked for.

    Rows equal to a cut stand at any of their ranks.
    """
    cuts = _quantiles(sketches, val_frac, test_frac, column).first()
    s, n = F.col("_s"), F.count(F.lit(1))

    def error(cut: int, q: float) -> Column:
        below, upto = F.count_if(s < cut) / n, F.count_if(s <= cut) / n
        return F.greatest(below - q, q - upto, F.lit(0.0))

    rows = df.select(ntz_seconds(F.col(ts)).alias("_s")).where("_s IS NOT NULL")
    return rows.agg(error(cuts["val_cut"], 1.0 - val_frac - test_frac).alias("val_error"),
                    error(cuts["test_cut"], 1.0 - test_frac).alias("test_error"))


def within_error(errors: DataFrame, most: float = QUANTILE_RELATIVE_ERROR) -> DataFrame:
    return errors.select((F.col("val_error") <= most).alias("val_within"), (F.col("test_error") <= most).alias("test_within"))
