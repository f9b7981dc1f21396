"""Profile job: extent, payment mix, dirtiness and tip histogram of raw trips."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame

from triplake.lake import run_concurrently
from triplake.operators import profiles


def run_profile(raw: DataFrame, start=None, end=None) -> dict[str, DataFrame]:
    return {
        "extent": profiles.extent(raw),
        "payment": profiles.payment_mix(raw, start, end),
        "dirtiness": profiles.dirtiness(raw, start, end),
        "tip_histogram": profiles.tip_histogram(raw, start, end),
    }


def collect_profiles(raw: DataFrame, start=None, end=None) -> dict[str, list]:
    """All profiles, run as concurrent jobs (each returns a handful of rows)."""
    frames = run_profile(raw, start, end)
    rows = run_concurrently(*[(lambda df=df: df.collect()) for df in frames.values()])
    return dict(zip(frames, rows))


def main(argv: list[str] | None = None) -> None:
    from triplake.session import get_session
    from triplake.sources.historical import read_historical

    p = argparse.ArgumentParser(description="Profile raw trips.")
    p.add_argument("--raw", required=True)
    p.add_argument("--start_date", default=None)
    p.add_argument("--end_date", default=None)
    a = p.parse_args(argv)
    spark = get_session("triplake-profile")
    raw = read_historical(spark, a.raw)
    for name, rows in collect_profiles(raw, a.start_date, a.end_date).items():
        print(f">> {name}")
        for r in rows:
            print("   ", r.asDict())


if __name__ == "__main__":
    main(sys.argv[1:])
