"""Seed job: stage a holdout window once, then export daily landing folders.

Requests (everything but the tip) and outcomes are one partitioned write over
the window, not one query per day and not one pass a folder.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake import lake
from triplake.schemas import OUTCOMES_FOLDER, REQUESTS_FOLDER
from triplake.sources.historical import time_window, utc_wall_times
from triplake.sources.sinks import json_line, outcome_fields, request_fields, write_landings


def stage_holdout(spark: SparkSession, raw: DataFrame, start, end, path: str | None = None) -> DataFrame:
    """``SELECT * ... WHERE start <= ts < end`` written once and read back."""
    path = path or lake.scratch_dir(spark, "holdout")
    utc_wall_times(time_window(raw, start, end)).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def run_export(spark: SparkSession, raw: DataFrame, out_lake: str, start, end,
               staging: str | None = None, stage: bool = True, dealt: bool = False) -> dict:
    """Export daily request and outcome folders for ``[start, end)``.

    ``stage=True`` copies the window first (the copy goes when both exports are
    committed, unless ``staging`` names it), for a source that must not be
    scanned again where days are there already and are replaced; ``stage=False``
    reads the source directly, with the window pushed down to the scan.
    ``dealt``: its rows are dealt by day already.
    """
    copy = staging or lake.scratch_dir(spark, "holdout")
    holdout = stage_holdout(spark, raw, start, end, copy) if stage else utc_wall_times(time_window(raw, start, end))
    day = F.to_date("trip_start_timestamp")
    write_landings(holdout, out_lake, {REQUESTS_FOLDER: (json_line(request_fields(holdout)), day),
                                       OUTCOMES_FOLDER: (json_line(outcome_fields()), day)}, None if dealt and not stage else day)
    if stage and not staging:
        lake.delete_folder(spark, copy)
    return {folder: lake.landing_root(out_lake, path) for folder, path in (("requests", REQUESTS_FOLDER), ("outcomes", OUTCOMES_FOLDER))}


def main(argv: list[str] | None = None) -> dict:
    from triplake.session import get_session
    from triplake.sources.historical import open_raw

    p = argparse.ArgumentParser(description="Seed daily landing folders from a holdout window.")
    p.add_argument("--raw", required=True, help="table name or Parquet path of raw trips")
    p.add_argument("--holdout_start", required=True)
    p.add_argument("--holdout_end", required=True)
    p.add_argument("--out_lake", required=True)
    p.add_argument("--no_stage", action="store_true",
                   help="read the source directly instead of staging a copy of the window")
    p.add_argument("--shuffle_partitions", type=int, default=None,
                   help="about shuffled bytes / 128 MB; AQE coalesces from there")
    a = p.parse_args(argv)
    spark = get_session("triplake-export", shuffle_partitions=a.shuffle_partitions)
    out = run_export(spark, open_raw(spark, a.raw), a.out_lake, a.holdout_start, a.holdout_end, stage=not a.no_stage)
    print(out)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
