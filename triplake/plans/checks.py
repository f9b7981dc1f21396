"""Silver checks job: uniqueness, nulls and date range of one run."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from triplake.operators import checks
from triplake.sources.silver import read_silver_table


def parse_run_window(run_id: str) -> tuple[str | None, str | None]:
    start, end, _ = run_id.split("_", 2)
    return (None if start == "open" else start), (None if end == "open" else end)


def run_checks(spark: SparkSession, dataset_root: str, run_id: str) -> dict[str, DataFrame]:
    """The three checks as separate frames (each its own scan)."""
    table = read_silver_table(spark, dataset_root, run_id)
    start, end = parse_run_window(run_id)
    out = {"unique": checks.uniqueness(table, run_id), "nulls": checks.nulls(table, run_id)}
    if start and end:
        out["date_range"] = checks.date_range(table, start, end, run_id)
    return out


def run_all_checks(spark: SparkSession, dataset_root: str, run_id: str) -> DataFrame:
    """All checks of the run in one scan (what the job prints)."""
    start, end = parse_run_window(run_id)
    return checks.all_checks(read_silver_table(spark, dataset_root, run_id), run_id, start, end)


def main(argv: list[str] | None = None) -> None:
    from triplake.session import get_session

    p = argparse.ArgumentParser(description="Quality checks of one silver run.")
    p.add_argument("--dataset_root", required=True, help="e.g. <lake>/silver/trips")
    p.add_argument("--target_run", required=True)
    a = p.parse_args(argv)
    spark = get_session("triplake-checks")
    row = run_all_checks(spark, a.dataset_root, a.target_run).first().asDict()
    print(f">> checks of {a.target_run}: {row}")
    ok = row["n_rows"] == row["n_keys"] and row["null_start"] == row["null_fare"] == row["null_tips"] == 0
    ok = ok and row.get("rows_outside_window", 0) == 0
    print(">> PASS" if ok else ">> FAIL")


if __name__ == "__main__":
    main(sys.argv[1:])
