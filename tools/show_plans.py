"""Print the physical-plan facts of the headline jobs: exchanges, pushed filters,
read schemas, codegen stages.  Usage: python tools/show_plans.py [sf_dir]

The raw table is written once as Parquet (as the jobs read a real table).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def facts(name: str, df) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    formatted = buf.getvalue()
    exchanges = re.findall(r"Exchange (\w+\(?[^,\]]*)", plan)
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", formatted)))
    reads = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", formatted)))
    codegen = len(set(re.findall(r"\*\((\d+)\)", plan)))
    print(f"== {name}")
    print(f"   exchanges ({len(exchanges)}): {exchanges}")
    print(f"   pushed filters: {pushed}")
    print(f"   read schemas: {reads}")
    print(f"   whole-stage codegen stages: {codegen}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")  # show the static plan
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large inputs
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="triplake-plans-"))

    from triplake import lake as lk
    from triplake.operators import profiles
    from triplake.operators.gold import to_gold
    from triplake.operators.route import reject_records, route_counts
    from triplake.operators.split import assign_split, cut_days_frame
    from triplake.plans.clean import clean_frames, flag_with_counts, run_clean
    from triplake.plans.export import run_export
    from triplake.schemas import HISTORICAL_DATASET
    from triplake.sources.fixture import trips_raw
    from triplake.sources.historical import read_historical
    from triplake.sources.landing import read_live, read_pending
    from triplake.sources.silver import read_silver_run

    raw_dir = lk.scratch_dir(spark, "plans-raw")
    trips_raw(spark, sf_dir).write.parquet(raw_dir)
    raw = spark.read.parquet(raw_dir)
    facts("clean: silver (scope, rules, typed projection, dedupe)", clean_frames(raw)[0])
    facts("clean: rejects", reject_records(flag_with_counts(raw)[1]))
    facts("historical scan [1996-01-01, 2001-01-01)", read_historical(spark, raw_dir, "1996-01-01", "2001-01-01"))
    facts("route counts", route_counts(raw))
    lake = lk.scratch_dir(spark, "plans-lake")
    run = run_clean(spark, raw, lake, HISTORICAL_DATASET, run_ts="x")
    silver = read_silver_run(spark, run["silver"])
    facts("gold: cut days", cut_days_frame(silver))
    facts("gold: rows", to_gold(assign_split(silver, "2000-05-01", "2001-01-28")))
    facts("profile: dirtiness", profiles.dirtiness(raw))
    facts("profile: extent", profiles.extent(raw))
    run_export(spark, raw, lake, "1995-01-01", "2002-01-01", outcomes_until="2001-06-01")
    facts("live: requests join outcomes", read_live(spark, lake, "1998-01-01", "1998-02-01"))
    facts("live: pending requests", read_pending(spark, lake, "1998-01-01", "1998-02-01"))


if __name__ == "__main__":
    main()
