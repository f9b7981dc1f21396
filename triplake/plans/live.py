"""Incremental live runs: each reads the landing days since the run before, and a ledger of what is still open.

A run over ``[start, end)`` reads the requests of these days and the outcomes
that landed since the last run read outcomes, up to the grace after ``end``.
What earlier days left open is in the ledger of the run before:

* ``pending``  first requests without an outcome so far,
* ``early``    outcomes whose request has not landed yet,
* ``settled``  keys that are joined, one part a run; every ``compact_after``
  parts are merged into one.

Open requests and outcomes meet in one full outer join, written once; joined
rows become a silver run with its rejects, the rest the next ledger.  All of it
is visible by the one commit of the run, whose manifest names the ledger.  So a
killed run leaves the ledger as it was, the union of the runs is the join over
all days (of a key's outcomes the one read first, then the smallest tip), and
a window that is committed is not run again.  Old keys are not shuffled to find
the repeated ones among them: they are filtered by the window's keys.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake import lake, runs
from triplake.operators.join import first_outcomes, first_requests
from triplake.plans.clean import run_clean
from triplake.schemas import LIVE_DATASET, OUTCOME_GRACE_DAYS, RAW_COLUMNS, RAW_SCHEMA, REQUEST_COLUMNS
from triplake.sources.landing import read_outcomes, read_requests

KEY = "unique_key"
PENDING_SCHEMA = T.StructType([f for f in RAW_SCHEMA.fields if f.name != "tips"])
EARLY_SCHEMA = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("tips", T.DoubleType())])
SETTLED_SCHEMA = T.StructType([T.StructField(KEY, T.StringType())])
#: Parts of the settled keys after which they are merged.
COMPACT_AFTER = 16


def increments(spark: SparkSession, out_lake: str, dataset: str = LIVE_DATASET) -> list[dict]:
    """Manifests of the committed incremental runs, in their order (a small file a run)."""
    root = lake.silver_root(out_lake, dataset)
    done = [runs.manifest(spark, root, r) for r in runs.committed_ids(spark, root)]
    return sorted((m for m in done if "ledger" in m["extra"]), key=lambda m: int(m["extra"]["ledger"]))


def _stored(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def open_items(requests: DataFrame, outcomes: DataFrame, pending: DataFrame, early: DataFrame,
               settled: DataFrame | None) -> DataFrame:
    """Request columns, ``o_key`` and ``o_tips``: open requests and outcomes by key, both where they meet.

    ``requests`` and ``outcomes`` are new; keys must not be null.  ``settled``: None before anything is.
    """
    # a pending request is the first of its key, whatever lands later; old and new are told apart by ``_run`` and reduced at once
    both = pending.select(*REQUEST_COLUMNS, F.lit(0).alias("_run")).unionByName(requests.select(*REQUEST_COLUMNS, F.lit(1).alias("_run")))
    req = first_requests(both, before=("_run",)).select(*REQUEST_COLUMNS)
    both = early.select(KEY, "tips", F.lit(0).alias("_run")).unionByName(outcomes.select(KEY, "tips", F.lit(1).alias("_run")))
    out = first_outcomes(both, before=("_run",)).select(F.col(KEY).alias("o_key"), F.col("tips").alias("o_tips"))
    if settled is not None:
        window = requests.select(KEY).unionByName(outcomes.select(KEY)).distinct()
        again = settled.join(window, KEY, "left_semi").select(KEY).distinct()
        req = req.join(again, KEY, "left_anti")
        out = out.join(again.select(F.col(KEY).alias("o_key")), "o_key", "left_anti")
    return req.join(out, F.col(KEY) == F.col("o_key"), "full_outer")


def run_live(spark: SparkSession, landing_lake: str, out_lake: str, end, start=None, dataset: str = LIVE_DATASET,
             grace_days: int = OUTCOME_GRACE_DAYS, compact_after: int = COMPACT_AFTER, table: str | None = None) -> dict:
    """The run up to ``end`` (exclusive); ``start`` is the end of the run before, and needed for the first only.

    Returns the run's manifest.  A window that is already committed is not run again.
    """
    end = dt.date.fromisoformat(str(end))
    done = increments(spark, out_lake, dataset)
    for m in done:
        if m["end"] == str(end):
            return m
    last = done[-1] if done else None
    if last and end < dt.date.fromisoformat(last["end"]):
        raise ValueError(f"runs up to {last['end']} are committed; {end} lies before")
    start = dt.date.fromisoformat(last["end"] if last else str(start))
    if start >= end:
        raise ValueError(f"no days from {start} to {end}")
    # outcomes up to the last run's grace are in its ledger or joined
    outcomes_from = start + dt.timedelta(days=int(last["extra"]["grace_days"])) if last else start
    before = last["folders"] if last else {}
    settled_parts = json.loads(last["extra"]["settled"]) if last else []

    version = len(done) + 1
    run_id = f"{start}_{end}_increment-{version:06d}"
    ledger = f"{out_lake}/ledger/{dataset}"
    folders = {name: f"{ledger}/run_id={run_id}/{name}" for name in ("pending", "early", "settled", "keyless")}
    root = lake.silver_root(out_lake, dataset)
    # the claim of a version: of two runs after the same run one goes on
    with runs.writing(spark, ledger, f"version-{version:06d}", {}) as head:
        requests = read_requests(spark, landing_lake, start, end)
        outcomes = read_outcomes(spark, landing_lake, outcomes_from, end, grace_days)
        stage = lake.scratch_dir(spark, "live-open")
        try:
            open_items(requests.where(F.col(KEY).isNotNull()), outcomes.where(F.col(KEY).isNotNull()),
                       _stored(spark, PENDING_SCHEMA, [before["pending"]] if before else []),
                       _stored(spark, EARLY_SCHEMA, [before["early"]] if before else []),
                       _stored(spark, SETTLED_SCHEMA, settled_parts) if settled_parts else None
                       ).write.option("compression", "zstd").parquet(stage)
            items = spark.read.parquet(stage)
            has_request, has_outcome = F.col(KEY).isNotNull(), F.col("o_key").isNotNull()
            joined = items.where(has_request & has_outcome).select(
                *[F.col("o_tips").alias("tips") if c == "tips" else F.col(c) for c in RAW_COLUMNS])

            def write_ledger() -> dict[str, str]:
                compact = len(settled_parts) + 1 >= compact_after
                keys = joined.select(KEY)
                if compact:
                    keys = keys.unionByName(_stored(spark, SETTLED_SCHEMA, settled_parts))
                lake.run_concurrently(
                    lambda: items.where(has_request & ~has_outcome).select(*REQUEST_COLUMNS).write.option("compression", "zstd").parquet(folders["pending"]),
                    lambda: items.where(has_outcome & ~has_request).select(
                        F.col("o_key").alias(KEY), F.col("o_tips").alias("tips")).write.parquet(folders["early"]),
                    lambda: keys.write.option("compression", "zstd").parquet(folders["settled"]),
                    lambda: requests.where(F.col(KEY).isNull()).select(*REQUEST_COLUMNS).write.parquet(folders["keyless"]))
                parts = [folders["settled"]] if compact else [*settled_parts, folders["settled"]]
                return {"ledger": str(version), "settled": json.dumps(parts), "grace_days": str(grace_days),
                        "outcomes_from": str(outcomes_from)}

            run_clean(spark, joined, out_lake, dataset, start, end, f"increment-{version:06d}", materialize="staged", table=table,
                      folders=folders, before_commit=write_ledger)
        finally:
            lake.delete_folder(spark, stage)
        head.commit(start, end, extra={"run_id": run_id})
    return runs.manifest(spark, root, run_id)


def read_open_requests(spark: SparkSession, out_lake: str, dataset: str = LIVE_DATASET) -> DataFrame:
    """Requests without an outcome after the last run: the ledger's, and every request without a key."""
    done = increments(spark, out_lake, dataset)
    pending = _stored(spark, PENDING_SCHEMA, [done[-1]["folders"]["pending"]] if done else [])
    return pending.unionByName(_stored(spark, PENDING_SCHEMA, [m["folders"]["keyless"] for m in done]))


def main(argv: list[str] | None = None) -> dict:
    from triplake.session import get_session

    p = argparse.ArgumentParser(description="One incremental live run: new landing days and the ledger of open ones.")
    p.add_argument("--landing_lake", required=True)
    p.add_argument("--out_lake", required=True)
    p.add_argument("--start_date", default=None, help="inclusive; of the first run only")
    p.add_argument("--end_date", required=True, help="exclusive")
    p.add_argument("--grace_days", type=int, default=OUTCOME_GRACE_DAYS)
    p.add_argument("--table", default=None, help="catalog table that the run is added to as a partition")
    p.add_argument("--shuffle_partitions", type=int, default=None,
                   help="about shuffled bytes / 128 MB; AQE coalesces from there")
    a = p.parse_args(argv)
    spark = get_session("triplake-live", shuffle_partitions=a.shuffle_partitions)
    m = run_live(spark, a.landing_lake, a.out_lake, a.end_date, a.start_date, grace_days=a.grace_days, table=a.table)
    print(json.dumps(m, indent=2))
    return m


if __name__ == "__main__":
    main(sys.argv[1:])
