"""Streaming clean: landing streams -> firsts per key, batch by batch -> join -> silver run and rejects.

The keys of the silver run are unique over the whole run, not only within a
micro-batch, because routing follows the join of all batches' firsts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from triplake import lake as lk
from triplake.plans.clean import run_clean
from triplake.schemas import LIVE_DATASET, OUTCOME_GRACE_DAYS
from triplake.streaming.join import run_stream_join


def run_stream_clean(spark: SparkSession, lake: str, out_lake: str, start=None, end=None, run_ts: str | None = None,
                     dataset: str = LIVE_DATASET, grace_days: int = OUTCOME_GRACE_DAYS,
                     partitions: int | None = None, files_per_batch: int | None = None,
                     state: str | None = None) -> dict:
    """Process what has landed since the last run over ``state`` (default: from the start); one immutable run."""
    joined = run_stream_join(spark, lake, state or lk.scratch_dir(spark, "stream-clean"), start, end, grace_days,
                             partitions, files_per_batch)
    return run_clean(spark, joined, out_lake, dataset, start, end, run_ts, materialize="stage")
