"""Streaming request/outcome join.

``join_outcome_stream``: stream-stream join with bounded state, for
pipelines that need rows as they match.  Both sides keep one row per (key,
day); outcomes match when they land between the request day and
``grace_days`` later, and watermarks of ``grace_days`` let Spark drop older
state.  Later rows are dropped and counted in the query's progress.  A key
that recurs on several days yields a row for each.

``run_stream_join``: what the registered query uses.  Each side's firsts per
key are kept batch by batch (see ``dedupe``) and joined once, so the result
is that of the batch join, however the files were dealt into micro-batches.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.lake import run_concurrently
from triplake.operators.join import join_outcomes
from triplake.schemas import OUTCOME_GRACE_DAYS, RAW_COLUMNS
from triplake.streaming.dedupe import dedupe_stream, run_stream_firsts


def join_outcome_stream(requests: DataFrame, outcomes: DataFrame,
                        grace_days: int = OUTCOME_GRACE_DAYS) -> DataFrame:
    delay = f"{max(1, int(grace_days))} days"
    req = dedupe_stream(requests, delay=delay)
    out = dedupe_stream(outcomes.select(F.col("unique_key").alias("o_key"), F.col("tips").alias("o_tips"),
                                        F.col("event_time").alias("o_time")), "o_key", "o_time", delay)
    cond = ((req["unique_key"] == out["o_key"]) & (out["o_time"] >= req["event_time"])
            & (out["o_time"] <= req["event_time"] + F.expr(f"INTERVAL {int(grace_days)} DAYS")))
    joined = req.join(out, cond, "inner")
    return joined.select(*[F.col("o_tips").alias("tips") if c == "tips" else F.col(c) for c in RAW_COLUMNS])


def run_stream_join(spark: SparkSession, lake: str, out_dir: str, start=None, end=None,
                    grace_days: int = OUTCOME_GRACE_DAYS, partitions: int | None = None,
                    files_per_batch: int | None = None) -> DataFrame:
    """Requests landed in ``[start, end)`` with the outcomes landed by ``grace_days`` after it, in the RAW shape."""
    last = None if end is None else dt.date.fromisoformat(str(end)) + dt.timedelta(days=grace_days)
    # two streams with a session each: the micro-batches of one run while the other lists and commits
    req, out = run_concurrently(*[
        lambda side=side, until=until: run_stream_firsts(spark, lake, f"{out_dir}/{side}", side, start, until, partitions, files_per_batch)
        for side, until in (("requests", end), ("outcomes", last))])
    req = req.withColumn("tips", F.lit(None).cast("double")).select(*RAW_COLUMNS)
    return join_outcomes(req, out)
