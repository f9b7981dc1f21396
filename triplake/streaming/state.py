"""Streams whose state is Spark's: keep-first per key and day, and the outer join of requests with late outcomes.

``first_per_day``: one row per key and landing day, the first in a total
order, as a streaming aggregate in append mode.  A group comes out once the
watermark has passed its day, and leaves the state then; so the state holds the
days within ``delay`` of the newest, whatever the stream's length, and the
result does not depend on how files fell into micro-batches.

``outer_join``: each such request with the outcomes that land for its key
within the grace days.  Both sides carry a watermark.  A matched request comes
out as it matches; a request whose grace has run out without an outcome comes
out as pending, and its state goes.  Requests without a key match nothing; they
are told apart by their content and counted, so each comes out as pending.

Rows that land after the watermark has passed their day are dropped by Spark
and counted in the progress (``StreamRun.late_rows``).  State is kept by the
RocksDB provider under the query's checkpoint, with output by the file sink's
own commit log, so a stopped stream goes on where it stopped and a replayed
micro-batch adds nothing.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from triplake.lake import hadoop_fs, landing_root
from triplake.operators.join import request_order
from triplake.schemas import EVENT_DATE, OUTCOME_GRACE_DAYS, OUTCOMES_FOLDER, REQUEST_COLUMNS, REQUESTS_FOLDER
from triplake.streaming.dedupe import in_window, outcome_stream, own_session, request_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a day's records keep landing, at most.
DELAY_DAYS = 1
MATCHED, PENDING = "matched", "pending"
#: Keys that stand for records without one begin with it.
_KEYLESS = "\x00"


@dataclasses.dataclass
class StreamRun:
    """What a run over a stream did: micro-batches with rows, rows dropped as late, state rows after each batch."""
    batches: int
    late_rows: int
    state_rows: list[int]


def state_session(spark: SparkSession, partitions: int | None) -> SparkSession:
    """A session for stateful streams; the number of its state partitions is fixed by the first run over a checkpoint."""
    session = own_session(spark, partitions)
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a stopped stream goes on from its last micro-batch, so older versions of the state are not kept (100 by default)
    session.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    session.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "15s")
    session.conf.set("spark.sql.streaming.stateStore.compression.codec", "zstd")
    return session


def _keyed(stream: DataFrame, key: str) -> DataFrame:
    """Null keys replaced by a digest of the record."""
    content = F.to_json(F.struct(*[c for c in stream.columns if c != key]))
    return stream.withColumn(key, F.coalesce(F.col(key), F.concat(F.lit(_KEYLESS), F.sha2(content, 256))))


def is_keyless(key: Column) -> Column:
    return key.startswith(_KEYLESS)


def first_per_day(stream: DataFrame, key: str = "unique_key", event_time: str = "event_time",
                  order_by: list[str] | None = None, delay_days: int = DELAY_DAYS, keep_keyless: bool = False) -> DataFrame:
    """The first row per key and event time in ``order_by`` (then the other columns), ascending, nulls first.

    Null keys form one group a day, or with ``keep_keyless`` a group for each
    distinct record, with a key of its own and the number of equal ones in ``n_equal``.
    """
    order = [c for c in (order_by or []) if c not in (key, event_time)]
    order += [c for c in stream.columns if c not in (key, event_time, *order)]
    rows = _keyed(stream, key) if keep_keyless else stream
    groups = rows.withWatermark(event_time, f"{delay_days} days").groupBy(key, event_time)
    first = F.min(F.struct(*order)).alias("_first")
    counts = [F.count(F.lit(1)).alias("n_equal")] if keep_keyless else []
    return groups.agg(first, *counts).select(
        *[F.col(c) if c in (key, event_time) else F.col(f"_first.{c}").alias(c) for c in stream.columns],
        *(["n_equal"] if keep_keyless else []))


def outer_join(requests: DataFrame, outcomes: DataFrame, grace_days: int = OUTCOME_GRACE_DAYS,
               delay_days: int = DELAY_DAYS) -> DataFrame:
    """Request columns, ``event_date``, ``tips``, ``outcome_date`` and ``status`` (matched or pending).

    A request meets every first-of-its-day outcome of its key that lands from
    its own day to ``grace_days`` later, so one with outcomes on two of these
    days comes out twice (``settled`` keeps the first).
    """
    kept = [c for c in requests.columns if c in REQUEST_COLUMNS or c in (EVENT_DATE, "event_time")]
    req = first_per_day(requests.select(*kept), order_by=request_order(requests), delay_days=delay_days, keep_keyless=True)
    out = first_per_day(outcomes.where("unique_key IS NOT NULL").select("unique_key", "tips", "event_time"),
                        delay_days=delay_days)
    out = out.select(F.col("unique_key").alias("o_key"), F.col("tips").alias("o_tips"), F.col("event_time").alias("o_time"))
    within = ((F.col("unique_key") == F.col("o_key")) & (F.col("o_time") >= F.col("event_time"))
              & (F.col("o_time") <= F.col("event_time") + F.expr(f"INTERVAL {int(grace_days)} DAYS")))
    keyless = is_keyless(F.col("unique_key"))
    joined = req.join(out, within, "left_outer").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.when(keyless, F.col("n_equal")).otherwise(F.lit(1)).cast("int"))))
    return joined.select(
        *[F.when(~keyless, F.col(c)).alias(c) if c == "unique_key" else F.col(c) for c in REQUEST_COLUMNS], F.col(EVENT_DATE),
        F.col("o_tips").alias("tips"), F.to_date("o_time").alias("outcome_date"),
        F.when(F.col("o_key").isNull(), PENDING).otherwise(MATCHED).alias("status"))


def settled(rows: DataFrame) -> DataFrame:
    """One row a request: of several outcomes the one that landed first, then the smallest tip."""
    request = [*REQUEST_COLUMNS, EVENT_DATE]
    matched = rows.where(F.col("status") == MATCHED).groupBy(*request).agg(
        F.min(F.struct("outcome_date", "tips")).alias("_o")).select(
        *request, F.col("_o.tips").alias("tips"), F.col("_o.outcome_date").alias("outcome_date"), F.lit(MATCHED).alias("status"))
    return matched.unionByName(rows.where(F.col("status") == PENDING))


def _progress(query: StreamingQuery) -> StreamRun:
    done = query.recentProgress
    return StreamRun(sum(p["numInputRows"] > 0 for p in done),
                     sum(o["numRowsDroppedByWatermark"] for p in done for o in p["stateOperators"]),
                     [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in done])


def run_to_end(stream: DataFrame, out_dir: str) -> StreamRun:
    """Process what has landed since the last run over ``out_dir`` and append what settled to ``out_dir/data``."""
    session = stream.sparkSession
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100000")
    query = (stream.writeStream.format("parquet").option("path", f"{out_dir}/data").outputMode("append")
             .option("checkpointLocation", f"{out_dir}/_checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return _progress(query)


def run_keep_first(spark: SparkSession, lake: str, out_dir: str, start=None, end=None, delay_days: int = DELAY_DAYS,
                   partitions: int | None = None, files_per_batch: int | None = None) -> StreamRun:
    """First request per key and landing day of what lands in ``[start, end)``, as days settle; read with ``read_settled``."""
    session = state_session(spark, partitions)
    requests = in_window(request_stream(session, lake, files_per_batch), start, end)
    kept = requests.select(*REQUEST_COLUMNS, EVENT_DATE, "event_time")
    firsts = first_per_day(kept, order_by=request_order(kept), delay_days=delay_days)
    return run_to_end(firsts.drop("event_time"), out_dir)


def _landed_files(spark: SparkSession, lake: str, folder: str) -> int:
    p, fs = hadoop_fs(spark, f"{landing_root(lake, folder)}/{EVENT_DATE}=*/[!._]*")
    return len(fs.globStatus(p) or [])


def outcome_files(spark: SparkSession, lake: str, request_files: int) -> int:
    """Files of outcomes that a micro-batch takes beside so many files of requests.

    Both folders hold the same days, but not in as many files.  The watermark
    follows the stream that is behind, so with equal numbers of files the state
    would hold all the days that the other one is ahead.
    """
    n, m = (_landed_files(spark, lake, folder) for folder in (REQUESTS_FOLDER, OUTCOMES_FOLDER))
    return max(1, round(request_files * m / n)) if n else request_files


def run_outer_join(spark: SparkSession, lake: str, out_dir: str, start=None, end=None,
                   grace_days: int = OUTCOME_GRACE_DAYS, delay_days: int = DELAY_DAYS, partitions: int | None = None,
                   files_per_batch: int | None = None) -> StreamRun:
    """Requests that land in ``[start, end)`` with their outcomes, or as pending once their grace ran out."""
    session = state_session(spark, partitions)
    requests = in_window(request_stream(session, lake, files_per_batch), start, end)
    outcomes = in_window(outcome_stream(session, lake, files_per_batch and outcome_files(spark, lake, files_per_batch)), start, None)
    return run_to_end(outer_join(requests, outcomes, grace_days, delay_days), out_dir)


def read_settled(spark: SparkSession, out_dir: str, schema: T.StructType | None = None) -> DataFrame:
    """What a stream has put out so far (committed micro-batches only)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{out_dir}/data")
