"""Streaming keep-one-per-key over landing folders, in two forms.

``dedupe_stream``: ``dropDuplicatesWithinWatermark`` for pipelines that need
bounded state.  A row more than ``delay`` behind the newest event time is
late and dropped by Spark (counted in the query's progress as
``numRowsDroppedByWatermark``); of rows with equal key and event time the
first to arrive survives.

``run_stream_firsts``: what the registered queries use.  Every micro-batch
is reduced with the batch operator (map-side, so a hot key or the null keys
reach the shuffle as one row a task) and written to its own ``batch=n``
folder, overwritten if the batch is replayed.  First-per-key is a minimum,
so the first of all batches' firsts is the first of the stream: the result
does not depend on how files were dealt into micro-batches, and no row is
ever too late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake.functions.scalars import to_double
from triplake.lake import landing_root
from triplake.operators.join import first_outcomes, first_requests
from triplake.operators.route import conform_raw
from triplake.schemas import EVENT_DATE, OUTCOME_SCHEMA, OUTCOMES_FOLDER, RAW_COLUMNS, REQUEST_SCHEMA, REQUESTS_FOLDER


def dedupe_stream(stream: DataFrame, key: str = "unique_key", event_time: str = "event_time",
                  delay: str = "1 day") -> DataFrame:
    """One row per (key, event time); rows over ``delay`` late are dropped and counted in the progress."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key, event_time])


def landing_stream(spark: SparkSession, lake: str, folder: str, schema: T.StructType,
                   files_per_batch: int | None = None) -> DataFrame:
    """A landing folder as a file stream, oldest files first."""
    full = T.StructType(list(schema.fields) + [T.StructField(EVENT_DATE, T.DateType(), True)])
    src = spark.readStream.schema(full).option("mode", "FAILFAST").option("latestFirst", "false")
    if files_per_batch:
        src = src.option("maxFilesPerTrigger", files_per_batch)
    return src.json(landing_root(lake, folder))


def request_stream(spark: SparkSession, lake: str, files_per_batch: int | None = None) -> DataFrame:
    """Typed requests; event time = landing day."""
    return conform_raw(landing_stream(spark, lake, REQUESTS_FOLDER, REQUEST_SCHEMA, files_per_batch),
                       keep=[EVENT_DATE]).withColumn("event_time", F.col(EVENT_DATE).cast(T.TimestampType()))


def outcome_stream(spark: SparkSession, lake: str, files_per_batch: int | None = None) -> DataFrame:
    """Outcomes: key, tips and landing day."""
    src = landing_stream(spark, lake, OUTCOMES_FOLDER, OUTCOME_SCHEMA, files_per_batch)
    return src.select("unique_key", to_double(F.col("tips"), T.StringType()).alias("tips"),
                      F.col(EVENT_DATE), F.col(EVENT_DATE).cast(T.TimestampType()).alias("event_time"))


def own_session(spark: SparkSession, partitions: int | None) -> SparkSession:
    """A session for one stream with its own number of shuffle partitions; the caller's stays as it is."""
    session = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        session.conf.set(k, spark.conf.get(k))
    if partitions:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


def run_batches(stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], out_dir: str) -> None:
    """Reduce each micro-batch of what has landed so far into ``out_dir/data/batch=n``."""
    def write(batch: DataFrame, n: int) -> None:
        reduce(batch).write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/data/batch={n}")

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out_dir}/_checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def in_window(df: DataFrame, start=None, end=None) -> DataFrame:
    """Landing days in ``[start, end)``; None is open."""
    if start is not None:
        df = df.where(F.col(EVENT_DATE) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(EVENT_DATE) < F.lit(str(end)).cast("date"))
    return df


def run_stream_firsts(spark: SparkSession, lake: str, out_dir: str, side: str, start=None, end=None,
                      partitions: int | None = None, files_per_batch: int | None = None) -> DataFrame:
    """First request (or outcome: ``side``) per key of everything landed in ``[start, end)``."""
    session = own_session(spark, partitions)
    if side == "requests":
        stream, first = request_stream(session, lake, files_per_batch), lambda df: first_requests(df.select(*RAW_COLUMNS))
    else:
        stream, first = outcome_stream(session, lake, files_per_batch), first_outcomes
    run_batches(in_window(stream, start, end), first, out_dir)
    return first(_read(spark, out_dir, first(_empty(spark, stream)).schema))


def _empty(spark: SparkSession, stream: DataFrame) -> DataFrame:
    return spark.createDataFrame([], stream.schema)


def _read(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """All batches; ``tips`` of requests, which they never hold, is added for the reducer's input shape."""
    df = spark.read.schema(schema).parquet(f"{out_dir}/data")
    return df if "tips" in df.columns else df.select(
        *[F.lit(None).cast("double").alias(c) if c == "tips" else F.col(c) for c in RAW_COLUMNS])
