"""Writers: silver Parquet, reject JSON lines, gold Parquet by split, landing JSON.

Every batch output goes to a fresh folder with ``errorifexists``; reruns
get a new run id or version instead of overwriting.  Landing exports
overwrite only the day folders they produce (dynamic partition overwrite).
JSON lines are gzipped: as plain text they are most of what a job writes.
"""

from __future__ import annotations

import contextlib
import threading
import uuid

from pyspark.sql import Column, DataFrame, functions as F, types as T

from triplake.lake import delete_folder, landing_root, move_folder, path_exists
from triplake.schemas import EVENT_DATE, GOLD_COLUMNS, SILVER_COLUMNS
from triplake.sources.historical import utc_wall_times


def write_silver(silver: DataFrame, path: str) -> None:
    silver.select(*SILVER_COLUMNS).write.mode("errorifexists").parquet(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """JSON lines ``{unique_key, problems, raw}``; null raw values are written as null.

    Rejects are a thin slice of every scan task; the caller rebalances the rows
    that they are made of, which are a third as wide.
    """
    (rejects.select("unique_key", "problems", "raw").write.mode("errorifexists")
        .option("ignoreNullFields", "false").option("compression", "gzip").json(path))


def write_gold(gold: DataFrame, path: str) -> None:
    """Partitioned by split; fails if the version exists."""
    gold.select(*GOLD_COLUMNS).write.mode("errorifexists").partitionBy("split").parquet(path)


def warehouse_ts_text(c) -> F.Column:
    """Warehouse export text for a zone-less UTC timestamp: ``YYYY-MM-DD HH:MM:SS[.f] UTC``.

    The NTZ -> string cast is zone-free (``date_format`` would go through
    the session time zone and shift wall times inside DST gaps).
    """
    return F.concat(c.cast("string"), F.lit(" UTC"))


def request_fields(raw: DataFrame) -> list[Column]:
    """Everything known at payment time (all but tips), as a warehouse JSON export
    writes it: integers as strings, timestamps (zone-less here) as UTC text."""
    cols = []
    for f in raw.schema.fields:
        if f.name in ("tips", "trip_total"):
            continue
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(warehouse_ts_text(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return cols


def request_records(raw: DataFrame, ts: str = "trip_start_timestamp") -> DataFrame:
    """``request_fields`` of each trip, plus ``event_date``."""
    raw = utc_wall_times(raw)
    return raw.select(*request_fields(raw), F.to_date(F.col(ts)).alias(EVENT_DATE))


def outcome_fields() -> list[Column]:
    """The late outcome of a trip as stored in the source (timestamps zone-less)."""
    return [F.col("unique_key"), F.col("tips"), F.col("trip_total"),
            warehouse_ts_text(F.col("trip_end_timestamp")).alias("trip_end_timestamp")]


def outcome_records(raw: DataFrame, ts: str = "trip_start_timestamp") -> DataFrame:
    """``outcome_fields`` of each trip, foldered by the trip's *start* day."""
    return utc_wall_times(raw).select(*outcome_fields(), F.to_date(F.col(ts)).alias(EVENT_DATE))


def write_landing(records: DataFrame, root: str) -> None:
    """One folder per ``event_date``, written as few files per day.

    A first export is a plain write (one commit); only where day folders
    exist already are those of the export's days replaced, one by one.

    ``rebalance`` hash-partitions rows by day (one file per day for normal
    days) and lets AQE split an oversized day across several tasks, so a
    day holding a large share of the rows never lands on one task.
    """
    days = records.hint("rebalance", EVENT_DATE).write.partitionBy(EVENT_DATE)
    if path_exists(records.sparkSession, root):
        days = days.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    days.option("compression", "gzip").json(root)


def json_line(fields: list[Column]) -> Column:
    """The line of JSON that a record of these fields is written as."""
    return F.to_json(F.struct(*fields))


#: Bytes of shuffled trips that a task of a landing renders and sorts as text, several times as wide.
LANDING_TASK_BYTES = 16 << 20
_TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_task_size_lock = threading.Lock()


@contextlib.contextmanager
def _small_tasks(spark):
    """Tasks whose lines are sorted in memory; the session's own size comes back."""
    with _task_size_lock:
        before = spark.conf.get(_TASK_SIZE)
        spark.conf.set(_TASK_SIZE, str(LANDING_TASK_BYTES))
        try:
            yield
        finally:
            spark.conf.set(_TASK_SIZE, before)


def write_landings(trips: DataFrame, lake: str, lines: dict[str, tuple[Column, Column]], day: Column | None) -> None:
    """Several landing folders from one pass: by folder, a trip's line of text there (null: none) and its ``event_date``.

    The trips are computed and dealt by ``day`` (None: they are dealt already)
    once, before their lines, several times as wide, are made; the folders are
    written together and each is there by one rename.  Folders with days in them get a
    pass each that replaces the days of its lines.
    """
    spark = trips.sparkSession
    dealt = trips if day is None else trips.withColumn("_day", day).hint("rebalance", "_day")
    roots = {folder: landing_root(lake, folder) for folder in lines}
    if any(path_exists(spark, root) for root in roots.values()):
        for folder, (text, date) in lines.items():
            (dealt.select(text.alias("value"), date.alias(EVENT_DATE)).where("value IS NOT NULL").hint("rebalance", EVENT_DATE)
             .write.partitionBy(EVENT_DATE).mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "gzip").text(roots[folder]))
        return
    new = landing_root(lake, f"_new-{uuid.uuid4().hex[:12]}")
    try:
        every = F.array(*[F.struct(F.lit(folder).alias("folder"), text.alias("value"), date.alias(EVENT_DATE))
                          for folder, (text, date) in lines.items()])
        with _small_tasks(spark):
            (dealt.select(F.explode(every).alias("l")).select("l.*").where("value IS NOT NULL")
             .write.partitionBy("folder", EVENT_DATE).option("compression", "gzip").text(new))
        for folder, root in roots.items():
            part = f"{new}/folder={folder}"
            if not path_exists(spark, part):  # not a line
                spark.createDataFrame([], "value string").write.text(part)
            move_folder(spark, part, root)
    finally:
        delete_folder(spark, new)
