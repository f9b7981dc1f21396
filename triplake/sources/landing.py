"""Landing zone: daily JSON-lines folders of trip requests and outcomes.

Readers list the landing root's day folders once (one non-recursive
listing), keep those inside the window and hand only them to Spark with
``basePath`` set, so ``event_date`` stays a partition column and Spark
never lists the files of days outside the window (a root read would list
every file of every day before pruning).  Days without a folder are simply
absent; no per-day glob can fail.  Values are read as text with a declared
schema (never inferred) and typed with the coercion functions; a malformed
line fails the job, or is kept as a reject of its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake.functions.scalars import to_double
from triplake.lake import hadoop_fs, landing_root, path_exists, run_concurrently
from triplake.operators.join import join_outcomes, pending_requests
from triplake.operators.route import conform_raw
from triplake.schemas import (
    EVENT_DATE, OUTCOME_GRACE_DAYS, OUTCOME_SCHEMA, OUTCOMES_FOLDER, REQUEST_SCHEMA, REQUESTS_FOLDER,
)


#: The reject reason of a line that is no record, and the column that holds its text.
BAD_LINE = "bad_line"


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))


def read_landing(spark: SparkSession, lake: str, folder: str, start, end,
                 schema: T.StructType, bad_lines: str = "fail") -> DataFrame:
    """Records of ``landing/<folder>`` whose ``event_date`` is in ``[start, end)``.

    ``bad_lines="fail"``: a line that is no JSON object fails the job;
    ``"keep"``: it becomes a row whose only value is its text, in the further
    column ``BAD_LINE`` (null in records), for ``bad_line_rejects``.
    """
    if bad_lines not in ("fail", "keep"):
        raise ValueError(f"unknown treatment of bad lines {bad_lines!r}")
    kept = [T.StructField(BAD_LINE, T.StringType(), True)] if bad_lines == "keep" else []
    full = T.StructType([*schema.fields, *kept, T.StructField(EVENT_DATE, T.DateType(), True)])
    root = landing_root(lake, folder)
    s, e = _as_date(start), _as_date(end)
    days = day_folders(spark, root, s, e)
    if not days:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(full).option("basePath", root)
    if kept:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    else:
        reader = reader.option("mode", "FAILFAST")
    df = reader.json(days)
    return df.where((F.col(EVENT_DATE) >= F.lit(s)) & (F.col(EVENT_DATE) < F.lit(e)))


def _is_record(records: DataFrame) -> F.Column:
    """Whether a row of ``read_landing(..., bad_lines="keep")`` is a record.

    A record's column is named too (an empty line is no row, so that part is
    never true): the reader refuses plans that need the text of bad lines alone.
    """
    return F.col(BAD_LINE).isNull() | ((F.col(BAD_LINE) == "") & F.col(records.columns[0]).isNull())


def good_lines(records: DataFrame) -> DataFrame:
    """The records among the rows of ``read_landing(..., bad_lines="keep")``."""
    return records.where(_is_record(records)).drop(BAD_LINE)


def bad_line_rejects(records: DataFrame, folder: str) -> DataFrame:
    """Reject records of the lines that are no records: reason ``BAD_LINE``, and where and what they were."""
    raw = {"line": F.col(BAD_LINE), EVENT_DATE: F.col(EVENT_DATE).cast("string"), "folder": F.lit(folder)}
    return records.where(~_is_record(records)).select(
        F.lit(None).cast("string").alias("unique_key"), F.array(F.lit(BAD_LINE)).alias("problems"),
        F.create_map(*[x for k, v in raw.items() for x in (F.lit(k), v)]).alias("raw"))


def day_folders(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> list[str]:
    """``event_date=YYYY-MM-DD`` folders directly under ``root`` with start <= day < end.

    One non-recursive listing of the root (names only; the folder files are
    listed later by Spark, and only for the kept days).
    """
    if not path_exists(spark, root):
        return []
    p, fs = hadoop_fs(spark, root)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    out = []
    for name in (str(x.getName()) for x in paths):
        if not name.startswith(f"{EVENT_DATE}="):
            continue
        try:
            day = dt.date.fromisoformat(name.split("=", 1)[1])
        except ValueError:
            continue
        if start <= day < end:
            out.append(f"{root}/{name}")
    return sorted(out)


def read_requests(spark: SparkSession, lake: str, start, end) -> DataFrame:
    """Typed request records (RAW shape, ``tips`` null) for ``[start, end)``."""
    return conform_raw(read_landing(spark, lake, REQUESTS_FOLDER, start, end, REQUEST_SCHEMA))


def _outcomes(records: DataFrame) -> DataFrame:
    return records.select(F.col("unique_key"), to_double(F.col("tips"), T.StringType()).alias("tips"))


def _after_grace(end, grace_days: int) -> dt.date:
    return _as_date(end) + dt.timedelta(days=grace_days)


def read_outcomes(spark: SparkSession, lake: str, start, end,
                  grace_days: int = OUTCOME_GRACE_DAYS) -> DataFrame:
    """Outcomes for ``[start, end + grace)``: key and typed tips."""
    return _outcomes(read_landing(spark, lake, OUTCOMES_FOLDER, start, _after_grace(end, grace_days), OUTCOME_SCHEMA))


def read_live(spark: SparkSession, lake: str, start, end, grace_days: int = OUTCOME_GRACE_DAYS,
              null_safe: bool = False) -> DataFrame:
    """Requests joined with their outcomes, in the typed RAW shape."""
    req, out = _both(spark, lake, start, end, grace_days)
    return join_outcomes(req, out, null_safe=null_safe)


def read_live_and_bad_lines(spark: SparkSession, lake: str, start, end, grace_days: int = OUTCOME_GRACE_DAYS,
                            null_safe: bool = False) -> tuple[DataFrame, DataFrame]:
    """``read_live`` over the lines that are records, and reject records of those that are not."""
    req, out = run_concurrently(
        lambda: read_landing(spark, lake, REQUESTS_FOLDER, start, end, REQUEST_SCHEMA, "keep"),
        lambda: read_landing(spark, lake, OUTCOMES_FOLDER, start, _after_grace(end, grace_days), OUTCOME_SCHEMA, "keep"))
    joined = join_outcomes(conform_raw(good_lines(req)), _outcomes(good_lines(out)), null_safe=null_safe)
    return joined, bad_line_rejects(req, REQUESTS_FOLDER).unionByName(bad_line_rejects(out, OUTCOMES_FOLDER))


def _both(spark: SparkSession, lake: str, start, end, grace_days: int):
    """Request and outcome readers, built concurrently (their folder listings overlap)."""
    return run_concurrently(lambda: read_requests(spark, lake, start, end),
                            lambda: read_outcomes(spark, lake, start, end, grace_days))


def read_pending(spark: SparkSession, lake: str, start, end,
                 grace_days: int = OUTCOME_GRACE_DAYS) -> DataFrame:
    """Requests in ``[start, end)`` whose outcome has not landed within the grace days."""
    req, out = _both(spark, lake, start, end, grace_days)
    return pending_requests(req, out)
