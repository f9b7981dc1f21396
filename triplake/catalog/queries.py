"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

All of them start from the raw trips derived from the whole test tables.
Queries over sinks write into a lake under the session's checkpoint
folder (built once per session and scale) and return what is read back.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake import lake as lk, runs
from triplake.catalog.oracle import (
    DAY_SCAN_END, DAY_SCAN_START, HOLDOUT_END, HOLDOUT_START, LIVE_CUTS, LIVE_END, SCAN_END, SCAN_START,
)
from triplake.functions.features import build_features, label_column
from triplake.functions.scalars import default_strip, to_bigint, to_double, to_naive_ts
from triplake.operators import checks, profiles
from triplake.operators.gold import split_summary, to_gold
from triplake.operators.join import join_outcomes, pending_requests
from triplake.operators.route import (
    clean_projection, conform_raw, flag, in_scope, problem_counts, reject_records, route_counts, valid_rows,
)
from triplake.operators.rules import rule_flags
from triplake.operators.sketch import sketch_rank_errors, within_error
from triplake.operators.split import approx_rank_errors, assign_split, cut_dates, cut_days_frame
from triplake.plans.checks import run_all_checks
from triplake.plans.clean import clean_frames, run_clean, start_sketches
from triplake.plans.export import run_export, stage_holdout
from triplake.plans.gold import MANIFEST_NAME, run_gold
from triplake.plans.live import read_open_requests, run_live
from triplake.plans.profiling import run_profile
from triplake.schemas import (
    DEFAULT_COMPANY, EVENT_DATE, HISTORICAL_DATASET, ID_COLUMNS, LIVE_DATASET, OUTCOMES_FOLDER,
    OUTCOME_SCHEMA, RAW_COLUMNS, REQUESTS_FOLDER, REQUEST_COLUMNS, REQUEST_SCHEMA, SILVER_COLUMNS,
)
from triplake.sources.bucketed import add_run_keys, buckets_for, keys_in_several_runs, write_bucketed
from triplake.sources.catalog_table import catalog_runs, create_runs_table, silver_of_runs
from triplake.sources.fixture import keyless, outcome_arrival, stamp_arrival, trips_raw, trips_stored
from triplake.sources.historical import read_historical, time_window, utc_wall_times
from triplake.sources.landing import read_landing, read_live, read_live_and_bad_lines, read_outcomes, read_pending, read_requests
from triplake.sources.silver import list_runs, read_gold, read_rejects, read_silver_run, read_silver_table
from triplake.sources.registry import SOURCES
from triplake.sources.sinks import json_line, request_fields, request_records, write_landings, write_silver
from triplake.streaming.clean import run_stream_clean
from triplake.streaming.dedupe import in_window, run_stream_firsts
from triplake.streaming.join import run_stream_join
from triplake.streaming.route import run_stream_route
from triplake.streaming.state import read_settled, run_keep_first, run_outer_join, settled

RUN_TS = "20260101-000000"
GOLD_VERSION = "v1"
BUCKETS = 8
HALF_WRITTEN = "1996-01-01_2001-01-01_20260101-000001"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- lake ----
class _Lake:
    """Lake written by the jobs for one (session, scale); each part built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = lk.scratch_dir(spark, "lake")
        self._done: dict[str, object] = {}
        self._lock = threading.RLock()

    def _once(self, name: str, fn):
        with self._lock:
            if name not in self._done:
                self._done[name] = fn()
            return self._done[name]

    def raw(self, by: str | None = None) -> DataFrame:
        return trips_raw(self.spark, self.sf_dir, by)

    def silver_run(self) -> dict:
        return self._once("silver", lambda: run_clean(
            self.spark, self.raw(), self.root, HISTORICAL_DATASET, run_ts=RUN_TS, materialize="stage"))

    def window_run(self) -> dict:
        return self._once("silver_window", lambda: run_clean(
            self.spark, read_historical(self.spark, self.raw(), SCAN_START, SCAN_END), self.root,
            HISTORICAL_DATASET, SCAN_START, SCAN_END, run_ts=RUN_TS, materialize="stage"))

    def increments(self) -> str:
        """The live landing taken in by incremental runs up to each of LIVE_CUTS."""
        root = f"{self.root}/increments"

        def build():
            for end in LIVE_CUTS:
                run_live(self.spark, self.live(), root, end, HOLDOUT_START)
            return root
        return self._once("increments", build)

    def broken_live(self) -> str:
        """A landing by months where some lines broke off: of trips whose miles are a multiple of 21 (10 steps of 2.1)."""
        root = f"{self.root}/broken"

        def build():
            trips = keyless(time_window(self.raw("month"), HOLDOUT_START, HOLDOUT_END))
            broken = F.coalesce(F.col("trip_miles") % F.lit(21.0) < F.lit(0.1), F.lit(False))
            month = F.trunc("trip_start_timestamp", "month")
            whole = {REQUESTS_FOLDER: [c for c in RAW_COLUMNS if c != "tips"], OUTCOMES_FOLDER: ["unique_key", "tips"]}

            cut = F.concat(F.lit('{"cut":"'), F.coalesce("unique_key", F.lit("")))
            text = {folder: json_line([F.col(c).cast("string").alias(c) for c in columns]) for folder, columns in whole.items()}
            write_landings(trips, root, {folder: (F.when(broken, cut).otherwise(text[folder]), month) for folder in whole}, None)
            return root
        return self._once("broken", build)

    def outer_join(self) -> str:
        """Where the stream of requests with their outcomes, or as pending, put out what settled."""
        def build():
            out = lk.scratch_dir(self.spark, "stream-outer-join")
            run_outer_join(self.spark, self.live(), out, HOLDOUT_START, **_state_options(self.spark))
            return out
        return self._once("outer_join", build)

    def bucketed(self) -> tuple[DataFrame, DataFrame]:
        """Requests and outcomes of the live landing as tables bucketed by key."""
        def build():
            name, live = uuid.uuid4().hex[:12], self.live()
            buckets = buckets_for(lk.folder_bytes(self.spark, lk.landing_root(live, REQUESTS_FOLDER)), BUCKETS)
            return tuple(write_bucketed(df, f"{side}_{name}", lk.scratch_dir(self.spark, f"bucketed-{side}"), buckets) for side, df in (
                ("requests", read_requests(self.spark, live, HOLDOUT_START, LIVE_END)),
                ("outcomes", read_outcomes(self.spark, live, HOLDOUT_START, LIVE_END))))
        return self._once("bucketed", build)

    def half_written_run(self) -> None:
        """What a writer leaves that is killed between its two outputs: a claim and the silver folder."""
        def build():
            folder = lk.silver_dir(self.root, HISTORICAL_DATASET, HALF_WRITTEN)
            left = runs.writing(self.spark, lk.silver_root(self.root, HISTORICAL_DATASET), HALF_WRITTEN, {"silver": folder})
            left.__enter__()
            write_silver(read_silver_run(self.spark, self.window_run()["silver"]), folder)
            return left  # never left: no manifest is written, nothing is removed
        self._once("half_written", build)

    def runs_table(self) -> str:
        """A catalog table over the silver runs."""
        def build():
            self.silver_run(), self.window_run(), self.half_written_run()
            table = f"silver_{uuid.uuid4().hex[:12]}"
            create_runs_table(self.spark, table, lk.silver_root(self.root, HISTORICAL_DATASET))
            return table
        return self._once("runs_table", build)

    def gold(self) -> dict:
        def build():
            run = self.silver_run()
            gold_root = f"{self.root}/gold/tip_label"
            m = run_gold(self.spark, run["silver"], gold_root, GOLD_VERSION)
            return {"dir": lk.gold_dir(gold_root, GOLD_VERSION), "manifest": m}
        return self._once("gold", build)

    def landing(self) -> dict:
        return self._once("landing", lambda: run_export(
            self.spark, trips_stored(self.raw("day")), self.root, HOLDOUT_START, HOLDOUT_END, stage=False, dealt=True))

    def live(self) -> str:
        """A landing as daily arrivals leave it: some outcomes a day late, some not there, some trips without a key."""
        root = f"{self.root}/live"

        def build():
            trips = trips_stored(keyless(time_window(self.raw("day"), HOLDOUT_START, HOLDOUT_END)))
            has_arrived, arrival = outcome_arrival()
            outcome = [F.col("unique_key"), F.col("tips"), F.col("trip_total"),
                       F.col("trip_end_timestamp").cast("string").alias("trip_end_timestamp")]
            day = F.to_date("trip_start_timestamp")
            write_landings(utc_wall_times(trips), root, {
                REQUESTS_FOLDER: (json_line(request_fields(trips)), day),
                OUTCOMES_FOLDER: (F.when(has_arrived, json_line(outcome)), arrival)}, None)
            for folder in (REQUESTS_FOLDER, OUTCOMES_FOLDER):
                stamp_arrival(self.spark, lk.landing_root(root, folder))
            return root
        return self._once("live", build)


_LAKES: dict[tuple[str, str], _Lake] = {}
_LAKES_LOCK = threading.Lock()


def lake_for(spark: SparkSession, sf_dir: str) -> _Lake:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LAKES_LOCK:
        if key not in _LAKES:
            _LAKES[key] = _Lake(spark, sf_dir)
        return _LAKES[key]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_raw(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_frames(_raw(spark, sf_dir))[0]


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written silver run, split: its cut days and its rows come from one clean and dedupe."""
    silver = read_silver_run(spark, lake_for(spark, sf_dir).silver_run()["silver"])
    v, t = cut_dates(silver)
    return assign_split(silver, v, t)


def _problems_text(c: str = "problems") -> F.Column:
    return F.array_join(F.col(c), ",").alias("problems")


def _date_text(c: str = EVENT_DATE) -> F.Column:
    return F.col(c).cast("string").alias(c)


# ------------------------------------------------------------- queries ----
def q_scan_historical(spark, sf):
    return read_historical(spark, _raw(spark, sf), SCAN_START, SCAN_END)


def q_scan_historical_zoned(spark, sf):
    """The same window over a table whose start times are instants."""
    zoned = _raw(spark, sf).withColumn("trip_start_timestamp", F.concat(
        F.col("trip_start_timestamp").cast("string"), F.lit("+00:00")).cast("timestamp"))
    return read_historical(spark, zoned, SCAN_START, SCAN_END)


def q_scope_filter(spark, sf):
    return in_scope(_raw(spark, sf))


def q_validate_flags(spark, sf):
    rows = rule_flags(in_scope(_raw(spark, sf)))
    return rows.select("unique_key", "missing_start_ts", "bad_duration", "bad_distance",
                       "bad_fare", "bad_tips", "bad_pickup_area")


def q_problems_per_row(spark, sf):
    return flag(_raw(spark, sf)).select("unique_key", _problems_text())


def q_problem_counts(spark, sf):
    return problem_counts(flag(_raw(spark, sf)))


def q_route_counts(spark, sf):
    return route_counts(_raw(spark, sf))


def q_reject_records(spark, sf):
    rej = reject_records(flag(_raw(spark, sf)), raw_columns=RAW_COLUMNS)
    return rej.select("unique_key", _problems_text(), F.to_json("raw").alias("raw"))


def q_clean_rows(spark, sf):
    return clean_projection(valid_rows(flag(_raw(spark, sf))))


def q_dedupe(spark, sf):
    return _silver(spark, sf)


def q_silver_roundtrip(spark, sf):
    return read_silver_run(spark, lake_for(spark, sf).silver_run()["silver"])


def q_silver_scan(spark, sf):
    lake = lake_for(spark, sf)
    run = lake.window_run()
    table = read_silver_table(spark, f"{lake.root}/silver/{HISTORICAL_DATASET}")
    return table.where(F.col("run_id") == run["run_id"]).select(*SILVER_COLUMNS)


def q_list_runs(spark, sf):
    lake = lake_for(spark, sf)
    lake.silver_run(), lake.window_run()
    return list_runs(spark, lk.silver_root(lake.root, HISTORICAL_DATASET), with_counts=True)


def q_committed_runs(spark, sf):
    """Rows of the silver table by run, while another run of the dataset is half written."""
    lake = lake_for(spark, sf)
    lake.silver_run(), lake.window_run(), lake.half_written_run()
    table = read_silver_table(spark, lk.silver_root(lake.root, HISTORICAL_DATASET))
    return table.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))


def q_catalog_runs(spark, sf):
    """The runs that the session catalog lists, each with its rows by way of the table."""
    table = lake_for(spark, sf).runs_table()
    n = spark.table(table).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return catalog_runs(spark, table).join(n, "run_id")


def q_catalog_silver(spark, sf):
    """One run's rows by way of the catalog table."""
    lake = lake_for(spark, sf)
    return silver_of_runs(spark, lake.runs_table(), lake.window_run()["run_id"]).select(*SILVER_COLUMNS)


def q_clean_job_counts(spark, sf):
    counts = lake_for(spark, sf).silver_run()["counts"]
    schema = "input_rows bigint, filtered_rows bigint, rejected_rows bigint, valid_rows bigint"
    return spark.createDataFrame([tuple(int(counts[c]) for c in
                                        ("input_rows", "filtered_rows", "rejected_rows", "valid_rows"))], schema)


def q_rejects_roundtrip(spark, sf):
    rej = read_rejects(spark, lake_for(spark, sf).silver_run()["rejected"])
    return rej.select("unique_key", _problems_text(), F.size("raw").cast("int").alias("n_raw_fields"))


def q_holdout_window(spark, sf):
    return stage_holdout(spark, trips_stored(_raw(spark, sf)), HOLDOUT_START, HOLDOUT_END,
                         lk.scratch_dir(spark, "holdout"))


def q_holdout_requests(spark, sf):
    recs = request_records(time_window(trips_stored(_raw(spark, sf)), HOLDOUT_START, HOLDOUT_END))
    return recs.select(*[c for c in recs.columns if c != EVENT_DATE], _date_text())


def q_export_requests(spark, sf):
    lake = lake_for(spark, sf)
    lake.landing()
    req = read_landing(spark, lake.root, REQUESTS_FOLDER, HOLDOUT_START, HOLDOUT_END, REQUEST_SCHEMA)
    return conform_raw(req, keep=[EVENT_DATE]).withColumn(EVENT_DATE, F.col(EVENT_DATE).cast("string"))


def q_export_outcomes(spark, sf):
    lake = lake_for(spark, sf)
    lake.landing()
    out = read_landing(spark, lake.root, OUTCOMES_FOLDER, HOLDOUT_START, HOLDOUT_END, OUTCOME_SCHEMA)
    s = T.StringType()
    return out.select(
        "unique_key",
        to_double(F.col("tips"), s).alias("tips"),
        to_double(F.col("trip_total"), s).alias("trip_total"),
        to_naive_ts(F.col("trip_end_timestamp"), s).alias("trip_end_timestamp"),
        _date_text())


def q_landing_day_scan(spark, sf):
    lake = lake_for(spark, sf)
    lake.landing()
    req = read_landing(spark, lake.root, REQUESTS_FOLDER, DAY_SCAN_START, DAY_SCAN_END, REQUEST_SCHEMA)
    return req.groupBy(_date_text()).agg(F.count(F.lit(1)).alias("n_requests"))


def q_live_join(spark, sf):
    return read_live(spark, lake_for(spark, sf).live(), HOLDOUT_START, LIVE_END)


def q_live_raw(spark, sf):
    """The live reader with null-safe key pairing (group-by-key semantics)."""
    return read_live(spark, lake_for(spark, sf).live(), HOLDOUT_START, LIVE_END, null_safe=True)


def q_live_silver(spark, sf):
    return clean_frames(read_live(spark, lake_for(spark, sf).live(), HOLDOUT_START, LIVE_END))[0]


def q_pending_requests(spark, sf):
    pending = read_pending(spark, lake_for(spark, sf).live(), HOLDOUT_START, LIVE_END)
    return pending.select(*[c for c in RAW_COLUMNS if c != "tips"])


def q_live_bad_lines(spark, sf):
    """Silver keys and all rejects of a live run over a landing with broken lines; every line of it is in one of them or joined."""
    lake = lake_for(spark, sf)
    joined, bad = read_live_and_bad_lines(spark, lake.broken_live(), HOLDOUT_START, LIVE_END)
    run = run_clean(spark, joined, lk.scratch_dir(spark, "bad-lines"), LIVE_DATASET, HOLDOUT_START, LIVE_END, RUN_TS,
                    materialize="stage", more_rejects=bad)
    silver = read_silver_run(spark, run["silver"]).select(
        F.lit("silver").alias("kind"), "unique_key", F.lit("").alias("problems"), F.lit(None).cast("string").alias("line"))
    rejects = read_rejects(spark, run["rejected"]).select(
        F.lit("rejected").alias("kind"), "unique_key", _problems_text(), F.col("raw")["line"].alias("line"))
    return silver.unionByName(rejects)


def q_live_increments(spark, sf):
    """Silver rows of all incremental live runs, with the end of the window of the run that added each."""
    root = lk.silver_root(lake_for(spark, sf).increments(), LIVE_DATASET)
    return read_silver_table(spark, root).select(*SILVER_COLUMNS, F.split("run_id", "_")[1].alias("run_end"))


def q_live_increments_pending(spark, sf):
    """Requests that the last incremental run leaves open."""
    return read_open_requests(spark, lake_for(spark, sf).increments())


def _through_source(spark, sf, name: str) -> DataFrame:
    """The silver run that the clean job writes for a source by name."""
    lake = lake_for(spark, sf)
    reader, dataset, mode = SOURCES[name]
    start, end = (SCAN_START, SCAN_END) if name == "historical" else (HOLDOUT_START, LIVE_END)
    raw = reader(spark, raw=lake.raw(), out_lake=lake.live() if name == "live" else lake.root, start=start, end=end)
    run = run_clean(spark, raw, lk.scratch_dir(spark, f"source-{name}"), dataset, start, end, run_ts=RUN_TS, materialize=mode)
    return read_silver_run(spark, run["silver"])


def q_source_historical(spark, sf):
    return _through_source(spark, sf, "historical")


def q_source_live(spark, sf):
    return _through_source(spark, sf, "live")


def q_split_cut_dates(spark, sf):
    cuts = cut_days_frame(_silver(spark, sf))
    return cuts.select(F.col("val_start").cast("string").alias("val_start"),
                       F.col("test_start").cast("string").alias("test_start"))


def q_split_cut_dates_approx(spark, sf):
    """Whether the sketch's cuts lie within 0.001 of the ranks asked for."""
    return approx_rank_errors(_silver(spark, sf))


def q_split_cut_dates_sketch(spark, sf):
    """Whether cuts from the merged sketches of two runs lie within 0.001 of the ranks in both runs' rows."""
    lake = lake_for(spark, sf)
    ids = lake.silver_run()["run_id"], lake.window_run()["run_id"]
    root = lk.silver_root(lake.root, HISTORICAL_DATASET)
    return within_error(sketch_rank_errors(read_silver_table(spark, root, *ids), start_sketches(spark, root, *ids)))


def q_duplicates_across_runs(spark, sf):
    """Keys that occur in more than one run, from the runs' bucketed keys."""
    lake = lake_for(spark, sf)
    lake.silver_run(), lake.window_run()
    table = f"run_keys_{uuid.uuid4().hex[:12]}"
    add_run_keys(spark, table, lk.scratch_dir(spark, "run-keys"), lk.silver_root(lake.root, HISTORICAL_DATASET), BUCKETS)
    return keys_in_several_runs(spark.table(table))


def q_bucketed_join(spark, sf):
    """Requests with their outcomes, both laid out in buckets of the key."""
    return join_outcomes(*lake_for(spark, sf).bucketed())


def q_bucketed_pending(spark, sf):
    return pending_requests(*lake_for(spark, sf).bucketed()).select(*[c for c in RAW_COLUMNS if c != "tips"])


def q_split_assign(spark, sf):
    return _split(spark, sf).select("unique_key", "trip_start_ts", "split")


def q_features(spark, sf):
    return build_features(_silver(spark, sf), keep=ID_COLUMNS)


def q_label(spark, sf):
    return _silver(spark, sf).select("unique_key", label_column())


def q_gold_rows(spark, sf):
    return to_gold(_split(spark, sf))


def q_gold_roundtrip(spark, sf):
    return read_gold(spark, lake_for(spark, sf).gold()["dir"])


def q_split_summary(spark, sf):
    return split_summary(to_gold(_split(spark, sf)))


MANIFEST_SPLITS = T.StructType([T.StructField("splits", T.MapType(T.StringType(), T.StructType([
    T.StructField("rows", T.LongType()), T.StructField("label_rate", T.DoubleType()),
    T.StructField("first_trip", T.StringType()), T.StructField("last_trip", T.StringType())])))])


def q_manifest_splits(spark, sf):
    path = f"{lake_for(spark, sf).gold()['dir']}/{MANIFEST_NAME}"
    text = spark.createDataFrame([(lk.read_text(spark, path),)], "manifest string")
    m = text.select(F.from_json("manifest", MANIFEST_SPLITS).alias("m"))
    e = m.select(F.explode("m.splits").alias("split", "s"))
    return e.select("split", "s.rows", "s.label_rate", "s.first_trip", "s.last_trip")


def q_profile_extent(spark, sf):
    return profiles.extent(_raw(spark, sf))


def q_profile_payment(spark, sf):
    return profiles.payment_mix(_raw(spark, sf))


def q_profile_dirtiness(spark, sf):
    return profiles.dirtiness(_raw(spark, sf))


def q_profile_tip_hist(spark, sf):
    return profiles.tip_histogram(_raw(spark, sf))


def _silver_table(spark, sf) -> tuple[DataFrame, str]:
    lake = lake_for(spark, sf)
    run = lake.silver_run()
    return read_silver_table(spark, f"{lake.root}/silver/{HISTORICAL_DATASET}"), run["run_id"]


def q_check_unique(spark, sf):
    table, run_id = _silver_table(spark, sf)
    return checks.uniqueness(table, run_id)


def q_check_nulls(spark, sf):
    table, run_id = _silver_table(spark, sf)
    return checks.nulls(table, run_id)


def q_check_date_range(spark, sf):
    lake = lake_for(spark, sf)
    run = lake.window_run()
    table = read_silver_table(spark, f"{lake.root}/silver/{HISTORICAL_DATASET}")
    return checks.date_range(table, SCAN_START, SCAN_END, run["run_id"])


def q_check_all(spark, sf):
    lake = lake_for(spark, sf)
    run = lake.window_run()
    table = read_silver_table(spark, f"{lake.root}/silver/{HISTORICAL_DATASET}")
    return checks.all_checks(table, run["run_id"], SCAN_START, SCAN_END)


# The dirty strings of FIXTURES.md section 4, as (key, number text,
# timestamp text, company text); their expected parses live only in the oracle.
DIRTY_STRINGS = [
    ("dirty-01", "", "2022-04-01 08:30:00 UTC", " Flash Cab "),
    ("dirty-02", None, "2022-04-01T08:30:00Z", "\tA\n"),
    ("dirty-03", "abc", "2022-04-01 08:30:00+05:00", ""),
    ("dirty-04", "12.0", "2022", "  "),
    ("dirty-05", "12.7", "2022-1-1", None),
    ("dirty-06", "-0.5", "2022-13-01", " Flash Cab "),
    ("dirty-07", " 5 ", "", " Flash Cab "),
    ("dirty-08", "1e3", None, " Flash Cab "),
    ("dirty-09", "nan", "2022-04-01 08:30:00 UTC", " Flash Cab "),
    ("dirty-10", "5d", "2022-04-01 08:30:00 UTC", " Flash Cab "),
    ("dirty-11", "1_000", "2022-04-01 08:30:00 UTC", " Flash Cab "),
    # further ISO spellings, and two that are not read (week and ordinal dates)
    ("iso-01", "1", "20220401", "x"),
    ("iso-02", "1", "2022-04-01T08", "x"),
    ("iso-03", "1", "20220401T083000", "x"),
    ("iso-04", "1", "2022-04-01 08:30:00.1234567", "x"),
    ("iso-05", "1", "2022-04-01 08:30:00,5Z", "x"),
    ("iso-06", "1", "2022-W13-5", "x"),
    ("iso-07", "1", "2022-091", "x"),
]


def q_coerce_strings(spark, sf):
    """Raw values rendered as text (timestamps in warehouse export form) and parsed back,
    plus the dirty strings of FIXTURES.md section 4."""
    from triplake.sources.sinks import warehouse_ts_text
    raw = _raw(spark, sf)
    text = raw.select(
        "unique_key",
        F.col("trip_seconds").cast("string").alias("s_seconds"),
        F.col("trip_miles").cast("string").alias("s_miles"),
        F.col("pickup_community_area").cast("string").alias("s_pickup"),
        warehouse_ts_text(F.col("trip_start_timestamp")).alias("s_start"),
        F.col("company"))
    dirty = spark.createDataFrame(
        [(k, n, n, n, t, c) for k, n, t, c in DIRTY_STRINGS],
        "unique_key string, s_seconds string, s_miles string, s_pickup string, s_start string, company string")
    text = text.unionByName(dirty)
    s = T.StringType()
    return text.select(
        "unique_key",
        to_double(F.col("s_seconds"), s).alias("seconds_double"),
        to_bigint(F.col("s_seconds"), s).alias("seconds_bigint"),
        to_double(F.col("s_miles"), s).alias("miles_double"),
        to_bigint(F.col("s_pickup"), s).alias("pickup_bigint"),
        to_naive_ts(F.col("s_start"), s).alias("start_ts"),
        default_strip(F.col("company"), DEFAULT_COMPANY).alias("company"))


def q_check_job(spark, sf):
    """The check job over a run without a window."""
    lake = lake_for(spark, sf)
    run = lake.silver_run()
    return run_all_checks(spark, f"{lake.root}/silver/{HISTORICAL_DATASET}", run["run_id"])


def q_profile_job(spark, sf):
    """The profile job's frames over a window, one row each value."""
    frames = run_profile(_raw(spark, sf), SCAN_START, SCAN_END)
    out = None
    for name in ("payment", "dirtiness", "tip_histogram"):
        df = frames[name].select(F.lit(name).alias("profile"), F.to_json(
            F.struct(*[F.col(c).cast("string").alias(c) for c in frames[name].columns]),
            {"ignoreNullFields": "false"}).alias("row"))
        out = df if out is None else out.unionByName(df)
    return out


def _stream_options(spark, files_per_batch: int = 900) -> dict:
    # several micro-batches: the landing has a file for each of some 2,500 days
    return {"partitions": spark.sparkContext.defaultParallelism, "files_per_batch": files_per_batch}


def _state_options(spark) -> dict:
    # the state holds the days of two micro-batches
    return _stream_options(spark, 300)


def q_stream_dedupe(spark, sf):
    return run_stream_firsts(spark, lake_for(spark, sf).live(), lk.scratch_dir(spark, "stream-dedupe"), "requests",
                             HOLDOUT_START, LIVE_END, **_stream_options(spark))


def q_stream_live_join(spark, sf):
    return run_stream_join(spark, lake_for(spark, sf).live(), lk.scratch_dir(spark, "stream-join"),
                           HOLDOUT_START, LIVE_END, **_stream_options(spark))


def q_stream_keep_first(spark, sf):
    """First request per key and day out of Spark's state store, as days settle."""
    out = lk.scratch_dir(spark, "stream-keep-first")
    run_keep_first(spark, lake_for(spark, sf).live(), out, HOLDOUT_START, **_state_options(spark))
    # days before the last ones, which settle with the next that land
    return in_window(read_settled(spark, out), None, LIVE_END).select(*REQUEST_COLUMNS, _date_text())


def q_stream_outer_join(spark, sf):
    """Requests with their outcomes, or as pending once their grace ran out, out of Spark's state store."""
    rows = settled(in_window(read_settled(spark, lake_for(spark, sf).outer_join()), None, LIVE_END))
    return rows.select(*REQUEST_COLUMNS, _date_text(), "tips", _date_text("outcome_date"), "status")


def q_stream_route_counts(spark, sf):
    """Route counts observed on the stream of matched trips, summed over its micro-batches, and whether the rows written agree."""
    batches = run_stream_route(spark, lake_for(spark, sf).outer_join(), lk.scratch_dir(spark, "stream-route"), LIVE_END,
                               partitions=spark.sparkContext.defaultParallelism, files_per_batch=8)
    return batches.agg(*[F.sum(c).alias(c) for c in ("input_rows", "filtered_rows", "rejected_rows", "valid_rows")],
                       F.every("agrees").alias("agrees"))


def q_stream_clean(spark, sf):
    out = run_stream_clean(spark, lake_for(spark, sf).live(), lk.scratch_dir(spark, "stream-clean-out"),
                           HOLDOUT_START, LIVE_END, RUN_TS, **_stream_options(spark))
    return read_silver_run(spark, out["silver"])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
