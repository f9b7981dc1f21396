"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement re-derives its answer from the base tables with plain SQL,
independently of the Spark code.  Building blocks are CTEs; unreferenced
ones cost nothing.
"""

from __future__ import annotations

from triplake.sources.fixture import TRIPS_RAW_SQL, TRIPS_STORED_SQL

# Fixed parameters shared with the Spark side (triplake.catalog.queries).
SCAN_START, SCAN_END = "1996-01-01", "2001-01-01"
HOLDOUT_START, HOLDOUT_END = "1995-01-01", "2002-01-01"
LIVE_END = "2001-01-01"  # of the live readers' window, within the data
LIVE_CUTS = ("1997-03-01", "1999-01-01", LIVE_END)  # ends of the incremental live runs
DAY_SCAN_START, DAY_SCAN_END = "1998-01-01", "1999-01-01"


def _ts(d: str) -> str:
    return f"TIMESTAMP '{d} 00:00:00'"


PROBLEM_FLAGS = """trip_start_timestamp IS NULL AS p1,
  NOT coalesce(trip_seconds BETWEEN 60 AND 14400, false) AS p2,
  NOT coalesce(trip_miles BETWEEN 1e-1 AND 1e2, false) AS p3,
  NOT coalesce(fare BETWEEN 3.25e0 AND 5e2, false) AS p4,
  NOT coalesce(tips >= 0, false) AS p5,
  NOT coalesce(pickup_community_area BETWEEN 1 AND 77, false) AS p6"""

PROBLEM_LIST = """concat_ws(',', CASE WHEN p1 THEN 'missing_start_ts' END, CASE WHEN p2 THEN 'bad_duration' END,
  CASE WHEN p3 THEN 'bad_distance' END, CASE WHEN p4 THEN 'bad_fare' END,
  CASE WHEN p5 THEN 'bad_tips' END, CASE WHEN p6 THEN 'bad_pickup_area' END)"""

SILVER_COLS = ("unique_key, taxi_id, trip_start_ts, trip_seconds, trip_miles, fare, tips, "
               "pickup_community_area, dropoff_community_area, tolls, extras, company")
SILVER_ORDER = ("trip_start_ts NULLS FIRST, taxi_id NULLS FIRST, trip_seconds NULLS FIRST, "
                "trip_miles NULLS FIRST, fare NULLS FIRST, tips NULLS FIRST, "
                "pickup_community_area NULLS FIRST, dropoff_community_area NULLS FIRST, "
                "tolls NULLS FIRST, extras NULLS FIRST, company NULLS FIRST")
REQUEST_COLS = ("unique_key, taxi_id, trip_start_timestamp, trip_seconds, trip_miles, "
                "pickup_community_area, dropoff_community_area, fare, tolls, extras, payment_type, company")
REQUEST_ORDER = ("trip_start_timestamp NULLS FIRST, taxi_id NULLS FIRST, trip_seconds NULLS FIRST, "
                 "trip_miles NULLS FIRST, pickup_community_area NULLS FIRST, "
                 "dropoff_community_area NULLS FIRST, fare NULLS FIRST, tolls NULLS FIRST, "
                 "extras NULLS FIRST, payment_type NULLS FIRST, company NULLS FIRST")
RAW_COLS = ("unique_key, taxi_id, trip_start_timestamp, trip_seconds, trip_miles, pickup_community_area, "
            "dropoff_community_area, fare, tips, tolls, extras, payment_type, company")

FEATURES = """CAST(hour(trip_start_ts) AS BIGINT) AS hour,
  CAST(isodow(trip_start_ts) - 1 AS BIGINT) AS day_of_week,
  CAST(CASE WHEN isodow(trip_start_ts) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
  trip_miles,
  trip_seconds / 60e0 AS trip_minutes,
  CASE WHEN trip_seconds / 3600e0 > 0 THEN trip_miles / (trip_seconds / 3600e0) ELSE 0e0 END AS avg_speed_mph,
  fare,
  CASE WHEN trip_miles > 0 THEN fare / trip_miles ELSE 0e0 END AS fare_per_mile,
  coalesce(extras, 0e0) AS extras,
  coalesce(tolls, 0e0) AS tolls,
  CAST(CASE WHEN coalesce(extras, 0e0) > 0 THEN 1 ELSE 0 END AS BIGINT) AS has_extras,
  CAST(coalesce(pickup_community_area, -1) AS BIGINT) AS pickup_area,
  CAST(coalesce(dropoff_community_area, -1) AS BIGINT) AS dropoff_area,
  CAST(CASE WHEN coalesce(pickup_community_area, -1) IN (56, 76)
             OR coalesce(dropoff_community_area, -1) IN (56, 76) THEN 1 ELSE 0 END AS BIGINT) AS is_airport,
  CAST(CASE WHEN coalesce(pickup_community_area, -1) IN (8, 32, 33)
             OR coalesce(dropoff_community_area, -1) IN (8, 32, 33) THEN 1 ELSE 0 END AS BIGINT) AS is_downtown,
  CAST(CASE WHEN coalesce(pickup_community_area, -1) = coalesce(dropoff_community_area, -1)
             AND coalesce(pickup_community_area, -1) <> -1 THEN 1 ELSE 0 END AS BIGINT) AS same_area,
  trim(coalesce(company, 'unknown')) AS company"""

LABEL = """CAST(CASE WHEN fare = 0 THEN (CASE WHEN tips > 0 THEN 1 ELSE 0 END)
            WHEN tips / fare > 2e-1 THEN 1 ELSE 0 END AS BIGINT) AS label"""


def _run_end(day: str, days_more: int = 0) -> str:
    """The end of the incremental run that reads a day (outcomes: up to days more)."""
    cuts = " ".join(f"WHEN {day} < DATE '{d}' + {days_more} THEN '{d}'" for d in LIVE_CUTS)
    return f"CASE {cuts} END"


def clean_ctes(src: str, p: str) -> str:
    """card / flagged / clean / silver / cuts / split / gold CTEs over ``src``, prefixed ``p``."""
    return f""",
{p}card AS (SELECT * FROM {src} WHERE coalesce(payment_type = 'Credit Card', false)),
{p}flagged AS (SELECT *, {PROBLEM_FLAGS} FROM {p}card),
{p}clean AS (SELECT unique_key, coalesce(nullif(taxi_id, ''), 'unknown') AS taxi_id,
  trip_start_timestamp AS trip_start_ts, trip_seconds, trip_miles, fare, tips,
  pickup_community_area, dropoff_community_area, coalesce(tolls, 0e0) AS tolls,
  coalesce(extras, 0e0) AS extras, trim(coalesce(nullif(company, ''), 'Unknown')) AS company
  FROM {p}flagged WHERE NOT (p1 OR p2 OR p3 OR p4 OR p5 OR p6)),
{p}silver AS (SELECT {SILVER_COLS} FROM (SELECT *, row_number() OVER (
  PARTITION BY unique_key ORDER BY {SILVER_ORDER}) AS rn FROM {p}clean) WHERE rn = 1),
{p}cuts AS (SELECT CAST(percentile_disc(0.8) WITHIN GROUP (ORDER BY trip_start_ts) AS DATE) AS val_start,
  CAST(percentile_disc(0.9) WITHIN GROUP (ORDER BY trip_start_ts) AS DATE) AS test_start FROM {p}silver),
{p}split AS (SELECT s.*,
  CASE WHEN trip_start_ts < (SELECT CAST(val_start AS TIMESTAMP) FROM {p}cuts) THEN 'train'
       WHEN trip_start_ts < (SELECT CAST(test_start AS TIMESTAMP) FROM {p}cuts) THEN 'val'
       ELSE 'test' END AS split
  FROM {p}silver s),
{p}gold AS (SELECT unique_key, trip_start_ts, split, {FEATURES}, {LABEL} FROM {p}split)"""


BASE = f"""WITH raw AS ({TRIPS_RAW_SQL}){clean_ctes('raw', '')},
stored AS ({TRIPS_STORED_SQL}),
holdout AS (SELECT * FROM stored WHERE trip_start_timestamp >= {_ts(HOLDOUT_START)}
  AND trip_start_timestamp < {_ts(HOLDOUT_END)}),
trips AS (SELECT * REPLACE (CASE WHEN taxi_id IS NOT NULL THEN unique_key END AS unique_key) FROM holdout),
landed AS (SELECT * FROM trips WHERE trip_start_timestamp < {_ts(LIVE_END)}),
req AS (SELECT {REQUEST_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY unique_key
  ORDER BY {REQUEST_ORDER}) AS rn FROM landed) WHERE rn = 1),
outc AS (SELECT unique_key, tips FROM (SELECT unique_key, tips, row_number() OVER (PARTITION BY unique_key
  ORDER BY tips NULLS FIRST) AS rn FROM trips WHERE coalesce(dropoff_community_area % 7 <> 3, true)
  AND CAST(trip_start_timestamp AS DATE) + CAST(coalesce(pickup_community_area % 2 = 1, false) AS INT)
    < DATE '{LIVE_END}' + 1) WHERE rn = 1),
live AS (SELECT req.unique_key, taxi_id, trip_start_timestamp, trip_seconds, trip_miles,
  pickup_community_area, dropoff_community_area, fare, outc.tips AS tips, tolls, extras, payment_type, company
  FROM req JOIN outc ON req.unique_key = outc.unique_key){clean_ctes('live', 'live_')},
day_req AS (SELECT *, CAST(trip_start_timestamp AS DATE) AS day, row_number() OVER () AS row,
  row_number() OVER (PARTITION BY unique_key, CAST(trip_start_timestamp AS DATE) ORDER BY {REQUEST_ORDER}) AS rn FROM landed),
arrivals AS (SELECT unique_key, tips, CAST(trip_start_timestamp AS DATE)
    + CAST(coalesce(pickup_community_area % 2 = 1, false) AS INT) AS arrived
  FROM trips WHERE coalesce(dropoff_community_area % 7 <> 3, true)),
inc_out AS (SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY run_end, tips NULLS FIRST) AS rn FROM (
  SELECT unique_key, tips, {_run_end('arrived', 1)} AS run_end FROM arrivals) WHERE run_end IS NOT NULL AND unique_key IS NOT NULL),
inc AS (SELECT req.*, o.tips, greatest(o.run_end, {_run_end('CAST(trip_start_timestamp AS DATE)')}) AS run_end
  FROM req JOIN inc_out o ON req.unique_key = o.unique_key AND o.rn = 1){clean_ctes('inc', 'inc_')},
broken AS (SELECT *, coalesce(trip_miles % 21e0 < 1e-1, false) AS cut FROM trips),
b_req AS (SELECT {REQUEST_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY unique_key ORDER BY {REQUEST_ORDER}) AS rn
  FROM broken WHERE NOT cut AND trip_start_timestamp < {_ts(LIVE_END)}) WHERE rn = 1),
b_out AS (SELECT unique_key, min(tips) AS tips FROM broken WHERE NOT cut
  AND date_trunc('month', trip_start_timestamp) < DATE '{LIVE_END}' + 1 GROUP BY unique_key),
b_live AS (SELECT r.* EXCLUDE (taxi_id), taxi_id, o.tips FROM b_req r JOIN b_out o ON r.unique_key = o.unique_key){clean_ctes('b_live', 'b_')},
sm AS (SELECT {', '.join('r.' + c.strip() for c in REQUEST_COLS.split(','))}, o.tips FROM day_req r JOIN (
    SELECT unique_key, arrived, min(tips) AS tips FROM arrivals GROUP BY unique_key, arrived) o
  ON r.rn = 1 AND r.unique_key = o.unique_key AND o.arrived BETWEEN r.day AND r.day + 1){clean_ctes('sm', 'sm_')},
windowed AS (SELECT * FROM raw WHERE trip_start_timestamp >= {_ts(SCAN_START)}
  AND trip_start_timestamp < {_ts(SCAN_END)}){clean_ctes('windowed', 'win_')}
"""


def warehouse_ts_text(c: str) -> str:
    return f"CAST({c} AS VARCHAR) || ' UTC'"


RUNS = """SELECT 'open_open_20260101-000000' AS run_id, count(*) AS n_rows FROM silver
    UNION ALL SELECT '1996-01-01_2001-01-01_20260101-000000', count(*) FROM win_silver"""

SUMMARY = """SELECT split, count(*) AS rows, round(avg(label), 4) AS label_rate,
  min(trip_start_ts) AS first_trip, max(trip_start_ts) AS last_trip FROM gold GROUP BY split"""

PENDING = f"""SELECT {REQUEST_COLS} FROM req WHERE unique_key IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM outc WHERE outc.unique_key = req.unique_key)
        UNION ALL SELECT {REQUEST_COLS} FROM landed WHERE unique_key IS NULL"""

QUERIES_SQL: dict[str, str] = {
    "scan_historical": f"SELECT {RAW_COLS} FROM raw WHERE trip_start_timestamp >= {_ts(SCAN_START)} "
                       f"AND trip_start_timestamp < {_ts(SCAN_END)}",
    "scan_historical_zoned": f"SELECT {RAW_COLS} FROM raw WHERE trip_start_timestamp >= {_ts(SCAN_START)} "
                             f"AND trip_start_timestamp < {_ts(SCAN_END)}",
    "scope_filter": f"SELECT {RAW_COLS} FROM card",
    "validate_flags": """SELECT unique_key, p1 AS missing_start_ts, p2 AS bad_duration, p3 AS bad_distance,
        p4 AS bad_fare, p5 AS bad_tips, p6 AS bad_pickup_area FROM flagged""",
    "problems_per_row": f"SELECT unique_key, {PROBLEM_LIST} AS problems FROM flagged",
    "problem_counts": """SELECT problem, n_rows FROM (
        SELECT 'missing_start_ts' AS problem, count_if(p1) AS n_rows FROM flagged UNION ALL
        SELECT 'bad_duration', count_if(p2) FROM flagged UNION ALL
        SELECT 'bad_distance', count_if(p3) FROM flagged UNION ALL
        SELECT 'bad_fare', count_if(p4) FROM flagged UNION ALL
        SELECT 'bad_tips', count_if(p5) FROM flagged UNION ALL
        SELECT 'bad_pickup_area', count_if(p6) FROM flagged) WHERE n_rows > 0""",
    "route_counts": """SELECT count(*) AS input_rows,
        count_if(NOT coalesce(payment_type = 'Credit Card', false)) AS filtered_rows,
        (SELECT count(*) FROM flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6) AS rejected_rows,
        (SELECT count(*) FROM clean) AS valid_rows FROM raw""",
    "reject_records": f"""SELECT unique_key, {PROBLEM_LIST} AS problems,
        to_json(map(['unique_key','taxi_id','trip_start_timestamp','trip_seconds','trip_miles',
          'pickup_community_area','dropoff_community_area','fare','tips','tolls','extras','payment_type','company'],
          [unique_key, taxi_id, CAST(trip_start_timestamp AS VARCHAR), CAST(trip_seconds AS VARCHAR),
           CAST(trip_miles AS VARCHAR), CAST(pickup_community_area AS VARCHAR),
           CAST(dropoff_community_area AS VARCHAR), CAST(fare AS VARCHAR), CAST(tips AS VARCHAR),
           CAST(tolls AS VARCHAR), CAST(extras AS VARCHAR), payment_type, company])) AS raw
        FROM flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6""",
    "clean_rows": f"SELECT {SILVER_COLS} FROM clean",
    "dedupe": f"SELECT {SILVER_COLS} FROM silver",
    "silver_roundtrip": f"SELECT {SILVER_COLS} FROM silver",
    "silver_scan": f"SELECT {SILVER_COLS} FROM win_silver",
    "list_runs": RUNS,
    "committed_runs": RUNS,
    "catalog_runs": RUNS,
    "catalog_silver": f"SELECT {SILVER_COLS} FROM win_silver",
    "clean_job_counts": """SELECT count(*) AS input_rows,
        count_if(NOT coalesce(payment_type = 'Credit Card', false)) AS filtered_rows,
        (SELECT count(*) FROM flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6) AS rejected_rows,
        (SELECT count(*) FROM clean) AS valid_rows FROM raw""",
    "rejects_roundtrip": f"SELECT unique_key, {PROBLEM_LIST} AS problems, "
                         "13 AS n_raw_fields FROM flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6",
    "holdout_window": "SELECT * FROM holdout",
    "holdout_requests": f"""SELECT unique_key, taxi_id, {warehouse_ts_text('trip_start_timestamp')} AS trip_start_timestamp,
        CAST(trip_seconds AS VARCHAR) AS trip_seconds, trip_miles,
        CAST(pickup_community_area AS VARCHAR) AS pickup_community_area,
        CAST(dropoff_community_area AS VARCHAR) AS dropoff_community_area, fare, tolls, extras,
        payment_type, company, {warehouse_ts_text('trip_end_timestamp')} AS trip_end_timestamp, pickup_census_tract,
        CAST(CAST(trip_start_timestamp AS DATE) AS VARCHAR) AS event_date FROM holdout""",
    "export_requests": f"""SELECT unique_key, taxi_id, trip_start_timestamp, trip_seconds, trip_miles,
        pickup_community_area, dropoff_community_area, fare, CAST(NULL AS DOUBLE) AS tips, tolls, extras,
        payment_type, company, CAST(CAST(trip_start_timestamp AS DATE) AS VARCHAR) AS event_date FROM holdout""",
    "export_outcomes": """SELECT unique_key, tips, trip_total, trip_end_timestamp,
        CAST(CAST(trip_start_timestamp AS DATE) AS VARCHAR) AS event_date FROM holdout""",
    "landing_day_scan": f"""SELECT CAST(CAST(trip_start_timestamp AS DATE) AS VARCHAR) AS event_date,
        count(*) AS n_requests FROM holdout WHERE trip_start_timestamp >= {_ts(DAY_SCAN_START)}
        AND trip_start_timestamp < {_ts(DAY_SCAN_END)} GROUP BY 1""",
    "live_join": f"SELECT {RAW_COLS} FROM live",
    # null-safe pairing: also pairs a null-key request with a null-key outcome
    "live_raw": f"""SELECT req.unique_key, taxi_id, trip_start_timestamp, trip_seconds, trip_miles,
        pickup_community_area, dropoff_community_area, fare, outc.tips AS tips, tolls, extras, payment_type, company
        FROM req JOIN outc ON req.unique_key IS NOT DISTINCT FROM outc.unique_key""",
    "live_silver": f"SELECT {SILVER_COLS} FROM live_silver",
    "pending_requests": PENDING,
    "live_bad_lines": f"""SELECT 'silver' AS kind, unique_key, '' AS problems, CAST(NULL AS VARCHAR) AS line FROM b_silver
        UNION ALL SELECT 'rejected', unique_key, {PROBLEM_LIST}, NULL FROM b_flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6
        UNION ALL SELECT 'rejected', NULL, 'bad_line', '{{"cut":"' || coalesce(unique_key, '') FROM broken
          WHERE cut AND trip_start_timestamp < {_ts(LIVE_END)}
        UNION ALL SELECT 'rejected', NULL, 'bad_line', '{{"cut":"' || coalesce(unique_key, '') FROM broken
          WHERE cut AND date_trunc('month', trip_start_timestamp) < DATE '{LIVE_END}' + 1""",
    "live_increments": f"""SELECT {SILVER_COLS}, run_end FROM inc_silver JOIN (SELECT unique_key, run_end FROM inc)
        USING (unique_key)""",
    "live_increments_pending": PENDING,
    "source_historical": f"SELECT {SILVER_COLS} FROM win_silver",
    "source_live": f"SELECT {SILVER_COLS} FROM live_silver",
    "split_cut_dates": """SELECT CAST(val_start AS VARCHAR) AS val_start,
        CAST(test_start AS VARCHAR) AS test_start FROM cuts""",
    "split_assign": "SELECT unique_key, trip_start_ts, split FROM split",
    "features": f"SELECT unique_key, trip_start_ts, {FEATURES} FROM silver",
    "label": f"SELECT unique_key, {LABEL} FROM silver",
    "gold_rows": "SELECT * FROM gold",
    "gold_roundtrip": "SELECT * FROM gold",
    "split_summary": SUMMARY,
    "manifest_splits": """SELECT split, count(*) AS rows, round(avg(label), 4) AS label_rate,
        CAST(min(trip_start_ts) AS VARCHAR) AS first_trip, CAST(max(trip_start_ts) AS VARCHAR) AS last_trip
        FROM gold GROUP BY split""",
    "profile_extent": "SELECT min(trip_start_timestamp) AS first_trip, max(trip_start_timestamp) AS last_trip FROM raw",
    "profile_payment": """SELECT payment_type, count(*) AS trips, round(avg(tips), 2) AS avg_tip,
        round(count_if(tips > 0) / count(*), 3) AS share_with_tip FROM raw GROUP BY payment_type""",
    "profile_dirtiness": """SELECT count(*) AS total,
        count_if(trip_seconds IS NULL OR trip_seconds < 60) AS bad_duration,
        count_if(trip_miles IS NULL OR trip_miles < 1e-1) AS bad_distance,
        count_if(fare IS NULL OR fare <= 0) AS bad_fare,
        count_if(pickup_community_area IS NULL) AS no_pickup_area,
        count_if(dropoff_community_area IS NULL) AS no_dropoff_area,
        count(*) - count(DISTINCT unique_key) AS duplicates FROM raw""",
    # "+ 0e0" turns DuckDB's -0.0 bucket into 0.0 (equal values, one spelling).
    "profile_tip_hist": """SELECT round(tips / fare, 1) + 0e0 AS tip_pct_bucket, count(*) AS trips FROM raw
        WHERE payment_type = 'Credit Card' AND fare > 0 GROUP BY 1""",
    "check_unique": "SELECT count(*) AS n_rows, count(DISTINCT unique_key) AS n_keys FROM silver",
    "check_nulls": """SELECT count_if(trip_start_ts IS NULL) AS null_start, count_if(fare IS NULL) AS null_fare,
        count_if(tips IS NULL) AS null_tips FROM silver""",
    "check_date_range": f"""SELECT min(trip_start_ts) AS first_trip, max(trip_start_ts) AS last_trip,
        count_if(trip_start_ts < {_ts(SCAN_START)}) AS rows_before_start,
        count_if(trip_start_ts >= {_ts(SCAN_END)}) AS rows_after_end,
        count_if(trip_start_ts IS NULL) AS rows_without_start,
        count_if(trip_start_ts < {_ts(SCAN_START)}) + count_if(trip_start_ts >= {_ts(SCAN_END)})
          + count_if(trip_start_ts IS NULL) = 0 AS in_range FROM win_silver""",
    "check_all": f"""SELECT count(*) AS n_rows, count(DISTINCT unique_key) AS n_keys,
        count_if(trip_start_ts IS NULL) AS null_start, count_if(fare IS NULL) AS null_fare,
        count_if(tips IS NULL) AS null_tips, min(trip_start_ts) AS first_trip, max(trip_start_ts) AS last_trip,
        count_if(trip_start_ts < {_ts(SCAN_START)} OR trip_start_ts >= {_ts(SCAN_END)}) AS rows_outside_window
        FROM win_silver""",
    # FIXTURES.md section 4 expected values for the dirty strings (fixed values)
    "coerce_strings": """SELECT unique_key, CAST(trip_seconds AS DOUBLE) AS seconds_double,
        trip_seconds AS seconds_bigint, trip_miles AS miles_double,
        CAST(pickup_community_area AS BIGINT) AS pickup_bigint,
        trip_start_timestamp AS start_ts, trim(coalesce(nullif(company, ''), 'Unknown')) AS company
        FROM raw
        UNION ALL SELECT k, CAST(d AS DOUBLE), CAST(i AS BIGINT), CAST(d AS DOUBLE), CAST(i AS BIGINT),
          CAST(t AS TIMESTAMP), c FROM (VALUES
          ('dirty-01', NULL, NULL, '2022-04-01 08:30:00', 'Flash Cab'),
          ('dirty-02', NULL, NULL, '2022-04-01 08:30:00', 'A'),
          ('dirty-03', NULL, NULL, '2022-04-01 03:30:00', 'Unknown'),
          ('dirty-04', 12.0, 12, NULL, ''),
          ('dirty-05', 12.7, 12, NULL, 'Unknown'),
          ('dirty-06', -0.5, 0, NULL, 'Flash Cab'),
          ('dirty-07', 5.0, 5, NULL, 'Flash Cab'),
          ('dirty-08', 1000.0, 1000, NULL, 'Flash Cab'),
          ('dirty-09', NULL, NULL, '2022-04-01 08:30:00', 'Flash Cab'),
          ('dirty-10', NULL, NULL, '2022-04-01 08:30:00', 'Flash Cab'),
          ('dirty-11', NULL, NULL, '2022-04-01 08:30:00', 'Flash Cab'),
          ('iso-01', 1.0, 1, '2022-04-01 00:00:00', 'x'), ('iso-02', 1.0, 1, '2022-04-01 08:00:00', 'x'),
          ('iso-03', 1.0, 1, '2022-04-01 08:30:00', 'x'), ('iso-04', 1.0, 1, '2022-04-01 08:30:00.123456', 'x'),
          ('iso-05', 1.0, 1, '2022-04-01 08:30:00.5', 'x'), ('iso-06', 1.0, 1, NULL, 'x'),
          ('iso-07', 1.0, 1, NULL, 'x')) AS v(k, d, i, t, c)""",
    "stream_dedupe": f"SELECT {REQUEST_COLS} FROM req",
    "stream_live_join": f"SELECT {RAW_COLS} FROM live",
    "stream_keep_first": f"SELECT {REQUEST_COLS}, CAST(day AS VARCHAR) AS event_date FROM day_req WHERE rn = 1",
    "stream_outer_join": f"""SELECT {', '.join('r.' + c.strip() for c in REQUEST_COLS.split(','))},
        CAST(r.day AS VARCHAR) AS event_date, o.tips, CAST(o.arrived AS VARCHAR) AS outcome_date,
        CASE WHEN o.arrived IS NULL THEN 'pending' ELSE 'matched' END AS status
        FROM (SELECT * FROM day_req WHERE rn = 1 OR unique_key IS NULL) r LEFT JOIN arrivals o
          ON r.unique_key = o.unique_key AND o.arrived BETWEEN r.day AND r.day + 1
        QUALIFY row_number() OVER (PARTITION BY r.row ORDER BY o.arrived, o.tips NULLS FIRST) = 1""",
    "stream_route_counts": """SELECT count(*) AS input_rows,
        count_if(NOT coalesce(payment_type = 'Credit Card', false)) AS filtered_rows,
        (SELECT count(*) FROM sm_flagged WHERE p1 OR p2 OR p3 OR p4 OR p5 OR p6) AS rejected_rows,
        (SELECT count(*) FROM sm_clean) AS valid_rows, true AS agrees FROM sm""",
    "stream_clean": f"SELECT {SILVER_COLS} FROM live_silver",
    "split_cut_dates_sketch": "SELECT true AS val_within, true AS test_within",
    "duplicates_across_runs": """SELECT unique_key, 2 AS n_runs, '1996-01-01_2001-01-01_20260101-000000' AS first_run,
        'open_open_20260101-000000' AS last_run FROM silver JOIN win_silver USING (unique_key)""",
    "bucketed_join": f"SELECT {RAW_COLS} FROM live",
    "bucketed_pending": PENDING,
    "split_cut_dates_approx": "SELECT true AS val_within, true AS test_within",
    "check_job": """SELECT count(*) AS n_rows, count(DISTINCT unique_key) AS n_keys,
        count_if(trip_start_ts IS NULL) AS null_start, count_if(fare IS NULL) AS null_fare,
        count_if(tips IS NULL) AS null_tips, min(trip_start_ts) AS first_trip, max(trip_start_ts) AS last_trip
        FROM silver""",
    "profile_job": """SELECT 'payment' AS profile, to_json({'payment_type': payment_type, 'trips': CAST(count(*) AS VARCHAR),
          'avg_tip': CAST(round(avg(tips), 2) AS VARCHAR),
          'share_with_tip': CAST(round(count_if(tips > 0) / count(*), 3) AS VARCHAR)}) AS row FROM windowed GROUP BY payment_type
        UNION ALL SELECT 'dirtiness', to_json({'total': CAST(count(*) AS VARCHAR),
          'bad_duration': CAST(count_if(trip_seconds IS NULL OR trip_seconds < 60) AS VARCHAR),
          'bad_distance': CAST(count_if(trip_miles IS NULL OR trip_miles < 1e-1) AS VARCHAR),
          'bad_fare': CAST(count_if(fare IS NULL OR fare <= 0) AS VARCHAR),
          'no_pickup_area': CAST(count_if(pickup_community_area IS NULL) AS VARCHAR),
          'no_dropoff_area': CAST(count_if(dropoff_community_area IS NULL) AS VARCHAR),
          'duplicates': CAST(count(*) - count(DISTINCT unique_key) AS VARCHAR)}) FROM windowed
        UNION ALL SELECT 'tip_histogram', to_json({'tip_pct_bucket': CAST(b AS VARCHAR), 'trips': CAST(count(*) AS VARCHAR)})
          FROM (SELECT round(tips / fare, 1) + 0e0 AS b FROM windowed WHERE payment_type = 'Credit Card' AND fare > 0) GROUP BY b""",
}


def oracle_sql() -> dict[str, str]:
    return {name: BASE + sql for name, sql in QUERIES_SQL.items()}
