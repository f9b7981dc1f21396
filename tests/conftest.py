import os
import sys
import tempfile

import pytest  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("triplake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="triplake-test-ckpt-"))
    yield s


RAW_TEXT_COLUMNS = ("unique_key", "taxi_id", "trip_start_timestamp", "trip_seconds", "trip_miles",
                    "pickup_community_area", "dropoff_community_area", "fare", "tips", "tolls", "extras",
                    "payment_type", "company")


def ride(key="ride-a", start="2019-11-30 23:45:00", seconds="1860", miles="7.75", pick="41", drop="6", fare="22.25",
         tips="4.4", tolls=None, extras="2.5", pay="Credit Card", company="Blue Line", taxi="cab-17"):
    """One raw trip as text; every argument may be None."""
    return dict(zip(RAW_TEXT_COLUMNS, (key, taxi, start, seconds, miles, pick, drop, fare, tips, tolls, extras, pay, company)))


def text_frame(spark, rows):
    """Rows of text values (or None) -> DataFrame with every column a string."""
    cols = list(rows[0].keys())
    schema = ", ".join(f"{c} string" for c in cols)
    return spark.createDataFrame([tuple(None if r.get(c) is None else str(r.get(c)) for c in cols)
                                  for r in rows], schema)
