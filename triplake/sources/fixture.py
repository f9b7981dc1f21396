"""Raw trips derived from the TPC-H-shaped test tables.

The test tables hold no trips, so this view maps lineitem x orders x part
onto the 13 raw trip fields, with real duplicate keys, nulls and rows that
break each rule.  The same mapping is written as SQL for the DuckDB oracle.
Only the needed columns are read; join strategy is left to AQE (both
dimension sides grow with the data, so nothing is forced to broadcast).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from triplake.lake import hadoop_fs
from triplake.schemas import EVENT_DATE, RAW_COLUMNS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str, by: str | None = None) -> DataFrame:
    """The 13 raw fields; ``by``: dealt by the "day" or "month" of their start, for a landing, before they are made (half as wide)."""
    # what the joins move is as narrow as can be: two texts as one flag, a customer as its area
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        F.when(F.col("l_returnflag") != "N", True).when(F.col("l_linestatus") == "O", False).alias("_by_card"))
    area = F.col("o_custkey") % 90
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(area.between(1, 77), area.cast("byte")).alias("_dropoff"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
           .join(part, li.l_partkey == part.p_partkey, "inner"))
    c = F.col
    null = lambda t: F.lit(None).cast(t)
    start = F.when(c("l_partkey") % 97 == 0, null("timestamp_ntz")).otherwise(
        F.timestamp_add("MINUTE", (c("l_partkey") % 1440).cast("int"), c("l_shipdate")))
    if by:
        day = F.trunc(start, "month") if by == "month" else F.to_date(start)
        j = j.drop("o_orderkey", "p_partkey").withColumn("_day", day).hint("rebalance", "_day")
    cols = {
        "unique_key": F.concat(c("l_orderkey").cast("string"), F.lit("-"), c("l_linenumber").cast("string")),
        "taxi_id": F.when(c("l_suppkey") % 25 == 0, null("string"))
                    .otherwise(F.concat(F.lit("taxi_"), c("l_suppkey").cast("string"))),
        "trip_start_timestamp": start,
        "trip_seconds": F.when(c("l_partkey") % 89 == 0, null("bigint"))
                    .otherwise((c("l_partkey") % 2000) * 9),
        "trip_miles": (c("l_quantity") - 1) * F.lit(2.1),
        "pickup_community_area": (c("l_suppkey") % 80).cast("bigint"),
        "dropoff_community_area": c("_dropoff").cast("bigint"),
        "fare": F.floor(c("l_extendedprice") / F.lit(2.0)) / F.lit(100.0) - F.lit(2.0),
        "tips": F.floor((c("l_discount") * F.lit(3.0) - F.lit(0.01)) * c("l_extendedprice") / F.lit(2.0)) / F.lit(100.0),
        "tolls": F.when(c("l_tax") == 0, null("double")).otherwise(c("l_tax") * F.lit(50.0)),
        "extras": F.when(c("l_linenumber") == 1, null("double"))
                    .when(c("l_linenumber") == 2, F.lit(0.0))
                    .otherwise(c("l_linenumber") * F.lit(0.5)),
        "payment_type": F.when(c("_by_card"), F.lit("Credit Card"))
                    .when(~c("_by_card"), F.lit("Cash")),
        "company": F.when(c("l_partkey") % 53 == 0, null("string"))
                    .otherwise(F.concat(F.lit(" "), c("p_brand"), F.lit(" "))),
    }
    return j.select(*[cols[n].alias(n) for n in RAW_COLUMNS])


def trips_stored(raw: DataFrame) -> DataFrame:
    """Raw trips with the columns a stored table also has; their values follow from no other columns alone."""
    c = F.col
    odd = F.coalesce(c("dropoff_community_area") % 5 == 3, F.lit(False))
    total = c("fare") + c("tips") + F.coalesce(c("tolls"), F.lit(0.0)) + F.coalesce(c("extras"), F.lit(0.0))
    end = F.timestamp_add("SECOND", c("trip_seconds"), c("trip_start_timestamp"))
    return raw.select(
        "*", F.when(odd, total + F.lit(1.25)).otherwise(total).alias("trip_total"),
        F.when(odd, F.timestamp_add("SECOND", F.lit(7), end)).otherwise(end).alias("trip_end_timestamp"),
        F.concat(F.lit("tract_"), c("pickup_community_area").cast("string")).alias("pickup_census_tract"))


def keyless(raw: DataFrame) -> DataFrame:
    """The same trips without a key where the taxi is unknown."""
    return raw.withColumn("unique_key", F.when(F.col("taxi_id").isNotNull(), F.col("unique_key")))


def outcome_arrival() -> tuple[Column, Column]:
    """Whether a trip's outcome has arrived, and the day of its arrival: some trips' comes the next day, some never."""
    c = F.col
    late = F.coalesce(c("pickup_community_area") % 2 == 1, F.lit(False)).cast("int")
    return (F.coalesce(c("dropoff_community_area") % 7 != 3, F.lit(True)),
            F.date_add(F.to_date(c("trip_start_timestamp")), late))


def stamp_arrival(spark: SparkSession, root: str) -> None:
    """Sets the time of every landed file to that of its day, as daily arrivals leave it (streams take files in this order)."""
    jvm, (p, fs) = spark.sparkContext._jvm, hadoop_fs(spark, f"{root}/{EVENT_DATE}=*/part-*")
    for f in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(p)):
        day = dt.date.fromisoformat(str(f.getParent().getName()).split("=", 1)[1])
        # days a second apart: within the age up to which a file source looks at files
        seconds = 1_700_000_000 + day.toordinal() - dt.date(1990, 1, 1).toordinal()
        if fs.getUri().getScheme() == "file":
            os.utime(f.toUri().getPath(), (seconds, seconds))
        else:
            fs.setTimes(f, seconds * 1000, -1)


# The same mapping as SQL text (runs unchanged in Spark SQL and DuckDB).
TRIPS_RAW_SQL = """SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS unique_key,
  CASE WHEN l_suppkey % 25 = 0 THEN NULL ELSE 'taxi_' || CAST(l_suppkey AS STRING) END AS taxi_id,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_shipdate + INTERVAL '1' MINUTE * CAST(l_partkey % 1440 AS INT) END AS trip_start_timestamp,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE (l_partkey % 2000) * 9 END AS trip_seconds,
  (l_quantity - 1) * 2.1e0 AS trip_miles,
  CAST(l_suppkey % 80 AS BIGINT) AS pickup_community_area,
  CASE WHEN o_custkey % 90 BETWEEN 1 AND 77 THEN CAST(o_custkey % 90 AS BIGINT) END AS dropoff_community_area,
  floor(l_extendedprice / 2e0) / 100e0 - 2e0 AS fare,
  floor((l_discount * 3e0 - 1e-2) * l_extendedprice / 2e0) / 100e0 AS tips,
  CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 5e1 END AS tolls,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 0e0 ELSE l_linenumber * 5e-1 END AS extras,
  CASE WHEN l_returnflag <> 'N' THEN 'Credit Card' WHEN l_linestatus = 'O' THEN 'Cash' END AS payment_type,
  CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE ' ' || p_brand || ' ' END AS company
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

TRIPS_STORED_SQL = """SELECT *,
  fare + tips + coalesce(tolls, 0e0) + coalesce(extras, 0e0)
    + CASE WHEN dropoff_community_area % 5 = 3 THEN 125e-2 ELSE 0e0 END AS trip_total,
  trip_start_timestamp + to_seconds(trip_seconds + CASE WHEN dropoff_community_area % 5 = 3 THEN 7 ELSE 0 END) AS trip_end_timestamp,
  'tract_' || CAST(pickup_community_area AS VARCHAR) AS pickup_census_tract FROM raw"""
