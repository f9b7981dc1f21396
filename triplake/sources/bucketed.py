"""Tables bucketed and sorted by key: joins, first-per-key and duplicate checks over them shuffle nothing.

``write_bucketed`` lays a frame out by a hash of its key, with the same number
of buckets for every table that is to be joined by that key; ``RUN_KEYS`` are the
keys of silver runs, one partition a run, each bucketed the same way, so keys
that occur in several runs are found bucket by bucket without moving the keys
of old runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake import runs
from triplake.sources.silver import read_silver_run

KEY = "unique_key"


#: Bytes of gzipped JSON lines whose records make one bucket, at the most: some half a million, which a task sorts in memory.
BUCKET_BYTES = 24 << 20


def buckets_for(n_bytes: int, least: int) -> int:
    """Buckets for tables made of a landing of so many bytes: a bucket is one task's, so their number grows with the landing."""
    return max(least, -(-n_bytes // BUCKET_BYTES))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = KEY) -> DataFrame:
    """A new external table ``bucketBy(buckets, key)`` and sorted by it; returns it read back.

    Rows are dealt to the buckets' tasks first, so a bucket is one sorted file
    (more where the writer's records-per-file limit cuts it).
    """
    (df.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
     .option("compression", "zstd").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def add_run_keys(spark: SparkSession, table: str, path: str, dataset_root: str, buckets: int) -> list[str]:
    """Adds the keys of committed runs that ``table`` does not hold yet, a partition each; returns these runs.

    A run's keys are distinct, so a row of the table is a key in a run.
    """
    known = set()
    if spark.catalog.tableExists(table):
        known = {r.partition.removeprefix("run_id=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # a name a run
    new = [r for r in runs.committed_ids(spark, dataset_root) if r not in known]
    for run_id in new:
        keys = read_silver_run(spark, f"{dataset_root}/run_id={run_id}").select(KEY).repartition(buckets, KEY)
        (keys.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").bucketBy(buckets, KEY).sortBy(KEY)
         .option("path", path).saveAsTable(table))
    return new


def keys_in_several_runs(run_keys: DataFrame) -> DataFrame:
    """``(unique_key, n_runs, first_run, last_run)`` of keys that more than one run holds; null keys are one key."""
    return (run_keys.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_runs"), F.min("run_id").alias("first_run"),
                                      F.max("run_id").alias("last_run")).where("n_runs > 1"))
