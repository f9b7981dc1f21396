"""Session settings the jobs rely on.

Only SQL settings that change plans are set here; cluster sizing belongs
to ``spark-submit``.  Shuffle sizing rule: start from about one partition
per 128 MB of shuffled data (``--shuffle_partitions`` on the jobs, e.g.
~800k for 100 TB) and let AQE coalesce small ones and split skewed ones.
Windows, days and texts of instants are UTC whatever the session's time
zone; it is set to UTC here so that ad-hoc queries agree.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.session.timeZone": "UTC",
    # day folders are many and small: list them with few tasks
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "triplake", master: str | None = None,
                extra: dict[str, str] | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        b = b.master(master)
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    return b.getOrCreate()
