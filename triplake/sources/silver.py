"""Silver runs: one immutable Parquet folder per committed run, read singly or as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from triplake import runs
from triplake.schemas import GOLD_SCHEMA, REJECT_SCHEMA, SILVER_SCHEMA


def read_silver_run(spark: SparkSession, run_dir: str) -> DataFrame:
    """One committed run folder with the declared silver schema (timestamps stay zone-less)."""
    runs.check_committed(spark, run_dir)
    return spark.read.schema(SILVER_SCHEMA).parquet(run_dir).select(*SILVER_SCHEMA.fieldNames())


def read_silver_table(spark: SparkSession, dataset_root: str, *run_ids: str) -> DataFrame:
    """The committed runs of a dataset (all, or those named), with the string column ``run_id``.

    Only the folders of these runs are listed, so a run that is still being
    written, or was left half written, does not show.
    """
    schema = T.StructType(list(SILVER_SCHEMA.fields) + [T.StructField("run_id", T.StringType(), True)])
    committed = runs.committed_ids(spark, dataset_root)
    for missing in set(run_ids) - set(committed):
        raise runs.UncommittedRun(f"{missing} is not a committed run of {dataset_root}")
    paths = [f"{dataset_root}/run_id={r}" for r in run_ids or committed]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", dataset_root).parquet(*paths)


def list_runs(spark: SparkSession, dataset_root: str, with_counts: bool = False) -> DataFrame:
    """Committed run ids, ordered; optionally with each run's silver rows.  Opens the runs' manifests, none of their files."""
    rows = runs.manifests(spark, dataset_root)
    counts = [F.col("counts")["silver_rows"].alias("n_rows")] if with_counts else []
    return rows.select("run_id", *counts).orderBy("run_id")


def read_rejects(spark: SparkSession, run_dir: str) -> DataFrame:
    return (spark.read.schema(REJECT_SCHEMA).option("mode", "FAILFAST").json(run_dir)
            .select(*REJECT_SCHEMA.fieldNames()))


def read_gold(spark: SparkSession, version_dir: str) -> DataFrame:
    """A gold version; ``split`` comes back from the ``split=...`` folders."""
    return spark.read.schema(GOLD_SCHEMA).option("basePath", version_dir).parquet(version_dir)

