"""Silver runs as an external table of the session catalog.

The table is partitioned by ``run_id`` and its partitions are the folders of
committed runs, added when a run commits.  So the list of runs is a catalog
lookup, a query over one run lists and reads that run's folder only, and a run
half written is no partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake import runs
from triplake.schemas import SILVER_SCHEMA


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_runs_table(spark: SparkSession, table: str, dataset_root: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over a dataset's root, and its committed runs as partitions."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, run_id string) USING parquet "
              f"PARTITIONED BY (run_id) LOCATION {_text(dataset_root)}")
    register_runs(spark, table, dataset_root)


def register_runs(spark: SparkSession, table: str, dataset_root: str) -> list[str]:
    """Adds the committed runs that the catalog does not have yet; returns them."""
    known = {r.run_id for r in catalog_runs(spark, table).collect()}  # a name a run
    new = [r for r in runs.committed_ids(spark, dataset_root) if r not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION (run_id={_text(r)}) LOCATION {_text(f'{dataset_root}/run_id={r}')}" for r in new))
    return new


def catalog_runs(spark: SparkSession, table: str) -> DataFrame:
    """``run_id`` of every run, from the catalog alone."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", "^run_id=(.*)$", 1).alias("run_id"))


def silver_of_runs(spark: SparkSession, table: str, *run_ids: str) -> DataFrame:
    """Silver rows with ``run_id``, of all runs or of those named (other folders are not listed)."""
    df = spark.table(table)
    return df.where(F.col("run_id").isin(*run_ids)) if run_ids else df
