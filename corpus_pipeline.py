"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
A stage with Python workers leaves the session's Arrow batches bounded in
bytes, and lets workers return large arrays once they are done with them:
workers live on, and what one stage's hold lies beside the next one's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from triplake.lake import delete_folder, scratch_dir
from triplake.llm import langid
from triplake.llm.bpe import encode_digest
from triplake.llm.mixing import mixed_documents
from triplake.llm.shingle_join import one_of_each_group
from triplake.llm.surrogates import replace

#: Spark's own rows and bytes of an Arrow batch, and those set instead; a session's other settings stay.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
         "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}
#: glibc: what a worker frees of so many bytes or more goes back to the system (else up to 64 MB stay).
RETURNED = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def bound_workers(spark: SparkSession) -> None:
    for key, (usual, small) in BATCH.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, small)
    for key, value in RETURNED.items():
        spark.sparkContext.environment.setdefault(key, value)


def bounded(stage: Callable) -> Callable:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_workers(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@bounded
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (null text, not a letter) go."""
    model = langid.fit(langid.training_rows(docs))
    return langid.identify(docs, model).where(f"lang_pred <> '{langid.UNKNOWN}'").select(*docs.columns)


@bounded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % of their 5-word shingles the one of smallest id stays."""
    return one_of_each_group(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return replace(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget says, 0 to 3 times."""
    return mixed_documents(docs)


@bounded
def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests, one row for each document of the mix."""
    return encode_digest(docs)


STAGES = [("identify_language", identify_language), ("drop_near_copies", drop_near_copies),
          ("replace_personal_data", replace_personal_data), ("mix_sources", mix_sources), ("bpe_tokens", bpe_tokens)]

#: Language models and tokenization are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage returns is written to the shared scratch folder first.

    A stage's table goes once its successor's is written; the last one stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
