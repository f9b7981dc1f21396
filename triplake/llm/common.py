"""Helpers shared by the corpus operators: scratch tables, words, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from triplake.lake import scratch_dir

#: A word: a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def task_rows(df: DataFrame, rows_per_task: int = 1 << 20) -> int:
    """Partitions for ``df`` (already stored, so counting is a footer read) at so many rows a task."""
    return max(1, -(-df.count() // rows_per_task))


def n_words(text: Column) -> Column:
    """Words of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text; ``bytes.split`` would also cut at nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordIds(dict):
    """word -> 64-bit hash, remembering at most ``limit`` words at a time."""

    def __init__(self, limit: int = 1 << 18):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def ragged_index(lengths: np.ndarray) -> np.ndarray:
    """0..len-1 within each of consecutive runs of these lengths."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows a bounded number at a time, so that what is made of a batch stays small too."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def fingerprint(df: DataFrame) -> tuple:
    """(rows, order-free hash) of a stored frame."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(src, dst)`` long edges -> ``(node, component)``, the smallest node reachable.

    Alternating large-star and small-star steps.  Each keeps the number of
    edges within the number of edges given, aggregates minima map-side and
    writes its result to the shared scratch folder; the driver only sees a
    row count and a hash.  Nulls and self loops are ignored.
    """
    e = stored(edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"),
                                                 F.least("src", "dst").alias("b")).distinct(), name)
    last = fingerprint(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # after a large star every edge points from a node to a smaller one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        e = stored(small, name)
        now = fingerprint(e)
        if now == last:
            break
        last = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(roots)
