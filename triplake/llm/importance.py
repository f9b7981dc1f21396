"""Resampling documents towards a target distribution by importance weights.

A document's features are its runs of 1 to ``grams`` words, hashed into
``buckets``.  A bucket's gain is the log ratio of its smoothed share among the
target texts to that among all documents; a document's weight is the mean gain
of its features.  Weight plus a keyed Gumbel noise is the score; drawing the
highest scores samples without replacement in proportion to the weights.

A batch of texts is joined with separator sentinels and one regex pass finds
all words of the batch; the sentinels' offsets, looked up by binary search,
tell each word's document and mask the n-grams that cross a border before the
rest are counted by bucket.

On Spark: the first pass sends one row per bucket and task, the second returns
two numbers a document; nothing else is shuffled but the drawn documents.
Those are ranked by a range sort whose last key is the row's place in the
stored table, so that rows of equal score and id still part; a part's rows are
numbered by themselves and offset by the parts before it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from triplake.llm.common import stored, table
from triplake.llm.crc import CRC_SQL, CRC_TABLE_SQL, joined

BUCKETS = 10000
GRAMS = 1
SEED = 2024
#: Share of the documents drawn, and the words a document must have to be drawn.
PERCENT, LEAST_WORDS = 10, 20
#: Characters of text joined at a time.
CHUNK_CHARS = 1 << 20
#: Words that a task remembers.
REMEMBERED = 1 << 18
#: Drawn documents that a task ranks, about.
RANKED_ROWS = 1 << 20

#: No text holds it: a lone surrogate is no character.
SENTINEL = "\ud800"
# ASCII digits and letters and all beyond ASCII; capitals are lowered once a distinct word
_WORDS = re.compile(f"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F{SENTINEL}]+|{SENTINEL}")
_SENTINEL_CODE = -1


class WordCodes(dict):
    """word -> length in bytes and CRC-32 of its lower-cased UTF-8, packed; -1 for the sentinel."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        if word == SENTINEL:
            code = _SENTINEL_CODE
        else:
            raw = word.encode().lower()  # bytes.lower lowers A-Z only
            code = len(raw) << 32 | zlib.crc32(raw)
        self[word] = code
        return code


def batch_features(texts: list[str | None], codes: WordCodes, grams: int = GRAMS,
                   buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its document, words of each document) of a batch of texts."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = _WORDS.findall(SENTINEL.join([t or "" for t in texts]) + SENTINEL)
    code = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
    # a sentinel ends each document; without them, the words before each document's end
    ends = np.flatnonzero(code == _SENTINEL_CODE) - np.arange(len(texts))
    code = code[code != _SENTINEL_CODE]
    at = np.arange(len(code))
    doc = np.searchsorted(ends, at, "right")
    word, length = (code & 0xFFFFFFFF).astype(np.uint32), code >> 32
    # further words follow a space
    spaced = joined(np.full(len(word), zlib.crc32(b" "), np.uint32), word, length) if grams > 1 else word
    all_buckets, all_docs, h = [word.astype(np.int64) % buckets], [doc], word
    for n in range(2, grams + 1):
        h = joined(h[:-1], spaced[n - 1:], length[n - 1:] + 1)
        inside = doc[:len(h)] == doc[n - 1:]
        all_buckets.append(h[inside].astype(np.int64) % buckets)
        all_docs.append(doc[:len(h)][inside])
    return (np.concatenate(all_buckets), np.concatenate(all_docs), np.diff(ends, prepend=0))


def _parts(b: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about CHUNK_CHARS characters (a longer text alone)."""
    size = np.array([len(t or "") for t in b.column(text).to_pylist()], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // CHUNK_CHARS)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
        yield b.slice(i, j - i)


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: ``buckets`` numbers, whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = WordCodes(), np.zeros(buckets, np.int64)
        for b in batches:
            for part in _parts(b, 0):
                counts += np.bincount(batch_features(part.column(0).to_pylist(), codes, grams, buckets)[0], minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    rows = (texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
            .collect())  # at most a row a bucket
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored 1000 * log ratio of each bucket's smoothed shares, target over source."""
    k = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """``(doc_id, text)`` -> doc_id, n_words, n_features, weight (floored mean gain; 0 without features)."""
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for b in batches:
            for part in _parts(b, 1):
                bucket, doc, words = batch_features(part.column(1).to_pylist(), codes, grams, len(gain))
                n = np.bincount(doc, minlength=part.num_rows)
                # whole numbers far below 2**53: exact in doubles
                total = np.bincount(doc, gain[bucket], minlength=part.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words), pa.array(n), pa.array(np.where(n > 0, total // np.maximum(n, 1), 0))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    zero = F.lit(None).cast("long")
    return rows.mapInArrow(run, rows.select("doc_id", zero.alias("n_words"), zero.alias("n_features"), zero.alias("weight")).schema)


def noise(doc_id, seed: int = SEED):
    """Keyed Gumbel noise in thousandths, floored; a null id counts as an empty text."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def drawn_ranks(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
                rows_per_task: int = RANKED_ROWS) -> DataFrame:
    """``rank`` for the highest scores of a stored table, null for the rest.

    Of the N rows with at least ``least_words`` words, ``N * percent // 100``
    are ranked from 1; ties go to the smaller doc_id, a null id last.
    """
    spark = scored.sparkSession
    enough = F.col("n_words") >= least_words
    # a row for each value a score has: whole thousandths within the span of logarithms of counts, some 100,000
    by_score = sorted(((r["score"], r["n"]) for r in scored.where(enough).groupBy("score").agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    draws = sum(n for _, n in by_score) * percent // 100
    reached, cut = 0, None
    for value, n in by_score:
        if reached >= draws:
            break
        reached, cut = reached + n, value
    no_rank = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select("*", no_rank)
    high = enough & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("_at")]
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    sorted_ = stored(scored.where(high).withColumn("_at", F.xxhash64(at))
                     .repartitionByRange(max(1, -(-reached // rows_per_task)), *order)
                     .withColumn("_part", F.spark_partition_id()), "importance-drawn")
    # a row for each part
    sizes = sorted((r["_part"], r["n"]) for r in sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0] + [n for _, n in sizes]).tolist()
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "_part int, _start long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = sorted_.withColumn("_place", place).join(starts, "_part").withColumn("rank", F.col("_start") + F.col("_place"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    return (scored.where(~F.coalesce(high, F.lit(False))).select("*", no_rank)
            .unionByName(ranked.select(*scored.columns, "rank")))


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, rows_per_task: int = RANKED_ROWS) -> DataFrame:
    """``(doc_id, text)`` and target ``text`` rows -> doc_id, n_words, n_features, weight, score, rank (null: not drawn).

    A null or empty text has no features and weight 0; null ids share one
    noise and rank last among equals; repeated ids and rows are documents of
    their own.  An empty target makes every gain that of the smoothing alone;
    no documents give no rows.  Other columns are not read.
    """
    gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = stored(weights(docs, gain, grams).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)),
                    "importance-scores")
    return drawn_ranks(scored, percent, least_words, rows_per_task)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOUND = rf"unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
ORACLE_SQL = rf"""
WITH {CRC_TABLE_SQL}, d AS (
  SELECT row_number() OVER () AS row, doc_id, text FROM documents
), source_words AS (
  SELECT row, w, count(*) AS n FROM (SELECT row, {_FOUND} AS w FROM d) GROUP BY row, w
), target_words AS (
  SELECT w, count(*) AS n FROM (SELECT {_FOUND} AS w FROM benchmark) GROUP BY w
), crc AS (
  SELECT w, {CRC_SQL.format(w='w')} % 10000 AS bucket
  FROM (SELECT w FROM source_words UNION SELECT w FROM target_words), crc_table
), s AS (
  SELECT bucket, sum(n) AS n FROM source_words JOIN crc USING (w) GROUP BY bucket
), t AS (
  SELECT bucket, sum(n) AS n FROM target_words JOIN crc USING (w) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)
           / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS BIGINT) AS g
  FROM s FULL JOIN t USING (bucket)
), summed AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS g
  FROM source_words JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(floor(g / CAST(n AS DOUBLE)), 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN summed USING (row)
), ordered AS (
  SELECT doc_id, n_features, weight,
         weight + CAST(floor(-1000 * ln(-ln((h + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20
                               ORDER BY score DESC, doc_id ASC NULLS LAST, n_features) AS place FROM ordered
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= (SELECT count(*) * 10 // 100 FROM ordered WHERE n_features >= 20)
            THEN place END AS rank
FROM ranked
"""
