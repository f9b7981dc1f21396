"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key.  Within each source documents are
ordered by that key; a distributed prefix sum of their sizes decides where
the source's word budget cuts: ``floor(budget / source_size)`` whole epochs
plus the documents before the cut in one more.  The prefix sum has two
levels: keys are uniform, so equal key ranges ("cells") of a source hold
about ``CELL_ROWS`` documents each; cell totals are summed per source, rows
within their cell.  No source, however large, is ordered in one task, nor are
the documents without an id or with one id: their keys differ by a salt from
the row.  Only rows equal in both share a cell however many they are, and the
sums of the sources themselves (a row a source) pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from triplake.llm.common import n_words, stored, table

#: Weights by the sources' position in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is repeated this many times at most.
MAX_EPOCHS = 3
#: Documents that share a cell of the prefix sum, about.
CELL_ROWS = 4096


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, size)`` rows -> one row per source with its word target.

    The sizes of all sources are shared out by weight; a source stops at
    ``max_epochs`` times its size and the rest is shared again by weight.
    With sources in order of ``cap / weight`` the level of that water filling
    is the largest of the levels found by taking all earlier caps as full.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("cap", F.col("source_size") * max_epochs)
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("cap")
    level = ((F.sum("source_size").over(everything) - before)
             / F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    s = s.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return s.select("source", "source_size", "rows",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def _key(doc_id: Column, salt: Column) -> Column:
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(salt.cast("string"), F.lit("")))
    return F.md5(text.cast("binary"))


MIXED = ("source_size", "target", "taken")


def mix(rows: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, cell_rows: int = CELL_ROWS,
        salt: str | None = None) -> DataFrame:
    """``(doc_id, source, size, ...)`` -> the same rows with source_size, target and taken (replacing columns of these names).

    ``taken``: words of the document in the mix, repeats counted; the one
    document on a source's cut line counts with the words before the line, so
    a source's sum is its target rounded.  ``salt``: a column (a digest of the
    text, say) that tells documents of one id, or none, apart in the key.  A
    null source is a source of its own; null or equal ids and repeated rows
    each count as a document (the order of equal ones among themselves cannot
    be told apart and does not matter); sizes of 0 take 0; no rows give no
    rows.  Other columns may have any names.
    """
    kept = rows.drop(*MIXED)
    t = source_targets(rows.select("source", "size"), weights, max_epochs).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.ceil(F.col("rows") / cell_rows).alias("_cells"))
    key = _key(F.col("doc_id"), F.col(salt) if salt else F.lit(None))
    placed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_doc"), key.alias("_key"), F.col("doc_id").alias("_id"),
                         F.col("source").alias("_of"), F.col("size").alias("_size"))
    spot = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    placed = placed.join(t, F.col("_of").eqNullSafe(F.col("_source"))).withColumn("_cell", F.floor(spot * F.col("_cells")))
    cells = placed.groupBy("_source", "_cell").agg(F.sum("_size").alias("_sum"))
    ahead = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(F.col("_source").alias("_s"), F.col("_cell").alias("_c"),
                         F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    within = (Window.partitionBy("_source", "_cell").orderBy("_key", "_id", "_size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("_upto", F.sum("_size").over(within))
    budget = F.floor(F.col("target") + F.lit(0.5))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    before = F.col("_offset") + F.col("_upto") - F.col("_size")
    taken = F.col("_size") * F.col("_epochs") + F.greatest(F.lit(0), F.least(
        F.col("_size"), budget - F.col("_epochs") * F.col("source_size") - before))
    out = placed.join(cells, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c")))
    return out.withColumn("_epochs", epochs).select(
        *[F.col(f"_doc.`{c}`").alias(c) for c in kept.columns], "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as its epochs say, same columns as ``docs``.

    Documents stay whole: the one on a source's cut line is written once more.
    """
    names = docs.columns
    wide = docs.select(F.md5(F.to_json(F.struct(*names)).cast("binary")).alias("_row"), F.struct(*names).alias("_doc"))
    sized = stored(wide.select("_row", F.col("_doc.doc_id").alias("doc_id"), F.col("_doc.source").alias("source"),
                               n_words(F.col("_doc.text")).alias("size")), "mix-sizes")
    copies = (mix(sized, salt="_row", **options).where("taken > 0")
              .groupBy("_row").agg(F.sum(F.ceil(F.col("taken") / F.col("size"))).alias("_copies")))
    return (wide.groupBy("_row").agg(F.first("_doc").alias("_doc")).join(copies, "_row")
            .select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
            .select("_doc.*"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                               F.md5(F.col("text").cast("binary")).alias("digest")), "mix-sizes")
    return mix(sized, salt="digest").select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS DOUBLE) AS w,
         3 * source_size AS cap FROM s
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / w, source ASC NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap) AS DOUBLE)
            / sum(w) OVER (ORDER BY cap / w, source ASC NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * w) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p
)
SELECT doc_id, size, source_size, target,
       CAST(size * epochs + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""
