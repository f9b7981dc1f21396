"""Near-duplicate embeddings by spherical-cap filters.

A filter is a unit direction; a vector passes it when their inner product is
at least ``t / sqrt(d)``.  Directions are structured: after a random rotation
the dimensions fall into blocks, a block has a few random unit codes, and a
filter is one code of each block.  So a vector is list-decoded: block scores
are extended block by block, keeping only prefixes that can still reach the
threshold, and yield all filters passed without touching the others.  Vectors
that share a filter are compared in double precision.

Parameters follow from the number of vectors: a cap holds about ``BUCKET`` of
them, by the measure of caps on the sphere, and tables of filters, each with
a rotation of its own, are added until ``RECALL`` of simulated pairs at just
the wanted cosine share a filter (nearer pairs are found more often).  Equal
vectors become one class first.  A filter's vectors are dealt over cells of
``BLOCK`` by ``BLOCK``, each a task's matrix product; a pair that shares
several filters counts at the first only, so nothing is emitted per pair: a
cell returns link counts and at most one edge a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.llm.common import connected_components, stored, table

COSINE = 0.9
#: Vectors that a filter holds, about.
BUCKET = 1024
#: Simulated pairs at the wanted cosine that share a filter, at least, and how many are tried.
RECALL, TRIED = 0.995, 2000
#: Filters of a table that such a pair would share if all directions were independent.
EXPECTED = 3.0
#: Rows of a cell's side.
BLOCK = 1024
#: Codes of a block, at most (more blocks then).
CODES = 1024
#: Tables of filters at most; bits of a filter's number within its table.
TABLES, TABLE_SHIFT = 256, 48
SEED = 20240229


@dataclass
class Filters:
    """Random product codes over ``d`` dimensions."""
    d: int
    threshold: float  # least sum of block scores
    rotation: np.ndarray
    codes: list[np.ndarray]  # of each block: (codes, block dimensions)

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that unit vectors pass."""
        turned = vectors @ self.rotation
        cuts = np.cumsum([0] + [c.shape[1] for c in self.codes])
        scores = [turned[:, i:j] @ c.T for i, j, c in zip(cuts[:-1], cuts[1:], self.codes)]
        rest = np.zeros(len(vectors))
        best = [rest]
        for s in scores[:0:-1]:
            rest = rest + s.max(1)
            best.append(rest)
        best.reverse()  # what the blocks after each can still add
        row, code, total = np.arange(len(vectors)), np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
        for s, more in zip(scores, best):
            reach = total[:, None] + s[row]
            at, c = np.nonzero(reach + more[row][:, None] >= self.threshold)
            code, total, row = code[at] * s.shape[1] + c, reach[at, c], row[at]
        return row, code


def _marginal(d: int) -> tuple[np.ndarray, np.ndarray]:
    """One coordinate of a uniform direction in ``d`` dimensions: grid over (-1, 1) and P(coordinate >= grid)."""
    x = np.linspace(-1, 1, 20001)
    density = np.maximum(1 - x * x, 1e-300) ** ((max(d, 2) - 3) / 2)
    tail = np.cumsum(density[::-1])[::-1]
    return x, tail / tail[0]


def _both(threshold: float, d: int, cosine: float) -> float:
    """P(two unit vectors at that cosine both pass a random direction's threshold)."""
    x, tail = _marginal(d)
    mass = -np.diff(tail, append=0)
    _, rest = _marginal(d - 1)
    on = x >= threshold
    need = (threshold - cosine * x[on]) / np.maximum(1e-9, math.sqrt(1 - cosine * cosine) * np.sqrt(np.maximum(0, 1 - x[on] ** 2)))
    return float((mass[on] * np.interp(need, x, rest, left=1.0, right=0.0)).sum())


def make_table(threshold: float, d: int, number: int, seed: int) -> Filters:
    """About ``number`` filters with random codes."""
    blocks = 1
    while blocks < d and number ** (1 / blocks) > CODES or blocks < min(2, d):
        blocks += 1
    codes = math.ceil(number ** (1 / blocks))
    rng = np.random.default_rng([SEED, seed])
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    made = []
    for size in (len(x) for x in np.array_split(np.arange(d), blocks)):
        c = rng.standard_normal((codes, size))
        # a block's codes have the length of its share of the dimensions
        made.append(c / np.linalg.norm(c, axis=1, keepdims=True) * math.sqrt(size / d))
    return Filters(d, threshold, rotation, made)


def make_filters(n: int, d: int, cosine: float = COSINE, bucket: int = BUCKET, recall: float = RECALL) -> list[Filters]:
    """Tables of filters for ``n`` vectors of ``d`` dimensions; equal arguments give equal tables."""
    x, tail = _marginal(d)
    threshold = float(x[np.searchsorted(-tail, -min(0.5, bucket / max(1, n)))])
    number = math.ceil(EXPECTED / max(1e-12, _both(threshold, d, cosine)))
    rng = np.random.default_rng(SEED)
    a, z = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, TRIED, d)))
    z = z - (z * a).sum(1, keepdims=True) * a
    b = cosine * a + math.sqrt(1 - cosine * cosine) * z / np.maximum(1e-300, np.linalg.norm(z, axis=1, keepdims=True))
    tables, found = [], np.zeros(TRIED, bool)
    while not tables or found.mean() < recall and len(tables) < TABLES:
        t = make_table(threshold, d, max(4, number), len(tables))
        pairs = [row << TABLE_SHIFT | code for row, code in (t.decode(a), t.decode(b))]
        found[np.intersect1d(*pairs) >> TABLE_SHIFT] = True
        tables.append(t)
    if found.mean() < recall:
        raise ValueError(f"{TABLES} tables of filters find {found.mean():.4f} of simulated pairs at cosine {cosine}, not {recall}: "
                         "allow larger caps (bucket), or a lower recall")
    return tables


def decode(tables: list[Filters], vectors: np.ndarray, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) over all tables, by row."""
    found = [[], []]
    for k in range(0, len(vectors), rows):
        for i, t in enumerate(tables):
            row, code = t.decode(vectors[k:k + rows])
            found[0].append(row + k), found[1].append(code | i << TABLE_SHIFT)
    row, code = map(np.concatenate, found)
    by = np.argsort(row, kind="stable")
    return row[by], code[by]


def _matrix(column: pa.Array) -> np.ndarray:
    """Equal-length lists of numbers as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _cells(t: pa.Table, cosine: float) -> pa.Table:
    """Links within one cell: per row the links (copies counted) and the smallest row of its local component."""
    column = lambda c: t.column(c).combine_chunks()
    ids, size = column("class").to_numpy(), column("copies").to_numpy()
    block, mine = column("block").to_numpy(), column("filter")[0].as_py()
    v = _matrix(column("v"))
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    lo, hi = column("lo")[0].as_py(), column("hi")[0].as_py()
    a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    hit = v[a] @ v[b].T >= cosine
    if lo == hi:
        np.fill_diagonal(hit, False)
    ra, rb = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    a, b, hit = a[ra], b[rb], hit[np.ix_(ra, rb)]
    lists = column("filters").to_pylist()
    earlier = sorted({f for i in np.union1d(a, b).tolist() for f in lists[i] if f < mine})
    if earlier:  # a pair counts where its first common filter is
        at = {f: k for k, f in enumerate(earlier)}

        def member(rows):
            m = np.zeros((len(rows), len(earlier)), np.float32)
            for i, r in enumerate(rows.tolist()):
                m[i, [at[f] for f in lists[r] if f < mine]] = 1
            return m
        hit &= (member(a) @ member(b).T) == 0
    links = np.zeros(len(ids), np.int64)
    links[a] += hit @ size[b]
    if lo != hi:
        links[b] += hit.T @ size[a]
    label = np.arange(len(ids))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    label = rank.copy()  # smallest rank within reach inside the cell
    big = len(ids)
    while len(a) and len(b):
        new = label.copy()
        np.minimum.at(new, a, np.where(hit, label[b][None, :], big).min(1))
        np.minimum.at(new, b, np.where(hit, label[a][:, None], big).min(0))
        if (new == label).all():
            break
        label = new
    keep = (links > 0) | (label != rank)
    return pa.table({"class": ids[keep], "links": links[keep], "low": ids[order[label[keep]]]})


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, bucket: int = BUCKET, recall: float = RECALL,
                    block: int = BLOCK) -> DataFrame:
    """``(vec_id, embedding)`` -> vec_id, n_links, component_id, kept.

    Vectors link at cosine ``cosine`` or more.  Null or zero vectors, those
    with null or non-finite components and rows with a null id link with
    nothing (0 links, their own component, kept); vectors only meet others of
    their length; repeated rows are vectors like others.  No rows give none.
    """
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    v = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")
    rows = stored(vectors.select("vec_id", v.alias("v")), "cap-vectors")
    whole = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usable = F.coalesce(whole, F.lit(False))
    classes = stored(rows.where(usable).groupBy("v").agg(F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("copies")),
                     "cap-classes")
    lengths = [(r["d"], r["n"]) for r in classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()]
    found = None
    for d, n in lengths:  # one length, as a rule
        part = _links(classes.where(F.size("v") == d), n, d, cosine, bucket, recall, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        own = rows.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))
        return own.select("vec_id", "n_links", "component_id", F.lit(True).alias("kept"))
    found = stored(found, "cap-links")
    count = found.groupBy("class").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select(F.col("class").alias("src"), F.col("low").alias("dst")), "cap-components")
    by_class = (classes.join(count, "class", "left").join(labels.withColumnRenamed("node", "class"), "class", "left")
                .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "class").alias("component_id")))
    joined = (rows.where(usable).join(by_class, "v").select("vec_id", "n_links", "component_id")
              .unionByName(rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                      F.col("vec_id").alias("component_id"))))
    return joined.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, n: int, d: int, cosine: float, bucket: int, recall: float, block: int) -> DataFrame:
    filters = make_filters(n, d, cosine, bucket, recall)
    kind = classes.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"))
            if not len(v):
                continue
            row, code = decode(filters, v / np.linalg.norm(v, axis=1, keepdims=True))
            ends = np.cumsum(np.bincount(row, minlength=len(v)))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(code))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "filters"])

    decoded = stored(classes.select("class", "copies", "v").mapInArrow(
        run, f"class long, copies long, v {kind}, filters array<long>"), "cap-filters")
    passed = decoded.select(F.explode("filters").alias("filter"))
    blocks = (passed.groupBy("filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("filter", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    rows = decoded.select("*", F.explode("filters").alias("filter")).join(blocks, "filter")
    mine = F.pmod(F.xxhash64("class", "filter"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    return rows.select("filter", "lo", "hi", "block", "class", "copies", "v", "filters").groupBy(
        "filter", "lo", "hi").applyInArrow(lambda t: _cells(t, cosine), "class long, links long, low long")


def op1_cap_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
