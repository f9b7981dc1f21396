"""Exact top-k by inner product with dual cover trees.

Rows and queries are dealt into blocks; each block becomes a cover tree once
(centres of a level are further apart than its radius, every point lies
within its node's covering radius).  A task takes query trees and row trees
together: for a pair of nodes with centres q, r and radii a, b no inner
product exceeds ``q.r + a|r| + b|q| + ab``, so a pair is dropped when that is
below the worst k-th score among the node's queries.  Scores found in one
block carry over to the next blocks that the task reads.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from triplake.llm.common import stored, table

TOP = 10
QUERY_EVERY = 100
SCALE = 1024
ROW_BLOCK = 4096
QUERY_BLOCK = 4096
#: Row trees that a task searches one after the other, about.
TREES = 4
#: Radius of a level over that of the next.
BASE = 1.6
#: A node of so few points is not divided further; row nodes that a query leaf opens at a time.
LEAF = 8
OPEN = 64


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


def build_tree(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Cover tree as arrays; the points of a node are ``order[first:last]``, its children ``child[kid:kid_end]``."""
    order, nodes, children = [], [], []

    def place(members: np.ndarray, dist: np.ndarray) -> int:
        """Node over members, whose first is the centre."""
        me, first = len(nodes), len(order)
        radius = float(dist.max())
        nodes.append(None)
        mine: list[int] = []
        if len(members) <= LEAF or radius == 0:
            order.extend(members.tolist())
        else:
            inner = radius / BASE
            left, far = members, dist
            while len(left):
                near = far <= inner
                near[0] = True
                group, reach = left[near], far[near]
                left = left[~near]
                mine.append((group, reach))
                if len(left):
                    far = _distances(points[left], points[left[0]])
            mine = [place(g, r) for g, r in mine]
        at = len(children)
        children.extend(mine)
        nodes[me] = (int(members[0]), radius, first, len(order), at, len(children))
        return me

    everything = np.arange(len(ids))
    place(everything, _distances(points, points[0]))
    centre, radius, first, last, kid, end = (np.array(x) for x in zip(*nodes))
    return {"ids": ids, "points": points, "order": np.array(order), "centre": centre, "radius": radius,
            "first": first, "last": last, "child": np.array(children, np.int64), "kid": kid, "kid_end": end,
            "norm": np.sqrt((points[centre] ** 2).sum(1))}


class Best:
    """The k best (score, id) of each query: higher scores, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        ok = scores >= self.score[q, -1]
        s, i = np.concatenate([self.score[q], scores[ok]]), np.concatenate([self.id[q], ids[ok]])
        pick = np.lexsort((i, -s))[:self.k]
        self.score[q], self.id[q] = s[pick], i[pick]


def search(queries: dict, rows: dict, best: Best) -> None:
    """Add the best rows of a row tree to each query of a query tree."""
    def bound(q: int, nodes: np.ndarray) -> np.ndarray:
        dot = rows["points"][rows["centre"][nodes]] @ queries["points"][queries["centre"][q]]
        a, b = queries["radius"][q], rows["radius"][nodes]
        top = dot + a * rows["norm"][nodes] + b * queries["norm"][q] + a * b
        return top + 1e-9 * (np.abs(top) + 1)

    def worst(q: int) -> float:
        return best.score[queries["order"][queries["first"][q]:queries["last"][q]], -1].min()

    def kids(nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([rows["child"][rows["kid"][n]:rows["kid_end"][n]] for n in nodes.tolist()])

    def leaf(q: int, nodes: np.ndarray) -> None:
        mine = queries["order"][queries["first"][q]:queries["last"][q]]
        top = bound(q, nodes)
        while len(nodes):
            by = np.argsort(-top, kind="stable")
            nodes, top = nodes[by], top[by]
            now, nodes, top = nodes[:OPEN], nodes[OPEN:], top[OPEN:]
            split = rows["kid_end"][now] > rows["kid"][now]
            ends = now[~split]
            if len(ends):
                at = np.concatenate([rows["order"][rows["first"][n]:rows["last"][n]] for n in ends.tolist()])
                scores = queries["points"][mine] @ rows["points"][at].T
                for q1, s in zip(mine.tolist(), scores):
                    other = rows["ids"][at] != queries["ids"][q1]
                    best.add(q1, s[other], rows["ids"][at][other])
            if split.any():
                new = kids(now[split])
                nodes, top = np.concatenate([nodes, new]), np.concatenate([top, bound(q, new)])
            keep = top >= worst(q)
            nodes, top = nodes[keep], top[keep]

    stack = [(0, np.zeros(1, np.int64))]
    while stack:
        q, nodes = stack.pop()
        nodes = nodes[bound(q, nodes) >= worst(q)]
        if not len(nodes):
            continue
        if queries["kid_end"][q] == queries["kid"][q]:
            leaf(q, nodes)
            continue
        # divide the larger side: row nodes wider than this query node, then the query node
        wide = (rows["radius"][nodes] > queries["radius"][q]) & (rows["kid_end"][nodes] > rows["kid"][nodes])
        if wide.any():
            nodes = np.concatenate([nodes[~wide], kids(nodes[wide])])
        stack.extend((c, nodes) for c in queries["child"][queries["kid"][q]:queries["kid_end"][q]].tolist())


def _pack(tree: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **tree)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return dict(z)


def by_length(numbers: DataFrame) -> F.Column:
    """``(d, n)``, one row a vector length (one, as a rule), as an expression of ``d``."""
    out = F.lit(1)
    for r in numbers.collect():
        out = F.when(F.col("d") == r["d"], r["n"]).otherwise(out)
    return out


def trees(vectors: DataFrame, block: int, name: str) -> DataFrame:
    """``(vec_id, v array<long>)`` -> one cover tree a block of equal-length vectors: (d, block, tree)."""
    number = by_length(vectors.groupBy(F.size("v").alias("d")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n")))
    dealt = vectors.withColumn("d", F.size("v")).select(
        "d", F.pmod(F.xxhash64("vec_id", "v"), number).cast("int").alias("block"), "vec_id", "v")

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("vec_id").combine_chunks().to_numpy()
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        by = np.argsort(ids, kind="stable")
        tree = build_tree(ids[by], flat.reshape(len(ids), -1)[by])
        return pa.table({"d": pa.array([t.column("d")[0].as_py()], pa.int32()),
                         "block": pa.array([t.column("block")[0].as_py()], pa.int32()), "tree": [_pack(tree)]})

    return stored(dealt.groupBy("d", "block").applyInArrow(build, "d int, block int, tree binary"), name)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, row_block: int = ROW_BLOCK,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(vec_id, v array<long>)`` rows and queries -> (query_id, rank, vec_id, score), exact.

    The k rows of highest inner product for each query, ties to the smaller
    vec_id; rows with the query's own id are left out, and rows only score
    with queries of their length.  Fewer than k rows: all of them; no rows or
    no queries: none.  Components stay exact while sums of products are below 2**53.
    """
    row_trees = trees(vectors, row_block, "row-trees")
    query_trees = trees(queries, query_block, "query-trees").select("d", F.col("block").alias("query_block"),
                                                                    F.col("tree").alias("query_tree"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, best = None, None, None

        def found() -> pa.RecordBatch:
            real = np.isfinite(best.score)
            q = np.broadcast_to(tree["ids"][:, None], real.shape)[real]
            return pa.RecordBatch.from_arrays([pa.array(q), pa.array(best.id[real]), pa.array(best.score[real].astype(np.int64))],
                                              names=["query_id", "vec_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                key = (b.column("d")[i].as_py(), b.column("query_block")[i].as_py())
                if key != at:
                    if at is not None:
                        yield found()
                    at, tree = key, _unpack(b.column("query_tree")[i].as_py())
                    best = Best(len(tree["ids"]), k)
                search(tree, _unpack(b.column("tree")[i].as_py()), best)
        if at is not None:
            yield found()

    # every row tree meets every query tree of its length, a few row trees in a task
    blocks = by_length(query_trees.groupBy("d").agg((F.max("query_block") + 1).alias("n")))
    parts = by_length(row_trees.groupBy("d").agg(F.ceil((F.max("block") + 1) / TREES).cast("int").alias("n")))
    cells = (row_trees.withColumn("query_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("part", F.col("block") % parts)
             .join(query_trees.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))), ["d", "query_block", "part"])
             .sortWithinPartitions("d", "query_block").select("d", "query_block", "query_tree", "tree"))
    hits = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, embedding)`` -> (vec_id, v array<long>) without null ids and unusable vectors."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.where("vec_id IS NOT NULL AND size(embedding) > 0").where(good)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")))


def op4_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(v, v.where(F.col("vec_id") % QUERY_EVERY == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_dot_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 100 = 0
), k AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM k WHERE rank <= 10
"""
