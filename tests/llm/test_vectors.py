import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from triplake.llm import cap_dedupe as cd, dual_tree as dt

SCHEMA = "vec_id long, embedding array<float>, label int, v string, n_links int"


def vectors(d=32, seed=4):
    rng = np.random.default_rng(seed)
    out = [rng.standard_normal(d) for _ in range(150)]
    for i in range(0, 60, 3):  # neighbours around the limit, chains, scaled and equal copies
        base = out[i]
        for step in (0.1, 0.2, 0.3, 0.45, 0.5, 0.55):
            noise = rng.standard_normal(d)
            out.append(base + step * noise * np.linalg.norm(base) / np.linalg.norm(noise))
        out.append(base * 3)
        out.append(base)
    rows = [(i, [float(np.float32(x)) for x in v], i % 3, "x", 0) for i, v in enumerate(out)]
    n = len(rows)
    odd = [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [float("nan")] + [1.0] * (d - 1), [float("inf")] * d,
           [1.0, 2.0], [1.0, 2.1], [-1.0, 0.0]]
    rows += [(n + k, v, None, None, None) for k, v in enumerate(odd)]
    rows.append((3, rows[3][1], 0, "x", 0))  # a repeated row
    random.Random(1).shuffle(rows)
    return rows


def usable(v, zero_ok=False):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and (zero_ok or any(v))


def brute_links(rows, cosine=0.9):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    unit = [np.array(r[1], float) / np.linalg.norm(r[1]) if usable(r[1]) else None for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted((r[0], links[i], low[find(i)], r[0] == low[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("bucket, block", [(256, 1024), (16, 5)])
def test_links_equal_brute_force(spark, bucket, block):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in cd.near_duplicates(df, bucket=bucket, block=block).collect())
    want = brute_links(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert there > 200 and found >= 0.98 * there
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    if found == there:
        assert got == want


def test_list_decoding_finds_every_filter():
    f = cd.make_table(0.3, 24, 400, 1)
    rng = np.random.default_rng(2)
    v = rng.standard_normal((50, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    row, code = f.decode(v)
    turned = v @ f.rotation
    cuts = np.cumsum([0] + [c.shape[1] for c in f.codes])
    total = np.zeros((50, 1))
    for i, j, c in zip(cuts[:-1], cuts[1:], f.codes):
        total = (total[:, :, None] + (turned[:, i:j] @ c.T)[:, None, :]).reshape(50, -1)
    assert len(row) and set(zip(row.tolist(), code.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(total >= f.threshold))))


@pytest.mark.parametrize("n, d", [(50_000, 64), (1_000_000, 64), (2000, 8), (500, 2)])
def test_recall_at_the_limit(n, d):
    tables = cd.make_filters(n, d)
    rng = np.random.default_rng(8)
    a, z = rng.standard_normal((2, 1000, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z -= (z * a).sum(1, keepdims=True) * a
    b = 0.9 * a + math.sqrt(0.19) * z / np.linalg.norm(z, axis=1, keepdims=True)
    pairs = [set(zip(*map(np.ndarray.tolist, cd.decode(tables, v)))) for v in (a, b)]
    assert len({r for r, _ in pairs[0] & pairs[1]}) >= 980


def test_no_vectors(spark):
    assert cd.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = cd.near_duplicates(spark.createDataFrame([(7, None, 1, "x", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in one] == [(7, 0, 7, True)]


def brute_top(rows, every=10, k=10):
    good = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v, *_ in rows if i is not None and usable(v, True)]
    out = []
    for q, a in {(q, tuple(a)): (q, a) for q, a in good if q % every == 0}.values():
        best = sorted((-int(a @ b), i) for i, b in good if i != q and len(a) == len(b))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 40])
def test_top_k_equals_brute_force(spark, block):
    rows = vectors()
    rows += [(10_000 + i, rows[5][1], 0, "x", 0) for i in range(60)]  # ties on one vector
    v = dt.quantised(spark.createDataFrame(rows, SCHEMA))
    got = dt.top_k(v, v.where("vec_id % 10 = 0").dropDuplicates(["vec_id"]), row_block=block, query_block=block)
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_cover_tree_invariants():
    rng = np.random.default_rng(3)
    p = np.concatenate([rng.integers(-50, 50, (200, 6)), np.repeat(rng.integers(-50, 50, (1, 6)), 40, 0)]).astype(float)
    t = dt.build_tree(np.arange(len(p)), p)
    assert sorted(t["order"].tolist()) == list(range(len(p)))
    for n in range(len(t["centre"])):
        members = t["order"][t["first"][n]:t["last"][n]]
        assert np.linalg.norm(p[members] - p[t["centre"][n]], axis=1).max() <= t["radius"][n] + 1e-9
        kids = t["child"][t["kid"][n]:t["kid_end"][n]]
        centres = p[t["centre"][kids]]
        for i in range(len(kids)):
            apart = np.linalg.norm(np.delete(centres, i, 0) - centres[i], axis=1)
            assert not len(apart) or apart.min() > t["radius"][n] / dt.BASE


def test_no_queries_or_rows(spark):
    v = dt.quantised(spark.createDataFrame(vectors(), SCHEMA))
    assert dt.top_k(v, v.where(F.lit(False))).count() == 0
    assert dt.top_k(v.where(F.lit(False)), v).count() == 0
