import pytest
from pyspark.sql import functions as F

from triplake.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long, extra string")


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing until no source is above its cap."""
    order = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, total = {}, set(order), sum(sizes.values())
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > cap * sizes[s]}
        if not over:
            target.update(share)
            break
        target.update({s: cap * sizes[s] for s in over})
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": [100] * 30, "b": [7, 0, 3] * 10, "c": [1], None: [50, 60]},
    {"a": [1], "b": [1], "c": [10_000]},
    {"b": [5, 5]},
    {"a": [0], "b": [0]},
])
def test_targets_and_cut(spark, sizes):
    rows, i = [], 0
    for s, docs in sizes.items():
        for n in docs:
            rows.append((i, s, n, "x"))
            i += 1
    got = mixing.mix(frame(spark, rows), cell_rows=4).collect()
    want = water_fill({s: sum(d) for s, d in sizes.items()})
    assert len(got) == len(rows)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in mine) == int(want[s] + 0.5)
        assert all(0 <= r.taken <= 3 * r["size"] for r in mine)
        partial = [r for r in mine if r["size"] and r.taken % r["size"]]
        assert len(partial) <= 1


def test_cells_do_not_change_the_mix(spark):
    rows = [(i % 40, "ab"[i % 2], i % 13, "x") for i in range(300)]  # repeated ids
    one = sorted(map(tuple, mixing.mix(frame(spark, rows), cell_rows=1000).collect()))
    many = sorted(map(tuple, mixing.mix(frame(spark, rows), cell_rows=3).collect()))
    assert one == many


def test_empty(spark):
    assert mixing.mix(frame(spark, [])).count() == 0


def test_documents_repeat_whole(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", "en", "a", 9), (2, None, "en", "a", 0), (3, "x " * 50, None, "b", 100),
         (3, "x " * 50, None, "b", 100), (None, "solo words here", "en", None, 3)],
        "doc_id long, text string, lang string, source string, size long")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.text for r in rows} <= {"one two three", "x " * 50, "solo words here"}
    assert sum(r.doc_id == 1 for r in rows) == 3  # a small source of weight 5 stops at 3 times its size


def test_columns_of_any_name(spark):
    names = ["target", "source_size", "taken", "_key", "_cell", "_source", "_upto", "_id", "_of", "_size", "_doc", "rows", "w", "a.b"]
    rows = [(i, "ab"[i % 2], i % 7, "x") for i in range(50)]
    wide = frame(spark, rows).select("*", *[F.lit(n).alias(n) for n in names])
    out = mixing.mix(wide, cell_rows=5)
    assert out.columns == ["doc_id", "source", "size", "extra", *names[3:], "source_size", "target", "taken"]
    plain = {r.doc_id: (r.target, r.taken) for r in mixing.mix(frame(spark, rows)).collect()}
    got = out.collect()
    assert {r.doc_id: (r.target, r.taken) for r in got} == plain and all(r["a.b"] == "a.b" and r["_key"] == "_key" for r in got)


def test_rows_without_an_id_do_not_share_a_cell(spark):
    rows = spark.range(4000).selectExpr("cast(null as long) AS doc_id", "'a' AS source", "id % 5 AS size", "md5(cast(id as string)) AS digest")
    keys = rows.select(mixing._key(F.col("doc_id"), F.col("digest")).alias("k"))
    assert keys.distinct().count() == 4000
    out = mixing.mix(rows, cell_rows=100, salt="digest")
    assert out.agg(F.sum("taken")).first()[0] == 8000 and out.count() == 4000
