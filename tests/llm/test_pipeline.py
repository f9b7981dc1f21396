"""The pipeline and the registered corpus queries on the smallest tables."""

import base64
import datetime as dt
import hashlib
import math
from collections import Counter

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
SF0001 = "/root/testdata/sf0.001"
from test_shingle_join import brute
from triplake.llm.catalog import ORACLE_SQL, QUERIES
from triplake.sources.fixture import TABLES


def test_registered_names():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    text = lambda v: repr(v) if isinstance(v, float) and not math.isnan(v) else v.isoformat() if isinstance(v, dt.datetime) else v
    df = entry.queries()[name](spark, SF0001)
    rel = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(text(r[cols.index(c)]) for c in df.columns) for r in rel.fetchall())
    assert Counter(tuple(map(text, r)) for r in df.collect()) == want


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", None, 0), (9002, "123 456", None, "src1", 7), (9003, "", "en", "src1", 0),
                                   (9004, "write to bob.77@mail1.example.com now please, dear friend of mine", "en", None, 60)], docs.schema)
    docs = docs.unionByName(extra).coalesce(2)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["identify_language", "drop_near_copies", "replace_personal_data", "mix_sources", "bpe_tokens"]
    first, second, third, fourth, last = [f for _, f in corpus_pipeline.STAGES]
    one = first(spark, docs, SF0001).cache()
    ids = {r.doc_id for r in one.collect()}
    assert one.columns == docs.columns and {r.doc_id for r in docs.collect()} - ids == {9001, 9002, 9003}
    two = second(spark, one, SF0001).cache()
    want = {int(i) for i, _, c in brute([(r.doc_id, r.text) for r in one.collect()]) if i == c}
    assert two.columns == docs.columns and sorted(r.doc_id for r in two.collect()) == sorted(want)
    three = third(spark, two, SF0001).cache()
    assert three.columns == docs.columns and three.count() == two.count()
    assert not three.where("text LIKE '%bob.77@mail1%'").count()
    four = fourth(spark, three, SF0001).cache()
    assert four.columns == docs.columns and max(Counter(r.doc_id for r in four.collect()).values()) <= 3
    five = last(spark, four, SF0001).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda t: hashlib.sha256(",".join(map(str, lib.encode_ordinary(t))).encode()).hexdigest()
    assert Counter((r.doc_id, r.ids_sha256) for r in five) == Counter((r.doc_id, digest(r.text)) for r in four.collect())


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF0001)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns) and out.count() > 0


def test_stages_bound_what_python_workers_hold(spark):
    """Long texts: an Arrow batch is bounded in bytes; a session's own setting stays."""
    keys = list(corpus_pipeline.BATCH)
    for key in keys:
        spark.conf.unset(key)
    rows, size = keys
    try:
        docs = spark.range(60, numPartitions=1).selectExpr("id AS doc_id", "repeat('lorem ipsum ', 30000) AS text")
        corpus_pipeline.bpe_tokens(spark, docs, SF0001)
        most = docs.mapInArrow(lambda bs: (b.select(["doc_id"]).slice(0, 1).set_column(
            0, "doc_id", __import__("pyarrow").array([b.nbytes])) for b in bs), "doc_id long").agg({"doc_id": "max"}).first()[0]
        assert most <= 6 << 20  # 60 texts of 360,000 bytes came as one batch of 21 MB
        spark.conf.set(rows, "77")
        corpus_pipeline.identify_language(spark, docs.selectExpr("*", "'en' AS lang"), SF0001)
        assert spark.conf.get(rows) == "77"
    finally:
        for key in keys:
            spark.conf.unset(key)
