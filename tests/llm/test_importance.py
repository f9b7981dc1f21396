import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np

from conftest import SF0001
from triplake.llm import crc, importance


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text, grams, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, grams, buckets, percent, least):
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in features(text, grams, buckets):
            s[b] += 1
    for text in target:
        for b in features(text, grams, buckets):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = features(text, grams, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))),
                     len(words(text)) >= least])
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = order[:len(order) * percent // 100]
    rank = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted([(str(r[0]), *r[1:4], rank.get(id(r), 0)) for r in rows])


def got(df):
    return sorted((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"] or 0) for r in df.collect())


def corpus(seed, n, ids=lambda rng, i: i):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "the", "THE", "naïve", "ÀB", "x1", "42", "日本", "o'clock", "a-b", "\x1f", "\x00", "é\x7fé"]
    texts = [None, "", "   ", "...", "one", "word " * 3000]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(ids(rng, i), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(len(texts), n)]
    return docs


def test_checksums_of_joined_strings():
    rng = random.Random(1)
    heads = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    tails = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 3, 7, 5000]))) for _ in range(300)]
    got = crc.joined(np.array([zlib.crc32(h) for h in heads], np.uint32), np.array([zlib.crc32(t) for t in tails], np.uint32),
                     np.array([len(t) for t in tails]))
    assert got.tolist() == [zlib.crc32(h + t) for h, t in zip(heads, tails)]


def test_batch_features_do_not_cross_documents():
    texts = [t for _, t in corpus(3, 80)]
    for grams in (1, 2, 3):
        bucket, doc, n = importance.batch_features(texts, importance.WordCodes(), grams, 997)
        assert n.tolist() == [len(words(t)) for t in texts]
        for i, t in enumerate(texts):
            assert sorted(bucket[doc == i].tolist()) == sorted(features(t, grams, 997))
    assert [len(x) for x in importance.batch_features([], importance.WordCodes())] == [0, 0, 0]


def test_resample_equals_brute_force(spark):
    target = ["the alpha alpha 日本 naïve", None, "Beta o'clock"]
    t = spark.createDataFrame([(x,) for x in target], "text string")
    for grams, seed in ((1, 4), (3, 5)):
        docs = corpus(seed, 400)
        df = spark.createDataFrame([(i, x, 1, "s") for i, x in docs], "doc_id long, text string, rank int, score string")
        out = importance.resample(df.repartition(5), t, grams=grams, buckets=500, percent=20, least_words=20, rows_per_task=9)
        assert got(out) == brute(docs, target, grams, 500, 20, 20)


def test_ranks_with_one_hot_id_ties_and_null_ids(spark):
    """A third of the rows is one repeated row, another group has no id: equal rows share no task, ranks have no gaps."""
    docs = corpus(6, 200, lambda rng, i: None if i % 5 == 0 else i // 2)
    docs += [(7, "alpha the " * 15)] * 120
    target = ["alpha the", "x1"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = importance.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), percent=50, rows_per_task=10)
    assert got(out) == brute(docs, target, 1, 10000, 50, 20)
    ranks = sorted(r["rank"] for r in out.where("rank IS NOT NULL").collect())
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 90


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 20), (2, None)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert got(importance.resample(some, none, percent=100)) == brute([(1, "a b c " * 20), (2, None)], [], 1, 10000, 100, 20)


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    rel = con.execute(importance.ORACLE_SQL)
    assert [d[0] for d in rel.description] == ["doc_id", "n_features", "weight", "score", "rank"]
    sql = sorted((str(r[0]), *r[1:4], r[4] or 0) for r in rel.fetchall())
    assert got(importance.op11_resample(spark, SF0001)) == sql
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    target = [r[0] for r in con.execute("SELECT text FROM benchmark").fetchall()]
    assert sql == brute(docs, target, 1, 10000, 10, 20)
