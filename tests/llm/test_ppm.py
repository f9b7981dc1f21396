import math
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from triplake import lake as lk
from triplake.llm import ppm

TEXTS = [(0, "The cat sat on the mat. The cat sat."), (1, "the mat sat on the cat"), (2, None), (3, ""),
         (4, "Der Hund saß auf der Matte\n\nund der Hund"), (5, "a" * 300), (6, "the\tcat\x0bsat éé"), (None, "the cat"),
         (1, "zzz qqq the mat sat on"), (8, "the cat sat on the mat. the end of the cat"), (9, "x")]


def brute(texts, train, order):
    """log10 probability of each text, straight from the definition."""
    follow = defaultdict(Counter)
    for t, learn in zip(texts, train):
        if learn:
            s = [ppm.START] * order + list(t) + [ppm.END]
            for i in range(order, len(s)):
                for n in range(order + 1):
                    follow[tuple(s[i - n:i])][s[i]] += 1
    out = []
    for t in texts:
        s, total = [ppm.START] * order + list(t) + [ppm.END], 0.0
        for i in range(order, len(s)):
            left_out: set = set()
            for n in range(order, -1, -1):
                c = follow.get(tuple(s[i - n:i]))
                if c is None:
                    continue
                here = {x: k for x, k in c.items() if x not in left_out}
                whole = sum(here.values()) + len(here)
                if s[i] in here:
                    total += math.log10(here[s[i]] / whole)
                    break
                if here:
                    total += math.log10(len(here) / whole)
                left_out = set(c)
            else:
                total -= math.log10(max(1, ppm.SYMBOLS - len(left_out)))
        out.append(total)
    return out


def stored_docs(spark, rows):
    path = lk.scratch_dir(spark, "test-ppm")
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("v", F.lit(1)).coalesce(2).write.parquet(path)
    return spark.read.parquet(path).withColumn("held_out", ppm.held_out(F.col("doc_id")))


@pytest.mark.parametrize("rows", [TEXTS, TEXTS[2:4], [(i, None if i % 5 == 0 else "ab cab" * (i % 9)) for i in range(60)]])
def test_scores_equal_brute_force(spark, rows):
    docs = stored_docs(spark, rows)
    got = ppm.score(ppm.in_chunks(docs, rows=4)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 6))
    learn = {r.doc_id: not r.held_out for r in docs.collect()}
    raw = [(t or "").encode() for _, t in rows]
    want = brute(raw, [learn[i] for i, _ in rows], ppm.ORDER)
    assert [k[2] for k in sorted(key((r.doc_id, r.score)) for r in got)] == pytest.approx(
        [k[2] for k in sorted(key((i, s)) for (i, _), s in zip(rows, want))], abs=1e-5)
    words = [t.lower().split() + [None] for t in raw]
    count = Counter(w for ws, (i, _) in zip(words, rows) if learn[i] for w in ws)
    n, v = sum(count.values()), len(count)
    base = [sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws) for ws in words]
    assert sorted(round(r.base_score, 8) for r in got) == pytest.approx(sorted(round(b, 8) for b in base))
    assert sorted(r.n_known for r in got) == sorted(sum(w in count for w in ws) for ws in words)
    assert {r.train_tokens for r in got} == {n}


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 101, 40).tolist()) for _ in range(30)]
    k, _ = ppm.grams(texts)
    u, c = np.unique(k, return_counts=True)
    for ctx in {int(x) >> ppm.BITS for x in u[:20]}:
        every = np.array([ctx << ppm.BITS | s for s in range(ppm.SYMBOLS)])
        keys = np.union1d(u, every)
        n = np.zeros(len(keys), np.int64)
        n[np.searchsorted(keys, u)] = c
        p = ppm.log_probabilities(keys, n, {})
        assert (10 ** p[np.searchsorted(keys, every)]).sum() == pytest.approx(1, abs=1e-9)


def test_empty_table(spark):
    assert ppm.score(ppm.in_chunks(stored_docs(spark, []))).count() == 0


WORDS = ["a", "a\0", "\0a", "\0", "a\0\0\0\0\0\0\0", "eightbyt", "eightbyte", "é", "e\u0301", "\x1cx", "\x85", "\xa0",
         *("q" * n for n in (7, 8, 15, 16, 63, 64, 65, 66, 500)), *("q" * 63 + c for c in "rs"), *("q" * 64 + c for c in "rs")]


def test_word_keys_are_equal_where_words_are():
    texts = [" ".join(WORDS), None, "", " \t\n\x0b\x0c\r ", "\r\n" + "\x0b".join(reversed(WORDS)) + "\x0c", " ".join(WORDS).upper(), "a"]
    keys, lengths = ppm._word_keys(pa.array(texts))
    docs = [(t or "").encode().lower().split() + [None] for t in texts]
    assert lengths.tolist() == [len(d) for d in docs]
    of = dict(zip((w for d in docs for w in d), keys.tolist()))
    assert [of[w] for d in docs for w in d] == keys.tolist()
    assert len(set(of.values())) == len(of) and of[None] == ppm.END_WORD and min(of.values()) >= ppm.WORD_BIT
    # the same in a slice and without any word
    again, n = ppm._word_keys(pa.array(texts).slice(3, 2))
    assert n.tolist() == lengths[3:5].tolist() and again.tolist() == keys[lengths[:3].sum():lengths[:5].sum()].tolist()
    assert ppm._word_keys(pa.array([None, ""], "string"))[0].tolist() == [ppm.END_WORD] * 2


def test_word_keys_differ_over_many_words():
    n = 300_000
    keys, _ = ppm._word_keys(pa.array([" ".join(f"w{i}" for i in range(n)), " ".join(f"{i:040d}" for i in range(n))]))
    assert len(np.unique(keys)) == 2 * n + 1


def test_counts_of_learned_and_other_keys():
    k = np.array([5, 3, 5, ppm.WORD_BIT | 7, 3, 9, (1 << 63) - 1], np.int64)
    key, n = ppm._counted(k, np.array([True, False, True, True, True, False, True]))
    assert key.tolist() == [3, 5, 9, ppm.WORD_BIT | 7, (1 << 63) - 1] and n.tolist() == [1, 2, 0, 1, 1]


def test_keys_of_words_cost_no_more_than_those_of_bytes():
    """Words that come once or twice, as most do: each took a call in Python, several times the work of its bytes."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x:x}" for x in rng.integers(0, 1 << 20, 400)) for _ in range(400)]
    column, raw = pa.array(texts), [t.encode() for t in texts]

    def seconds(f, *a):
        took = []
        for _ in range(5):
            begun = time.process_time()
            f(*a)
            took.append(time.process_time() - begun)
        return min(took)

    def counted(texts):
        k, _ = ppm.grams(texts)
        return ppm._counted(k, np.ones(len(k), bool))

    assert seconds(ppm._word_keys, column) < 1.5 * seconds(counted, raw)
