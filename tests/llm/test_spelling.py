import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SF0001
from triplake.llm import spelling


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def edits(a, b, most=2):
    """Levenshtein distance, by the whole matrix."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_words(docs, dropped_in=97, least_length=5, least_count=3):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % dropped_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= least_length
    return {w: c for w, c in n.items() if c >= least_count}


def brute(n, ratio=2):
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and edits(w, x) == 1] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows, key=lambda r: r[0])


def got(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda r: r[0])


def corpus(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(3, 9))) for _ in range(60)]

    def word():
        w = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "B", "ÿ", "Ö"])
        return "".join(w)

    docs = [(i, " ".join(word() + rng.choice(["", "'s", "×", ".", "1", "ž"]) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return docs + [(None, None), (None, "abab" * 3 + " "), (3, ""), (3, docs[3][1]), (3, docs[3][1]), (n, ("z" * 3000 + " ") * 4),
                   (n + 1, ("z" * 3001 + " ") * 9)]


@pytest.mark.parametrize("list_words", [4, 1 << 12])
def test_variants_equal_brute_force(spark, list_words):
    """Also with lists of 4 words, so that they split down to cores of one code point."""
    docs = corpus(8, 500)
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    out = spelling.variants(df.repartition(4), dropped_in=7, least_length=4, list_words=list_words, task_rows=500)
    rows = brute(brute_words(docs, 7, 4))
    assert len(rows) > 200 and sum(r[1] is not None for r in rows) > 30 and any(r[2] not in (r[0], r[1]) for r in rows)
    assert got(out) == rows


def test_scan_finds_every_pair_once():
    rng = random.Random(4)
    for _ in range(30):
        cores = sorted({(g, "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))) for g in range(3) for _ in range(25)})
        group = np.array([g for g, _ in cores])
        a, b, same = spelling.scan([c.encode("latin-1") for _, c in cores], group, scanned=17)
        want = sorted((i, j) for i, x in enumerate(cores) for j, y in enumerate(cores) if x[0] == y[0] and edits(x[1], y[1]) == 1)
        assert sorted(zip(a.tolist(), b.tolist())) == want
        for i, j, p in zip(a.tolist(), b.tolist(), same.tolist()):
            x, y = cores[i][1], cores[j][1]
            assert x[:p] == y[:p] and (p == min(len(x), len(y)) or x[p] != y[p])


def test_hot_list_is_split(spark):
    """Words with one long prefix and suffix, thousands of them, are not compared in one list."""
    rng = random.Random(9)
    middle = sorted({"".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(3000)})
    words = spark.createDataFrame([("prefix" + m + "suffix", 3 + i % 5) for i, m in enumerate(middle)], "word string, n long")
    lists = spelling.word_lists(words, 200)
    # what is not split further has a core of one code point
    sizes = lists.selectExpr("list", "(m - lo - hi) div 2 AS half").groupBy("list", "half").count().collect()
    assert max(r["count"] for r in sizes if r.half > 0) <= 200
    near = {r.word: (r.n_near, r.best, r.best_n) for r in spelling.near_words(words, 200, 1000).collect()}
    n = {r.word: r.n for r in words.collect()}
    known = set(n)
    for w in random.Random(1).sample(sorted(n), 300):
        xs = {w[:k] + c + w[k + 1:] for k in range(6, 10) for c in "abcdefghij"} & known - {w}
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        assert near.get(w) == ((len(xs), best, n[best]) if xs else None)


def test_chain_of_forms_and_empty_tables(spark):
    words = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    docs = [(1, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2 ** k)))]
    rows = got(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), dropped_in=1 << 33))
    assert rows == brute(brute_words(docs, 1 << 33)) and rows[0][2] == "bbbbb"
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a b c"), (3, "")], "doc_id long, text string")).count() == 0


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    rel = con.execute(spelling.ORACLE_SQL)
    assert [d[0] for d in rel.description] == ["word", "form", "root", "n", "n_near", "form_n"]
    sql = sorted(rel.fetchall(), key=lambda r: r[0])
    assert got(spelling.op12_spelling(spark, SF0001)) == sql
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert {r[0]: r[3] for r in sql} == brute_words(docs)
