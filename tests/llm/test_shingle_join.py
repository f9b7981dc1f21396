import random
import re

import pytest

from triplake.llm import shingle_join as sj


def sets_of(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=80):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(s), str(low[find(i)] if d is not None else None)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(60):
        rows.append([word() for _ in range(rng.choice([1, 3, 4, 5, 6, 8, 30, 90, 200]))])
    for base in list(rows):  # near copies at all distances, chains of edits, shared passages
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
            base = copy if rng.random() < 0.3 else base
    for n in (5, 15, 60):
        rows += [passage + [word() for _ in range(n)] for _ in range(12)]
    rows += [passage + passage[:7]] * 3
    return [" ".join(r) for r in rows]


@pytest.fixture(scope="module")
def rows():
    texts = corpus()
    rows = [(i * 3 + 1, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (5000, None), (5001, ""), (5002, " \n\t"), (1, texts[0]), (2, texts[70]), (5003, "w " * 30000)]
    random.Random(2).shuffle(rows)
    return rows


def collected(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, n int")
    assert collected(sj.jaccard_components(docs)) == brute(rows)


def test_hot_shingles_do_not_change_the_result(spark, rows, monkeypatch):
    monkeypatch.setattr(sj, "HOT_LEAST", 4)
    monkeypatch.setattr(sj, "HOT_LISTS", 1 << 30)
    monkeypatch.setattr(sj, "RANGE_POSTINGS", 2000)
    monkeypatch.setattr(sj, "BLOCK_SETS", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert collected(sj.jaccard_components(docs)) == brute(rows)


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    kept = sorted((str(r.doc_id), r.text or "") for r in sj.one_of_each_group(docs).collect())
    want = {(str(d), t or "") for (d, t) in rows if d is None}
    found = {(d, n, c) for d, n, c in brute(rows)}
    for d, t in rows:
        if d is not None and (str(d), len(sets_of(t)), str(d)) in found:
            want.add((str(d), t or ""))
    assert kept == sorted(want)


def test_empty_table(spark):
    assert sj.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_link_is_counted(spark, rows, monkeypatch):
    monkeypatch.setattr(sj, "BLOCK_SETS", 3)
    sets = [sets_of(t) if d is not None else set() for d, t in rows]
    want = sorted((str(d), len(sets_of(t)), sum(1 for j, b in enumerate(sets) if i != j and sets[i] and b
                                                and 100 * len(sets[i] & b) >= 80 * len(sets[i] | b)))
                  for i, (d, t) in enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_shingles, r.n_links) for r in sj.jaccard_components(docs).collect()) == want


def test_shortest_shared_lists_of_each_class(spark, rows, monkeypatch):
    monkeypatch.setattr(sj, "RANGE_POSTINGS", 500)
    sets = sj.document_sets(spark.createDataFrame(rows, "doc_id long, text string"), 80, 5).where("lead IS NOT NULL")
    classes = {r.fp: (r.n, [int(h) for h in sj.np.frombuffer(r.lead, sj.np.uint64).view(sj.np.int64)]) for r in sets.collect()}
    lists = {}
    for fp, (_, lead) in classes.items():
        for h in lead:
            lists.setdefault(h, set()).add(fp)
    want = set()
    for fp, (n, lead) in classes.items():
        shared = sorted((len(lists[h]), h) for h in lead if len(lists[h]) > 1)
        p = int(sj.short_lists(n, 80)) - len(lead) + len(shared)
        want |= {(fp, n, h) for _, h in shared[:max(0, p)]}
    found = sj.short_shared_lists(sets, sj.np.array([], sj.np.uint64), 4, 80)
    assert want and sorted((r.fp, r.n, r.h) for r in found.collect()) == sorted(want)
    # postings move packed: a binary a range and bucket, not a row a posting
    assert "rows#" in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_task_holds_the_words_of_few_texts(monkeypatch):
    held, sets = [], sj._sets
    monkeypatch.setattr(sj, "_sets", lambda docs, *a: (held.append(len(docs)), sets(docs, *a))[1])
    texts = ["some words of a text " * 5000 for _ in range(12)]  # 105,000 characters each
    assert len(list(sj.shingle_sets(texts, sj.WordIds(sj.HELD_WORDS)))) == 12
    assert max(held) <= 5
