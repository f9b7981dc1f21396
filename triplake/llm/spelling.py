"""Grouping spelling variants: words one edit apart, the rarer pointing at the more frequent.

Two words are near if one inserted, deleted or replaced code point makes them
equal.  Near words are found by a scan of sorted lists: the edit matrix of a
word against the list keeps only its band of three cells a row, adjacent list
entries share the rows of their common prefix, and once every cell of a row
exceeds one edit all entries with that prefix are skipped.  The scan of many
words runs at once, row by row: a state is a word, a range of list entries
with the same prefix, and the band after that prefix.

On Spark: two near words whose shorter has M code points share their first or
their last ``M // 2``.  So words are listed by (M, the half they must share),
a list holding words of M and M + 1 code points; the rest of a word, its core,
is what is scanned.  A list of more than ``LIST_WORDS`` words is split by the
same rule applied to the cores, over and over, until it is short or its cores
have one code point left (a few thousand words at most then): no list grows
with the vocabulary, and no pair of lists is compared.  A pair that several
lists hold counts in the one that the rule leads to, prefix first.  Lists are
dealt over tasks by hash; a task returns a row a word, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from triplake.llm.common import ragged_index, stored, table
from triplake.llm.crc import CRC_SQL, CRC_TABLE_SQL, joined

#: Code points a word must have, and how often it must occur.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form must be this many times as frequent as its word.
FORM_RATIO = 2
#: One in this many occurrences loses a code point.
DROPPED_IN = 97
#: Words of a list that is not split further, and rows of a task, about.
LIST_WORDS = 1 << 12
TASK_ROWS = 1 << 16
#: Words scanned at once.
SCANNED = 1 << 13
#: Words that a task counts before it hands them on.
COUNTED = 1 << 18
CHUNK_CHARS = 1 << 20

_LETTERS = "A-Za-zÀ-ÿ"
_CAPITALS = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---------------------------------------------------------------- words ----
class Runs(dict):
    """run -> its number; by number its lower-cased text, the checksum of that as UTF-8 and the length of the UTF-8."""

    def __init__(self):
        super().__init__()
        self.text: list[bytes] = []  # latin-1: a byte a code point
        self.crc: list[int] = []
        self.size: list[int] = []

    def __missing__(self, run: str) -> int:
        raw = run.encode("latin-1").translate(_CAPITALS)
        utf8 = raw.decode("latin-1").encode()
        self[run] = n = len(self.text)
        self.text.append(raw), self.crc.append(zlib.crc32(utf8)), self.size.append(len(utf8))
        return n


def occurrences(docs: DataFrame, dropped_in: int = DROPPED_IN, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n)`` partial counts of the words of ``(doc_id, text)`` rows, a code point dropped from some."""

    # shorter runs give no words, whether or not they lose a code point
    pattern = re.compile(f"[{_LETTERS}]{{{least_length},}}")

    def counted(runs: Runs, counts: np.ndarray, fewer: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        n = dict(fewer)
        for t, c in zip(runs.text, counts.tolist()):  # runs that differ in capitals are one word
            if c:
                n[t] = n.get(t, 0) + c
        words, number = list(n), list(n.values())
        for i in range(0, len(words), 1 << 15):
            some = [w.decode("latin-1") for w in words[i:i + (1 << 15)]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array(number[i:i + (1 << 15)], pa.int64())],
                                             names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, counts, fewer = Runs(), np.zeros(0, np.int64), {}
        for b in batches:
            for part in _parts(b):
                found = [pattern.findall(t) if t else [] for t in part.column("text").to_pylist()]
                flat = [r for rs in found for r in rs]
                at = np.fromiter(map(runs.__getitem__, flat), np.int64, len(flat))
                counts = np.concatenate([counts, np.zeros(len(runs.text) - len(counts), np.int64)])
                # checksums of "<doc_id>:<run>"
                heads = np.array([zlib.crc32(f"{i or ''}:".encode()) for i in part.column("key").to_pylist()], np.uint32)
                used, where = np.unique(at, return_inverse=True)
                crc = np.array([runs.crc[i] for i in used.tolist()], np.uint32)[where]
                size = np.array([runs.size[i] for i in used.tolist()], np.int64)[where]
                h = joined(np.repeat(heads, [len(rs) for rs in found]), crc, size).astype(np.int64)
                hit = h % dropped_in == 0
                counts += np.bincount(at[~hit], minlength=len(counts))
                for i, x in zip(at[hit].tolist(), h[hit].tolist()):
                    t = runs.text[i]
                    if len(t) > least_length:
                        k = x % len(t)
                        t = t[:k] + t[k + 1:]
                        fewer[t] = fewer.get(t, 0) + 1
                if len(runs.text) + len(fewer) >= COUNTED:
                    yield from counted(runs, counts, fewer)
                    runs, counts, fewer = Runs(), np.zeros(0, np.int64), {}
        yield from counted(runs, counts, fewer)

    return docs.select(F.col("doc_id").cast("string").alias("key"), "text").mapInArrow(run, "word string, n long")


def _parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.array([len(t or "") for t in b.column("text").to_pylist()], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // CHUNK_CHARS)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
        yield b.slice(i, j - i)


def vocabulary(docs: DataFrame, dropped_in: int = DROPPED_IN, least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the words that occur often enough."""
    return (occurrences(docs, dropped_in, least_length).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ---------------------------------------------------------------- lists ----
def _half(m: Column, lo: Column, hi: Column) -> Column:
    return F.floor((m - lo - hi) / 2).cast("int")


def _halves(rows: DataFrame) -> DataFrame:
    """Each list row twice: its core without its first half, and without its last (of the shorter core's length)."""
    step = F.explode(F.array(F.lit("p"), F.lit("s"))).alias("_step")
    half = _half(F.col("m"), F.col("lo"), F.col("hi"))
    split = rows.select("word", "n", "m", "path", "lo", "hi", half.alias("_h"), step)
    first = F.col("_step") == "p"
    return split.select("word", "n", "m", F.concat("path", "_step").alias("path"),
                        F.when(first, F.col("lo") + F.col("_h")).otherwise(F.col("lo")).alias("lo"),
                        F.when(first, F.col("hi")).otherwise(F.col("hi") + F.col("_h")).alias("hi"))


def _key() -> Column:
    """A list: the shorter length, the steps that led to it, and the code points its words share."""
    word = F.col("word")
    return F.xxhash64("m", "path", F.substring(word, F.lit(1), F.col("lo")),
                      word.substr(F.length(word) - F.col("hi") + 1, F.col("hi")))


def word_lists(words: DataFrame, list_words: int = LIST_WORDS) -> DataFrame:
    """``(list, word, n, m, path, lo, hi)``: every word in all lists that can hold a near word."""
    size = F.length("word")
    shortest = words.agg(F.min(size)).first()[0] or 0
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m"), F.lit("").alias("path"),
                        F.lit(0).alias("lo"), F.lit(0).alias("hi")).where(F.col("m") >= shortest)
    done, rows = None, _halves(rows)
    while True:
        rows = stored(rows.withColumn("list", _key()), "spelling-lists")
        hot = stored(rows.where(_half(F.col("m"), F.col("lo"), F.col("hi")) > 0).groupBy("list").agg(
            F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_words).select("list"), "spelling-hot")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        short = rows.join(hot, "list", "left_anti").select(*rows.columns)
        done = short if done is None else done.unionByName(short)
        rows = _halves(rows.join(hot, "list", "left_semi"))


# ----------------------------------------------------------------- scan ----
def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts, first of each, length of each)."""
    length = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts) + b"\0", np.uint8), np.cumsum(length) - length, length


def common_prefixes(flat: np.ndarray, first: np.ndarray, length: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each entry with the one before; -1 at a group's first."""
    out = np.where(np.concatenate([[True], group[1:] != group[:-1]]), -1, 0)
    at, d = np.flatnonzero(out == 0), 0
    while len(at):
        at = at[(length[at] > d) & (length[at - 1] > d)]
        at = at[flat[first[at] + d] == flat[first[at - 1] + d]]
        d += 1
        out[at] = d
    return out


def scan(cores: list[bytes], group: np.ndarray, scanned: int = SCANNED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, near entry, common prefix) of all ordered pairs one edit apart, entries sorted by (group, core)."""
    flat, first, length = _flat(cores)
    common = common_prefixes(flat, first, length, group)
    starts = np.flatnonzero(common < 0)
    ends = np.append(starts[1:], len(cores))
    mine = np.cumsum(common < 0) - 1  # each entry's group, from 0
    depths = int(length.max(initial=0))
    # entries that open a range with a longer prefix, by its length
    opening: list[np.ndarray] = [np.flatnonzero((common <= d) & (length > d)) for d in range(depths)]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(0, len(cores), scanned):
        q = np.arange(k, min(k + scanned, len(cores)))
        lo, hi = starts[mine[q]], ends[mine[q]]
        # band of the row: one cell before the diagonal, the diagonal, one behind; 2 stands for more than one edit
        before, on, behind = np.full(len(q), 2, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
        behind[length[q] < 1] = 2
        same = np.zeros(len(q), np.int64)
        d = 0
        while len(q):
            over = length[lo] == d  # an entry that ends here is the first of its range
            if over.any():
                gap = length[q] - d
                cell = np.select([gap == -1, gap == 0, gap == 1], [before, on, behind], 2)
                hit = over & (cell == 1)
                if hit.any():
                    found.append((q[hit], lo[hit], same[hit]))
            if d == depths:
                break
            # ranges with one more code point in common
            a = np.searchsorted(opening[d], lo + over)
            b = np.searchsorted(opening[d], hi)
            n = b - a
            row = np.repeat(np.arange(len(q)), n)
            at = np.repeat(a, n) + ragged_index(n)
            new_lo = opening[d][at]
            following = np.append(opening[d], len(cores))[at + 1]
            new_hi = np.minimum(following, hi[row])
            q, before, on, behind, same = q[row], before[row], on[row], behind[row], same[row]
            c = flat[first[new_lo] + d]
            size, base = length[q], first[q]

            def differs(i):
                """Whether the word's code point i is another (words end: no cell there)."""
                return np.where((i >= 0) & (i < size), flat[np.clip(base + i, 0, len(flat) - 1)] != c, 2).astype(np.int8)

            x = np.minimum(np.minimum(before + differs(d - 1), on + 1), 2)
            y = np.minimum(np.minimum(on + differs(d), behind + 1), np.minimum(x + 1, 2))
            z = np.minimum(np.minimum(behind + differs(d + 1), y + 1), 2)
            # cells beyond the word's end do not exist
            x[size < d] = 2
            y[size < d + 1] = 2
            z[size < d + 2] = 2
            live = (x < 2) | (y < 2) | (z < 2)  # else all entries with this prefix are skipped
            q, lo, hi = q[live], new_lo[live], new_hi[live]
            before, on, behind = x[live].astype(np.int8), y[live].astype(np.int8), z[live].astype(np.int8)
            same = same[live] + (on == 0)
            d += 1
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(map(np.concatenate, zip(*found)))  # type: ignore[return-value]


def _leads_to(path: str, m: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Whether pairs with these shorter lengths and common prefixes belong to the list at the end of a path."""
    lo, hi, ok = np.zeros(len(m), np.int64), np.zeros(len(m), np.int64), np.ones(len(m), bool)
    for step in path:
        h = (m - lo - hi) // 2
        first = prefix >= lo + h
        ok &= first == (step == "p")
        if step == "p":
            lo = lo + h
        else:
            hi = hi + h
    return ok


def near_in_lists(t: pa.Table) -> pa.Table:
    """What the lists of one task tell of each word: near words and the best of them."""
    word = [w.encode("latin-1") for w in t.column("word").to_pylist()]
    n, m, lo, hi = (t.column(c).combine_chunks().to_numpy().astype(np.int64) for c in ("n", "m", "lo", "hi"))
    path = t.column("path").to_pylist()
    # entries sorted by what a list's words share, then by core
    entry = [(x, p, w[:i], w[len(w) - j:], w[i:len(w) - j])
             for x, p, w, i, j in zip(m.tolist(), path, word, lo.tolist(), hi.tolist())]
    order = sorted(range(len(word)), key=entry.__getitem__)
    group = np.cumsum([i > 0 and entry[order[i]][:4] != entry[order[i - 1]][:4] for i in range(len(order))])
    by = np.array(order, np.int64)
    a, b, same = scan([entry[i][4] for i in order], group)
    a, b = by[a], by[b]
    length = np.array([len(w) for w in word], np.int64)
    ok = np.minimum(length[a], length[b]) == m[a]  # longer pairs are in the lists of their own length
    kinds = {p: i for i, p in enumerate(dict.fromkeys(path))}
    kind = np.array([kinds[p] for p in path], np.int64)
    for p, i in kinds.items():
        mine = np.flatnonzero(kind[a] == i)
        ok[mine] &= _leads_to(p, m[a[mine]], lo[a[mine]] + same[mine])
    a, b = a[ok], b[ok]
    # the most frequent near word of each, the smallest of equals
    place = np.empty(len(word), np.int64)
    place[sorted(range(len(word)), key=word.__getitem__)] = np.arange(len(word))
    best = np.lexsort((place[b], -n[b], a))
    a, b = a[best], b[best]
    head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    text = lambda at: pa.array([word[i].decode("latin-1") for i in at.tolist()], pa.string())
    return pa.table({"word": text(a[head]), "n_near": pa.array(np.diff(np.append(head, len(a))), pa.int64()),
                     "best": text(b[head]), "best_n": pa.array(n[b[head]], pa.int64())})


def near_words(words: DataFrame, list_words: int = LIST_WORDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """``(word, n_near, best, best_n)`` for the words that have near words."""
    lists = word_lists(words, list_words)
    tasks = max(1, -(-lists.count() // task_rows))
    found = (lists.withColumn("_task", F.pmod("list", F.lit(tasks))).groupBy("_task").applyInArrow(
        near_in_lists, "word string, n_near long, best string, best_n long"))
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("top")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
            .select("word", "n_near", F.col("top.w").alias("best"), (-F.col("top.n")).alias("best_n")))


def follow(forms: DataFrame) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``, the last form reached.

    Every step reaches as far as two of the step before, and a form is at
    least ``FORM_RATIO`` times as frequent as its word, so some six joins
    follow the longest chain of counts below 2**63.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        new = stored(now.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                              F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        if new.where("_moved").isEmpty():
            return now
        now = new.drop("_moved")


def variants(docs: DataFrame, dropped_in: int = DROPPED_IN, least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO, list_words: int = LIST_WORDS,
             task_rows: int = TASK_ROWS) -> DataFrame:
    """``(doc_id, text)`` -> one row a word: word, form, root, n, n_near, form_n.

    Words are runs of letters up to U+00FF, lower-cased (A-Z), after the keyed
    loss of a code point in some; null and empty texts have none, a null id
    counts as an empty text in the key, repeated rows and ids count again.
    ``form``: the most frequent near word (smallest of equals) if at least
    ``ratio`` times as frequent, else null, as is ``form_n``.  ``root``: the
    last form reached, the word itself without one.  No words give no rows;
    other columns are not read.
    """
    words = stored(vocabulary(docs, dropped_in, least_length, least_count), "spelling-words")
    near = stored(near_words(words, list_words, task_rows), "spelling-near")
    is_form = F.col("best_n") >= ratio * F.col("n")
    out = stored(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "spelling-forms")
    roots = follow(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL}, runs AS (
  SELECT key, w, count(*) AS c FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY key, w
), hashed AS (
  SELECT w, c, {CRC_SQL.format(w="key || ':' || w")} AS h FROM runs, crc_table
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), places AS (
  SELECT word, unnest(range(length(word))) AS i FROM words
), without AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places
), near AS (
  SELECT x.word AS a, y.word AS b FROM without x JOIN without y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, y.word FROM without x JOIN words y ON x.rest = y.word
  UNION SELECT y.word, x.word FROM without x JOIN words y ON x.rest = y.word
), best AS (
  SELECT a AS word, b, n AS best_n, count(*) OVER (PARTITION BY a) AS n_near,
         row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place
  FROM near JOIN words ON b = word
), forms AS (
  SELECT words.word, CASE WHEN best_n >= 2 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word AND place = 1
), steps AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON steps.root = forms.word WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s ON f.word = s.word JOIN forms r ON s.root = r.word AND r.form IS NULL
"""
