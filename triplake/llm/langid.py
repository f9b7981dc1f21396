"""Language identification of mixed-language text.

A word's script (a table of code-point ranges) narrows the languages it can
be in; character n-grams score the word under each of those; the Viterbi
path over the document's words, with a penalty for every switch of language,
labels spans.  The document's language is the one with most letters.

The model is one count per (language, hashed n-gram): ``TABLE_BITS`` bounds
its size, ``SAMPLE_DOCS`` the labelled documents it is fitted on.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from triplake.llm.common import ragged_index, slices, table

#: Labelled documents of a language that the model is fitted on, at most (those of smallest hash).
SAMPLE_DOCS = 3000
#: Hashed n-grams: 2**TABLE_BITS counts a language.
TABLE_BITS = 16
GRAMS = (1, 2, 3)
#: Log-likelihood that a switch of language costs.
SWITCH = 12.0
#: A language is a candidate for a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words remembered by a task, characters of text held at a time.
REMEMBERED = 1 << 15
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"

# First code points of the blocks of each script.
SCRIPTS = ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian",
           "hangul", "kana", "han", "other")
RANGES = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
          (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
          (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
          (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"),
          (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
          (0xF900, "han"), (0xFB00, "other"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"))
_STARTS = np.array([r[0] for r in RANGES])
_SCRIPT = np.array([SCRIPTS.index(r[1]) for r in RANGES])


def _class(belongs: Callable[[str], bool], last: int) -> str:
    """The code points up to ``last`` that belong, as the inside of a character class."""
    inside = [belongs(chr(c)) for c in range(last + 1)]
    edges = [c for c in range(len(inside)) if inside[c] != (c > 0 and inside[c - 1])] + [len(inside)]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


_ASCII = re.compile(r"[A-Za-z]+")


@lru_cache(maxsize=2)
def _words(last: int) -> re.Pattern:
    """A letter and the letters and marks behind it, in texts up to that code point; number signs are no letters."""
    numbers = _class(lambda c: c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L", last)
    marks = _class(lambda c: unicodedata.category(c)[0] == "M", last)
    return re.compile(rf"[^\W\d_{numbers}]+(?:[{marks}]+[^\W\d_{numbers}]*)*")


def words_of(text: str | None) -> list[str]:
    """Words of letters and their marks, lower-cased."""
    if not text:
        return []
    if text.isascii():
        return _ASCII.findall(text.lower())
    # classes within the first plane are looked up in a table
    first_plane = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return _words(0xFFFF if first_plane else sys.maxunicode).findall(text.lower())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed n-grams of all words, their number per word, script per word); a word is bounded by marks."""
    chars = np.frombuffer("".join(f"\0{w}\0" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(w) for w in words], np.int64) + 2
    starts = np.cumsum(lengths) - lengths
    script = _SCRIPT[np.searchsorted(_STARTS, chars[starts + 1], "right") - 1]
    codes = chars.astype(np.uint64) + np.uint64(1)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(chars))  # characters up to the word's end
    grams = np.full((len(chars), len(GRAMS)), -1, np.int64)
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h[:len(chars) - n + 1] = h[:len(chars) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        if n in GRAMS:
            mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - TABLE_BITS)
            grams[:, GRAMS.index(n)] = np.where(left >= n, mixed.astype(np.int64), -1)
    keep = grams >= 0
    return grams[keep], np.add.reduceat(keep.sum(1), starts) if len(words) else np.zeros(0, np.int64), script


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # (2**TABLE_BITS, languages)
    allowed: np.ndarray  # (scripts, languages)

    def scores(self, words: list[str]) -> np.ndarray:
        """(words, languages) log-likelihoods; languages that do not use the word's script are out of reach."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for k in range(0, len(words), 1 << 13):
            grams, number, script = word_grams(words[k:k + (1 << 13)])
            out[k:k + (1 << 13)] = np.add.reduceat(self.logp[grams], np.cumsum(number) - number)
            out[k:k + (1 << 13)][~self.allowed[script]] = -1e4
        return out


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """``(doc_id, text, lang)`` rows -> model; rows without a language are not used.

    Fitted on ``sample_docs`` documents of each language, those of smallest
    hash (where the hashes of a language's rows crowd, as those of equal rows,
    fewer may lie in the share of the range that holds twice as many).
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("_h"))
    # a row a language: hashes that can be among the smallest lie in a share of their range, so few meet to be ranked
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * sample_docs).collect()
    for r in sizes:
        bound = int((2 * sample_docs / r["n"] - 0.5) * float(1 << 64))
        rows = rows.where((F.col("lang") != r["lang"]) | (F.col("_h") <= bound))
    # ranks of hashes alone, cut to sample_docs a language in every task before they meet
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    chosen = (rows.select("lang", "_h").withColumn("_k", rank).where(F.col("_k") <= sample_docs).select("lang", "_h"))
    # at most sample_docs rows a language
    sample = rows.join(F.broadcast(chosen), ["lang", "_h"], "left_semi").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        size = 1 << TABLE_BITS
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                c = seen.setdefault(lang, np.zeros(size + len(SCRIPTS), np.int64))
                if words := words_of(text):
                    grams, _, script = word_grams(words)
                    c[:size] += np.bincount(grams, minlength=size)
                    c[size:] += np.bincount(script, [len(w) for w in words], len(SCRIPTS)).astype(np.int64)
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "cell", "n"])

    # at most languages * (2**TABLE_BITS + scripts) rows
    cells = (sample.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell")
             .agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(cells["lang"].unique())
    counts = np.zeros((len(languages), (1 << TABLE_BITS) + len(SCRIPTS)))
    if languages:
        counts[np.searchsorted(languages, cells["lang"]), cells["cell"]] = cells["n"]
    grams, letters = counts[:, :1 << TABLE_BITS], counts[:, 1 << TABLE_BITS:]
    logp = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * grams.shape[1])).T.astype(np.float32)
    allowed = (letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(1, keepdims=True))).T
    allowed[~allowed.any(1)] = True  # no language uses the script: no narrowing
    return Model(languages, np.ascontiguousarray(logp), allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of every word of consecutive documents (``lengths`` words each, none of 0).

    All documents advance together, one word at a time, longest first; each
    word keeps where its best path comes from.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # documents with a word at each step
    at = np.concatenate([[0], np.cumsum(active)])
    # word order by step, then document
    where = np.empty(int(lengths.sum()), np.int64)
    t = ragged_index(lengths)
    where[at[t] + np.repeat(np.arange(len(lengths)), lengths)] = np.repeat(starts, lengths) + t
    s = scores[where]
    stay = np.empty(s.shape, bool)
    best = np.empty(len(s), np.int16)
    d = np.zeros((len(lengths), s.shape[1]), np.float32)
    for i in range(steps):
        a, lo, hi = active[i], at[i], at[i + 1]
        now = d[:a]
        top = now.max(1, keepdims=True)
        best[lo:hi] = now.argmax(1)
        now -= top  # only differences matter
        stay[lo:hi] = now >= -switch
        np.maximum(now, -switch, out=now)
        now += s[lo:hi]
    state = d.argmax(1).astype(np.int16)
    out = np.empty(len(s), np.int16)
    for i in range(steps - 1, -1, -1):
        a, lo, hi = active[i], at[i], at[i + 1]
        out[lo:hi] = state[:a]
        kept = stay[lo:hi][np.arange(a), state[:a]]
        state[:a] = np.where(kept, state[:a], best[lo:hi])
    labels = np.empty(len(s), np.int16)
    labels[where] = out
    return labels


class Labeller:
    """Labels the words of texts, remembering the scores of words."""

    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch, self.row = model, switch, {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def label(self, docs: list[list[str]]) -> Iterator[np.ndarray]:
        new = list({w for d in docs for w in d if w not in self.row})
        if len(self.row) + len(new) > REMEMBERED:  # the words of these texts stay, the others go
            held = list({w for d in docs for w in d if w in self.row})
            self.scores = self.scores[[self.row[w] for w in held]]
            self.row = dict(zip(held, range(len(held))))
        if new:
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
            self.scores = np.concatenate([self.scores, self.model.scores(new)])
        lengths = np.array([len(d) for d in docs], np.int64)
        if not self.model.languages:
            yield from (np.zeros(n, np.int16) for n in lengths.tolist())
            return
        rows = np.fromiter((self.row[w] for d in docs for w in d), np.int64, int(lengths.sum()))
        labels = viterbi(self.scores[rows], lengths[lengths > 0], self.switch) if len(rows) else rows
        yield from np.split(labels, np.cumsum(lengths)[:-1])

    def each(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
        """(words, labels) of each text, a bounded number of characters at a time."""
        part, chars = [], 0
        for i, t in enumerate(texts):
            part.append(words_of(t))
            chars += len(t or "")
            if chars >= CHUNK_CHARS or i == len(texts) - 1:
                yield from zip(part, self.label(part))
                part, chars = [], 0


def spans(labels: np.ndarray) -> list[tuple[int, int]]:
    """(first word, label) of each run of one label."""
    if not len(labels):
        return []
    first = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]]))
    return list(zip(first.tolist(), labels[first].tolist()))


OUT = ("lang_pred", "score", "spans")


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """The columns of ``docs`` with lang_pred, score (share of letters) and spans (first word, language).

    Columns of these names are replaced.  A null text or one without a letter
    is ``und`` with score 0 and no spans, as is every text under a model
    fitted on no documents.  Ties go to the language first in code-point order.
    """
    kept = docs.drop(*OUT)
    at = kept.columns.index("text")
    schema = kept.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                         F.lit(None).cast("array<struct<first_word:int,lang:string>>").alias("spans")).schema
    span_type = pa.list_(pa.struct([("first_word", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, switch)
        names = model.languages
        for b in slices(batches):
            pred, score, parts = [], [], []
            for words, labels in labeller.each(b.column(at).to_pylist()):
                if not words or not names:
                    pred.append(UNKNOWN), score.append(0.0), parts.append([])
                    continue
                letters = np.bincount(labels, [len(w) for w in words], len(names))
                pred.append(names[int(letters.argmax())])
                score.append(float(letters.max() / letters.sum()))
                parts.append([{"first_word": i, "lang": names[k]} for i, k in spans(labels)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(parts, span_type)],
                names=[*b.schema.names, *OUT])

    return kept.mapInArrow(run, schema)


def held_out(doc_id, modulus: int = 4, remainder: int = 2):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(training_rows(docs))
    return (identify(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                    F.size("spans").cast("long").alias("n_spans")))
