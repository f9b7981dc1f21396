"""Scoring documents with prediction by partial matching over bytes.

The model is a byte-context trie of order ``ORDER`` counted over all training
documents, with escape estimation by method C (a context's escapes count as
many as its distinct symbols) and symbol exclusion (after an escape, symbols
of the longer context are left out below).  A document's score is the log10
probability of its bytes and an end mark.

On Spark: the rows of a stored table fall into chunks by file and position,
so a chunk is read twice without being shuffled.  First it emits each of its
distinct n-grams once, with their count over training documents; counts are
summed per n-gram.  The trie is then cut by the last bytes of the context:
all contexts that end in the same ``CUT`` bytes form a subtree, whose n-grams
one task turns into log probabilities (contexts shorter than that form a fixed
table of at most 258**(CUT - 1) contexts).  Each chunk's own n-grams and their
probabilities go to a folder of their own in the shared scratch folder, which
the task that reads the chunk the second time opens; no task or driver ever
holds the whole trie.  Words take the same way for the unigram base score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.lake import scratch_dir
from triplake.llm.common import slices, stored, table

#: Longest context in bytes; n-grams of ORDER context bytes and a symbol are 9 bits a symbol in a long.
ORDER = 5
#: Subtrees of the trie are told apart by this many last context bytes.
CUT = 2
#: Rows of a file that make a chunk, and rows of a chunk taken at a time: a key and a row's number share a word.
CHUNK_ROWS = 8192
RUN_BITS = 10
RUN_ROWS = 1 << RUN_BITS
BITS = 9
#: Symbols: bytes 0..255, the end of a document, and the mark before its start.
END, START = 256, 257
SYMBOLS = 257
#: Keys of words have this bit, n-grams do not.
WORD_BIT = 1 << 62
#: Key of the end token of the base score.
END_WORD = WORD_BIT
#: Words up to this many bytes are hashed side by side, eight bytes at a time.
SIDE_BY_SIDE = 64


def held_out(doc_id, modulus: int = 7, remainder: int = 2):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(key of every symbol in its context, length of each text with its end).

    A key holds the context, nearest byte highest, and then the symbol; so keys
    of contexts with a common end are next to each other.
    """
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    pad = b"\0" * order
    raw = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8).astype(np.int64)
    starts = np.cumsum(lengths + order) - lengths  # first symbol of each text
    for i in range(1, order + 1):
        raw[starts - i] = START
    raw[starts + lengths - 1] = END
    # the keys of all places of the padded bytes, then those of symbols
    key = raw[order - 1:-1].copy()
    for i in range(2, order + 2):
        np.left_shift(key, BITS, out=key)
        np.bitwise_or(key, raw[order - i:-i] if i <= order else raw[order:], out=key)
    keep = np.ones(len(key), bool)  # but for the marks between two texts
    for i in range(1, order + 1):
        keep[starts[1:] - order - i] = False
    return key[keep], lengths


def context(key, length: int, order: int = ORDER):
    """The context of a key's ``length`` nearest bytes."""
    return key >> BITS * (order + 1 - length)


def _mixed(h: np.ndarray) -> np.ndarray:
    """SplitMix64's last steps: a permutation of the 64-bit integers."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte strings of these lengths, one behind the other in ``data``."""
    starts = np.cumsum(lengths) - lengths
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    h = _mixed(lengths.astype(np.uint64))
    on = np.flatnonzero(lengths <= SIDE_BY_SIDE)
    for i in range(0, SIDE_BY_SIDE, 8):
        on = on[lengths[on] > i]
        if not len(on):
            break
        beyond = np.maximum(8 * (i + 8 - lengths[on]), 0).astype(np.uint64)
        h[on] = _mixed(h[on] ^ eight[starts[on] + i] << beyond)
    for i in np.flatnonzero(lengths > SIDE_BY_SIDE):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i]:starts[i] + lengths[i]])
    return h


def _word_keys(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(key of every word and of the end token, tokens of each text)."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    words, row = split.flatten(), pc.list_parent_indices(split).to_numpy()
    data = words.buffers()[2]
    size = pc.binary_length(words).to_numpy().astype(np.int64)
    row, size = row[size > 0], size[size > 0]  # white space at an end leaves an empty word
    lengths = np.bincount(row, minlength=len(text)) + 1
    keys = np.full(int(lengths.sum()), END_WORD, np.int64)
    h = _hashes(np.frombuffer(data or b"", np.uint8), size)
    keys[np.arange(len(row)) + row] = (h >> np.uint64(2)).astype(np.int64) | WORD_BIT
    return keys, lengths


def _nodes(ctx: np.ndarray, sym: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """Contexts of one order from sorted (context, symbol, count) with counts above 0."""
    first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
    return {"ctx": ctx[first], "total": np.add.reduceat(count, first) if len(first) else first,
            "kinds": np.diff(np.append(first, len(ctx)))}


def _summed(ctx: np.ndarray, sym: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (context, symbol) pairs added up, in order."""
    pair = ctx << BITS | sym
    by = np.argsort(pair, kind="stable")
    pair, count = pair[by], count[by]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
    pair = pair[first]
    return pair >> BITS, pair & ((1 << BITS) - 1), np.add.reduceat(count, first) if len(first) else first


def _find(table_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, found) of x in a sorted array."""
    if not len(table_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(table_, x), len(table_) - 1)
    return at, table_[at] == x


def log_probabilities(keys: np.ndarray, counts: np.ndarray, lower: dict[int, tuple], order: int = ORDER) -> np.ndarray:
    """log10 probability of each distinct key of one subtree, given its training counts.

    ``lower``: (context, symbol, count) arrays, sorted, of the orders below CUT.
    """
    seen = counts > 0
    tables = {}
    for n in range(order, -1, -1):
        if n in lower:
            ctx, sym, c = lower[n]
        else:
            ctx, sym, c = _summed(context(keys[seen], n, order), keys[seen] & ((1 << BITS) - 1), counts[seen])
        tables[n] = (ctx << BITS | sym, c, _nodes(ctx, sym, c))
    # what each longer context's symbols count in the shorter one: left out there after an escape
    out = {}
    for n in range(1, order + 1):
        pair, _, node = tables[n]
        shorter_pair, shorter_count, _ = tables[n - 1]
        ctx, sym = pair >> BITS, pair & ((1 << BITS) - 1)
        at, found = _find(shorter_pair, context(ctx << BITS * (order + 1 - n), n - 1, order) << BITS | sym)
        c = np.where(found, shorter_count[at] if len(shorter_count) else 0, 0)
        first = np.searchsorted(ctx, node["ctx"])
        out[n] = np.add.reduceat(c, first) if len(first) else first
    sym = keys & ((1 << BITS) - 1)
    logp = np.zeros(len(keys))
    open_ = np.ones(len(keys), bool)
    excluded = np.zeros(len(keys))  # count of the symbols left out, and their number
    kinds_out = np.zeros(len(keys))
    for n in range(order, -1, -1):
        pair, count, node = tables[n]
        todo = np.flatnonzero(open_)
        ctx = context(keys[todo], n, order)
        at, known = _find(node["ctx"], ctx)
        todo, ctx, at = todo[known], ctx[known], at[known]
        if not len(todo):
            continue
        total, kinds = node["total"][at] - excluded[todo], node["kinds"][at] - kinds_out[todo]
        hit_at, hit = _find(pair, ctx << BITS | sym[todo])
        here = todo[hit]
        logp[here] += np.log10(count[hit_at[hit]] / (total + kinds)[hit])
        open_[here] = False
        miss = ~hit
        # an escape; without a symbol left here it costs nothing
        some = miss & (kinds > 0)
        logp[todo[some]] += np.log10(kinds[some] / (total + kinds)[some])
        gone = todo[miss]
        kinds_out[gone] = node["kinds"][at[miss]]
        excluded[gone] = out[n][at[miss]] if n else 0
    left = np.flatnonzero(open_)
    logp[left] -= np.log10(np.maximum(1, SYMBOLS - kinds_out[left]))
    return logp


def _bytes(b: pa.RecordBatch) -> list[bytes]:
    return [(x or "").encode("utf-8", "surrogatepass") for x in b.column("text").to_pylist()]


def in_chunks(docs: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """``(doc_id, text, held_out)`` of a stored table with ``chunk``: its file and the block of rows in it."""
    at = F.concat_ws("#", F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / rows))
    return docs.select("doc_id", "text", "held_out", F.xxhash64(at).alias("chunk"))


def _runs(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(chunk, rows of it) in the order read, about ``size`` characters and at most ``RUN_ROWS`` rows at a time."""
    for b in slices(batches, RUN_ROWS):
        chunk = b.column("chunk").to_numpy()
        length = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(length, dtype=np.int64) // size
        cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | (part[1:] != part[:-1])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if j > i:
                yield int(chunk[i]), b.slice(i, j - i)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(x) for x in zip(*parts))
    by = np.argsort(key, kind="stable")
    key, n = key[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _counted(k: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, how many of each are learned): a key and its mark are sorted as one word."""
    both = np.sort(k.astype(np.uint64) << np.uint64(1) | learned)
    key = (both >> np.uint64(1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat((both & np.uint64(1)).astype(np.int64), first)


def _sums(k: np.ndarray, lengths: np.ndarray, key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's keys: keys are sorted with their text's number and looked up once each."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    both = np.sort(k.astype(np.uint64) << np.uint64(RUN_BITS) | row.astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    times, both = np.diff(np.append(first, len(both))), both[first]
    k = (both >> np.uint64(RUN_BITS)).astype(np.int64)
    new = np.concatenate([[True], k[1:] != k[:-1]])
    v = value[np.searchsorted(key, k[new])][np.cumsum(new) - 1]
    return np.bincount((both & np.uint64(RUN_ROWS - 1)).astype(np.int64), v * times, len(lengths))


def _chunk_counts(chunks: DataFrame) -> DataFrame:
    """(chunk, key, n): the distinct keys of each chunk and their training counts.

    A chunk that is read in two parts has a row for each; the sums are the same.
    """
    def out(chunk: int, parts: list) -> Iterator[pa.RecordBatch]:
        key, n = _merged(parts)
        for i in range(0, len(key), 1 << 16):
            k = key[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk)), pa.array(k), pa.array(n[i:i + (1 << 16)])],
                                             names=["chunk", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for chunk, b in _runs(batches):
            if chunk != now:
                if parts:
                    yield from out(now, parts)
                now, parts = chunk, []
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            for k, lengths in (grams(_bytes(b)), _word_keys(b.column("text"))):
                parts.append(_counted(k, np.repeat(train, lengths)))
            if len(parts) >= 8:
                parts = [_merged(parts)]
        if parts:
            yield from out(now, parts)

    return chunks.select("chunk", "text", "held_out").mapInArrow(run, "chunk long, key long, n long")


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def score(chunks: DataFrame) -> DataFrame:
    """``(doc_id, text, held_out, chunk)`` -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``chunk`` must be the same whenever a row is read (see ``in_chunks``) and
    rows of a chunk should be read together.  Learns from the rows that are
    not held out.  A null text counts as empty (its end is scored); null or
    repeated ids are rows of their own; without a training document every
    symbol has probability 1/257 and no word is known.
    """
    spark = chunks.sparkSession
    own = stored(_chunk_counts(chunks), "ppm-chunks")
    counts = stored(own.groupBy("key").agg(F.sum("n").alias("n")), "ppm-counts")
    is_word = F.col("key") >= F.lit(WORD_BIT)
    words, trie = counts.where(is_word), counts.where(~is_word)
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()

    # orders below CUT: at most 257 symbols after each of 258**n contexts
    lower = {}
    for k in range(CUT):
        ctx = F.shiftright("key", BITS * (ORDER + 1 - k)) if k else F.lit(0).cast("long")
        t = (trie.where("n > 0").groupBy(ctx.alias("c"), F.col("key").bitwiseAND(F.lit((1 << BITS) - 1)).alias("s"))
             .agg(F.sum("n").alias("n")).orderBy("c", "s").toPandas())
        lower[k] = tuple(t[x].to_numpy(np.int64) for x in ("c", "s", "n"))

    def subtree(t: pa.Table) -> pa.Table:
        k = t.column("key").combine_chunks().to_numpy()
        return pa.table({"key": k, "v": log_probabilities(k, t.column("n").combine_chunks().to_numpy(), lower)})

    # v: log10 probability of an n-gram, training count of a word
    v = (trie.withColumn("cut", F.shiftright("key", BITS * (ORDER + 1 - CUT)))
         .groupBy("cut").applyInArrow(subtree, "key long, v double")
         .unionByName(words.select("key", F.col("n").cast("double").alias("v"))))
    model = scratch_dir(spark, "ppm-model")
    (own.select("chunk", "key").join(v, "key").repartition("chunk").sortWithinPartitions("chunk", "key")
     .write.partitionBy("chunk").parquet(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for chunk, b in _runs(batches):
            if chunk != now:
                fs, path = _folder(f"{model}/chunk={chunk}")
                t = pq.read_table(path, filesystem=fs, columns=["key", "v"], partitioning=None)
                key, value = t.column("key").to_numpy(), t.column("v").to_numpy()
                if (key[1:] < key[:-1]).any():  # in several files
                    by = np.argsort(key, kind="stable")
                    key, value = key[by], value[by]
                now = chunk
            total = _sums(*grams(_bytes(b)), key, value)
            k, lengths = _word_keys(b.column("text"))
            first = np.cumsum(lengths) - lengths
            u, at = np.unique(k, return_inverse=True)
            c = value[np.searchsorted(key, u)][at]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lengths),
                 pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), pa.array(np.full(b.num_rows, tokens)),
                 pa.array(np.add.reduceat(np.log10((c + 1) / (tokens + distinct + 1)), first)), pa.array(total)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return chunks.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    return score(in_chunks(docs))
