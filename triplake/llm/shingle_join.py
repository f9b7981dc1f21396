"""N-gram Jaccard join by T-occurrence search over inverted lists of word shingles.

Two sets of sizes n and m with Jaccard >= t share at least ``T`` shingles.
Sorted by hash, the first ``k = r + l`` shingles of a set (``r = n - T(n)``,
``l = r + 1``) share at least ``min(l, l')`` with those of any partner, so
the search for T occurrences runs on these leading parts.  As in DivideSkip
a set's lists are divided by length: a partner must occur in at least one of
its ``k - tau + 1`` shortest lists, so only those are merged; the long rest
is not merged but probed by binary search.

On Spark: equal sets become one class first.  Leading parts are shuffled by
hash range, packed; each range sorts its postings (the merge) and returns the
lists with two classes or more, packed by buckets of classes; a bucket picks
each class's shortest lists.  Shingles in over ``1/HOT_LISTS`` of all
postings (so at most ``HOT_LISTS`` of them, a bounded broadcast) order last
and are left out by every set with enough other shingles, so no list that
must be merged grows with the input's most frequent passages.  Sets that meet
in a short list, next to each other by size, form clusters (connected
components), which hold every similar pair.  Clusters are dealt into blocks,
and each pair of blocks is searched once with whole sets, again by DivideSkip;
it verifies every candidate and returns, for each set, the number of documents
linked and at most one link, so a large group of near copies is counted but
never written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from triplake.llm.common import WordIds, connected_components, ragged_index, slices, stored, table, text_words

SHINGLE_WORDS = 5
PERCENT = 80
#: A shingle in at least 1/HOT_LISTS of all postings (and 256 of them) is hot.
HOT_LISTS = 1 << 17
HOT_LEAST = 256
#: Postings of a hash range, about.
RANGE_POSTINGS = 1 << 18
#: Sets of a block, and shingles of all its sets, about.
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 18
#: Weight of probing against merging when a query's lists are divided.
DIVIDE = 0.05
#: Slots of the filter that picks texts to read again.
SLOTS = 1 << 22
#: Characters of text held at a time as words.
CHUNK_CHARS = 1 << 19
#: Words whose hashes a task remembers.
HELD_WORDS = 1 << 15

#: What a list holds of a class: its size, the lists it must merge beyond its cold ones, the length of this list.
POSTING = np.dtype([("h", np.uint64), ("fp", np.int64), ("n", np.int32), ("need", np.int32), ("df", np.int64)])

_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def slack(n, percent: int):
    """Shingles that a set of n may have outside a partner: n - ceil(n * percent / 100)."""
    return n * (100 - percent) // 100


def leading(n, percent: int):
    """Leading shingles (by hash) of a set of n that take part in the search."""
    return np.minimum(2 * slack(n, percent) + 1, n)


def short_lists(n, percent: int):
    """How many of a set's shortest lists must be merged."""
    return leading(n, percent) - slack(n - slack(n, percent), percent)


def shingle_sets(texts: list[str | None], words: WordIds, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    part, chars = [], 0
    for t in texts:
        part.append(text_words(t))
        chars += len(t or "")
        if chars >= CHUNK_CHARS:
            yield from _sets(part, words, size)
            part, chars = [], 0
    yield from _sets(part, words, size)


def _sets(docs: list[list[bytes]], words: WordIds, size: int) -> Iterator[np.ndarray]:
    lengths = np.array([len(d) for d in docs], np.int64)
    total = int(lengths.sum())
    ids = np.fromiter((words[w] for d in docs for w in d), np.uint64, total)
    n = max(0, total - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = ((h ^ (h >> np.uint64(29))) * _ODD[i % 5]) + ids[i:i + n]
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    starts = np.cumsum(lengths) - lengths
    for d, at, length in zip(docs, starts.tolist(), lengths.tolist()):
        if length >= size:
            s = np.sort(h[at:at + length - size + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        else:
            yield np.array([xxhash.xxh3_64_intdigest(b" ".join(d), size)] if d else [], np.uint64)


def document_sets(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row a document: size n and fingerprint of its set, and the set's leading part (once a class and task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordIds(HELD_WORDS), set()
        for b in slices(batches):
            ids = b.column("doc_id").to_pylist()
            n, fp, lead = [], [], []
            for doc_id, s in zip(ids, shingle_sets(b.column("text").to_pylist(), words, size)):
                n.append(len(s))
                f = None
                if len(s) and doc_id is not None:
                    f = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                fp.append(f)
                lead.append(s[:int(leading(len(s), percent))].tobytes() if f is not None and f not in seen else None)
                seen.add(f)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()),
                 pa.array(lead, pa.binary())], names=["doc_id", "text_hash", "n", "fp", "lead"])

    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, n long, fp long, lead binary"))


def _unpack(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, owner's row, lengths) of the leading parts of a batch."""
    parts = b.column("lead").to_pylist()
    lengths = np.array([len(p) // 8 for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint64), np.repeat(np.arange(len(parts)), lengths), lengths


def _is_hot(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(h), bool)
    return hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h


def hot_shingles(sets: DataFrame, postings: int) -> np.ndarray:
    """The shingles with at least max(HOT_LEAST, postings / HOT_LISTS) postings, counted where a batch has its share."""
    least = max(HOT_LEAST, postings // HOT_LISTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, c = np.unique(_unpack(b)[0], return_counts=True)
            keep = c >= max(2, c.sum() * least // max(1, postings))
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(c[keep].astype(np.int64))],
                                             names=["h", "c"])

    rows = (sets.select("lead").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
            .where(F.col("c") >= least).select("h").collect())  # at most HOT_LISTS rows
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


def short_shared_lists(sets: DataFrame, hot: np.ndarray, ranges: int, percent: int) -> DataFrame:
    """(fp, n, h) for the lists with two classes or more among the shortest lists that each class must merge.

    Shared postings move from the hash ranges to as many buckets of classes
    packed, a row for each range and bucket.
    """
    shift = np.uint64(64 - max(1, (ranges - 1).bit_length()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, owner, _ = _unpack(b)
            n = np.asarray(b.column("n"))
            cold = ~_is_hot(h, hot)
            # lists to merge, without those (cold ones that no other class holds) that lead nowhere
            need = short_lists(n, percent) - np.bincount(owner[cold], minlength=len(n))
            keep = cold | (need > 0)[owner]
            h, owner = h[keep], owner[keep]
            order = np.argsort(h)
            h, owner = h[order], owner[order]
            rows = np.zeros(len(h), POSTING)
            rows["h"], rows["fp"], rows["n"], rows["need"] = h, np.asarray(b.column("fp"))[owner], n[owner], need[owner]
            at = np.flatnonzero(np.diff(h >> shift)) + 1
            cuts = np.concatenate([[0], at, [len(h)]]) if len(h) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(h[i] >> shift) for i in cuts[:-1]], pa.int64()),
                 pa.array([rows[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())],
                names=["range", "rows"])

    def unpacked(t: pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(t.column("rows").to_pylist()), POSTING)

    def merge(t: pa.Table) -> pa.Table:
        rows = unpacked(t)
        rows = rows[np.lexsort((rows["fp"], rows["h"]))]
        h, fp = rows["h"], rows["fp"]
        new = np.ones(len(rows), bool)
        new[1:] = (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])
        rows = rows[new]
        first = np.flatnonzero(np.concatenate([[True], rows["h"][1:] != rows["h"][:-1]]))
        df = np.diff(np.append(first, len(rows)))
        rows["df"] = np.repeat(df, df)
        rows = rows[rows["df"] >= 2]
        bucket = (rows["fp"].view(np.uint64) % np.uint64(ranges)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        rows, bucket = rows[by], bucket[by]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(rows))
        return pa.table({"bucket": pa.array(bucket[cuts[:-1]], pa.int64()),
                         "rows": pa.array([rows[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())})

    def pick(t: pa.Table) -> pa.Table:
        rows = unpacked(t)
        signed, is_hot = rows["h"].view(np.int64), _is_hot(rows["h"], hot)
        by = np.lexsort((signed, rows["df"], is_hot, rows["fp"]))
        rows, is_hot = rows[by], is_hot[by]
        first = np.flatnonzero(np.concatenate([[True], rows["fp"][1:] != rows["fp"][:-1]]))
        lengths = np.diff(np.append(first, len(rows)))
        lists = rows["need"][first] + np.add.reduceat((~is_hot).astype(np.int64), first)
        rows = rows[ragged_index(lengths) < np.repeat(lists, lengths)]
        return pa.table({"fp": pa.array(rows["fp"]), "n": pa.array(rows["n"].astype(np.int64)), "h": pa.array(rows["h"].view(np.int64))})

    return (sets.select("fp", "n", "lead").mapInArrow(pack, "range long, rows binary")
            .groupBy("range").applyInArrow(merge, "bucket long, rows binary")
            .groupBy("bucket").applyInArrow(pick, "fp long, n long, h long"))


def slot(c) -> F.Column:
    return F.pmod(F.xxhash64(c), F.lit(SLOTS))


def slot_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the slots that ids fall in: SLOTS bits however many ids."""
    bits = np.zeros(SLOTS, bool)
    for r in ids.select(slot(ids.columns[0]).alias("s")).distinct().toLocalIterator():
        bits[r.s] = True
    return np.packbits(bits)


def _in_slots(batch: pa.RecordBatch, bits: np.ndarray) -> np.ndarray:
    s = np.asarray(batch.column("_slot"))
    return (bits[s >> 3] >> (7 - (s & 7)) & 1).astype(bool)


def by_slot(df: DataFrame, column: str, bits: np.ndarray, inside: bool) -> DataFrame:
    """Rows whose id falls in a marked slot (or none of them); ids outside the set may fall in, never the reverse."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = _in_slots(b, bits)
            yield b.filter(pa.array(hit if inside else ~hit))

    wide = df.withColumn("_slot", slot(column))
    return wide.mapInArrow(run, wide.schema).drop("_slot")


def whole_sets(docs: DataFrame, bits: np.ndarray, size: int) -> DataFrame:
    """(fp, set) of the classes of the marked documents, from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(HELD_WORDS)
        for b in slices(batches):
            b = b.filter(pa.array(_in_slots(b, bits)))
            raw = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), words, size)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in raw], pa.int64()),
                 pa.array(raw, pa.binary())], names=["fp", "set"])

    chosen = docs.where("doc_id IS NOT NULL").select("text", slot("doc_id").alias("_slot"))
    return chosen.mapInArrow(run, "fp long, set binary").groupBy("fp").agg(F.first("set").alias("set"))


def t_occurrence(queries: list[np.ndarray], rows: list[np.ndarray], percent: int, same: bool) -> Iterator[tuple[int, int, bool]]:
    """DivideSkip: (query, row) pairs that reach the similarity, and whether the pair joins two local components.

    A query's lists over ``rows`` are divided: all but the longest are merged
    (owners counted), rows with enough occurrences are probed for the longest
    by binary search.  ``same``: both are the same sets, so pairs count once.
    """
    sizes = np.array([len(r) for r in rows])
    h = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), sizes)
    by = np.argsort(h, kind="stable")
    h, owner = h[by], owner[by]
    root = list(range(len(queries) + len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for q, x in enumerate(queries):
        least = len(x) - slack(len(x), percent)  # T for the smallest partner there can be
        first, last = np.searchsorted(h, x, "left"), np.searchsorted(h, x, "right")
        length = last - first
        most = int(length.max())
        skip = min(least - 1, int(least / (DIVIDE * np.log2(most + 1) + 1)))
        order = np.argsort(length, kind="stable")
        short, long = order[:len(x) - skip], x[order[len(x) - skip:]]
        at = np.repeat(first[short], length[short]) + ragged_index(length[short])
        count = np.bincount(owner[at], minlength=len(rows))
        near = (count >= least - skip) & (100 * np.minimum(sizes, len(x)) >= percent * np.maximum(sizes, len(x)))
        for r in np.flatnonzero(near).tolist():
            me, other = (q, r) if same else (q, len(queries) + r)
            if same and r >= q:
                continue
            y = rows[r]
            both = int(count[r]) + int((y[np.minimum(np.searchsorted(y, long), len(y) - 1)] == long).sum())
            if 100 * both >= percent * (len(x) + len(y) - both):
                joins = find(me) != find(other)
                root[find(me)] = find(other)
                yield q, r, joins


def similar_classes(docs: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """(node, component, links) of the classes with a link to another class; links: documents in all those classes."""
    lead = sets.where("lead IS NOT NULL")
    postings = lead.agg(F.sum(F.expr("length(lead) div 8"))).first()[0] or 0
    hot = hot_shingles(lead, postings)
    ranges = max(1, -(-postings // RANGE_POSTINGS))
    short = stored(short_shared_lists(lead, hot, ranges, percent), "jaccard-lists")
    # neighbours by size in each list: sets that can be partners end up in one cluster
    by_size = Window.partitionBy("h").orderBy("n", "fp")
    chain = (short.select("fp", "n", F.lag("fp").over(by_size).alias("v"), F.lag("n").over(by_size).alias("vn"))
             .where(100 * F.col("vn") >= percent * F.col("n")).select(F.col("fp").alias("src"), F.col("v").alias("dst")))
    clusters = stored(connected_components(chain, "jaccard-clusters")
                      .join(short.select(F.col("fp").alias("node"), "n").distinct(), "node")
                      .select(F.col("node").alias("fp"), F.col("component").alias("cluster"), "n"), "jaccard-members")
    involved = clusters.select("fp").join(classes.select("fp", "rep"), "fp").select("rep")
    whole = whole_sets(docs, slot_filter(involved), size)
    blocks = clusters.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    cells = (clusters.join(blocks, "cluster").join(classes.select("fp", "copies"), "fp").withColumn("block", F.pmod(F.xxhash64("fp", "cluster"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("fp", "cluster", "copies", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))

    def search(t: pa.Table) -> pa.Table:
        fp = t.column("fp").combine_chunks().to_numpy()
        block = t.column("block").combine_chunks().to_numpy()
        copies = t.column("copies").combine_chunks().to_numpy()
        raw = t.column("set").to_pylist()
        a, b = np.flatnonzero(block == t.column("lo")[0].as_py()), np.flatnonzero(block == t.column("hi")[0].as_py())
        found = []
        if len(a) and len(b):
            part = lambda at: [np.frombuffer(raw[i], np.uint64) for i in at.tolist()]
            same = t.column("lo")[0] == t.column("hi")[0]
            found = list(t_occurrence(part(a), part(b), percent, same))
        q, r, joins = np.array(found, np.int64).reshape(-1, 3).T
        n = (np.bincount(a[q], copies[b[r]], len(fp)) + np.bincount(b[r], copies[a[q]], len(fp))).astype(np.int64)
        linked, q, r = np.flatnonzero(n), q[joins == 1], r[joins == 1]
        return pa.table({
            "src": np.concatenate([fp[a[q]], fp[linked]]),
            "dst": pa.array(np.concatenate([fp[b[r]], fp[linked]])),  # a loop carries the number
            "links": np.concatenate([np.zeros(len(q), np.int64), n[linked]])})

    links = stored(cells.join(whole, "fp").select("cluster", "lo", "hi", "block", "fp", "copies", "set")
                   .groupBy("cluster", "lo", "hi").applyInArrow(search, "src long, dst long, links long"), "jaccard-links")
    counts = links.where("links > 0").groupBy(F.col("src").alias("node")).agg(F.sum("links").alias("links"))
    return stored(connected_components(links.select("src", "dst"), "jaccard-components").join(counts, "node"), "jaccard-labels")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row a document: doc_id, text_hash, n_shingles, component_id, n_links (other documents that it links with).

    Documents link when the Jaccard similarity of their shingle sets is at
    least ``percent`` / 100; component_id is the smallest doc_id reachable.
    A null, empty or blank text has no shingles and its own id as component;
    a null id takes part in nothing (component null); repeated rows are equal
    sets, so linked.  No documents give no rows.
    """
    sets = stored(document_sets(docs, percent, size), "jaccard-documents")
    classes = sets.where("fp IS NOT NULL").groupBy("fp").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    labels = similar_classes(docs, sets, classes, percent, size)
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    # classes linked to others: their component's smallest representative
    low = (labelled.join(labels.select(F.col("node").alias("fp")), "fp", "left_semi")
           .groupBy("component").agg(F.min("rep").alias("low")))
    reps = labelled.join(low, "component", "left").select(
        "fp", F.coalesce("low", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return (sets.drop("lead").join(reps, "fp", "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """The documents without those that have a smaller id in their component, same columns.

    Rows that repeat an id and text count once; rows with a null id all stay.
    Only rows that may have to go are shuffled: the others pass a fixed-size
    filter over the ids to drop.
    """
    found = stored(jaccard_components(docs, percent, size), "jaccard-result")
    same = found.where("doc_id IS NOT NULL").groupBy("doc_id", "text_hash").agg(
        F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    touched = same.where("component_id <> doc_id OR rows > 1").select("doc_id")
    bits = slot_filter(touched)
    keep = same.where("component_id = doc_id").select("doc_id", F.col("text_hash").alias("_text"))
    clear = by_slot(docs.where("doc_id IS NOT NULL"), "doc_id", bits, False)
    unsure = by_slot(docs.where("doc_id IS NOT NULL"), "doc_id", bits, True)
    unsure = (unsure.select(F.struct(*docs.columns).alias("_doc"), "doc_id", F.xxhash64("text").alias("_text"))
              .join(keep, ["doc_id", "_text"], "left_semi").groupBy("doc_id", "_text").agg(F.first("_doc").alias("_doc")))
    return clear.unionByName(unsure.select("_doc.*")).unionByName(docs.where("doc_id IS NULL"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")
