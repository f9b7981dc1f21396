"""Byte-level BPE encoding and decoding of whole texts.

Texts are cut by the tokenizer's pattern; the distinct pieces of a batch
are encoded together: pieces of like length share one padded matrix of
token ids, and each round every row merges its leftmost pair of minimum
rank.  Pair ranks come from an open-addressing hash table in numpy.  Rows
without a mergeable pair leave the matrix (compaction), so later rounds
only touch rows still at work.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.llm.common import slices, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Pieces over this many bytes are merged one at a time with a heap instead of in a matrix.
LONG_PIECE = 512
#: Encoded pieces that a task remembers.
REMEMBERED = 1 << 15
#: Cells of a padded matrix (a few such arrays fit a core's cache).
MATRIX_CELLS = 1 << 15
#: Characters of text whose pieces are held at a time.
CHUNK_CHARS = 1 << 18

NONE = np.int32(np.iinfo(np.int32).max)


class PairTable:
    """(left id, right id) -> merged id, by linear probing over numpy arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, int(4 * len(pairs) + 1).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int32)
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            slots = at[left]
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[left[free]]
            won = self.keys[slots] == keys[left]
            self.values[slots[won]] = values[left[won]]
            left = left[~won]
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged ids of pairs of ids, ``NONE`` where a pair does not merge (or an id is -1)."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        keys[(a < 0) | (b < 0)] = -2
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NONE)
        left = np.flatnonzero((found != keys) & (found != -1) & (keys != -2))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found != -1)]
        return out

    def get(self, a: int, b: int) -> int | None:
        """Merged id of one pair of ids (none of them -1)."""
        key = (a << 32) | b
        at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - self.bits)
        while (found := self.keys[at]) != -1:
            if found == key:
                return int(self.values[at])
            at = (at + 1) & (len(self.keys) - 1)
        return None


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, f))}
        self.token = {r: t for t, r in self.ranks.items()}
        self.pattern, self.latin = regex.compile(pattern), latin_pattern(pattern)
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    pairs[a, b] = r
        self.table = PairTable(pairs)

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return self.latin.findall(text)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.ranks.get(p)
            if r is not None:
                out[i] = [r]
            elif len(p) > LONG_PIECE:
                out[i] = self._merge_long(p)
            else:  # bucket: the next of 4, 6, 8, 12, 16, 24, ... bytes
                n = 1 << max(2, (len(p) - 1).bit_length())
                by_width.setdefault(3 * n // 4 if len(p) <= 3 * n // 4 else n, []).append(i)
        for width, rows in by_width.items():
            step = max(1, MATRIX_CELLS // width)
            for k in range(0, len(rows), step):
                self._merge_rows(pieces, rows[k:k + step], width, out)
        return out

    def _merge_rows(self, pieces: list[bytes], rows: list[int], width: int, out: list[list[int]]) -> None:
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
        length = np.array([len(pieces[i]) for i in rows])
        ids = self.byte_id[raw]
        ids[np.arange(width) >= length[:, None]] = -1
        rows = np.array(rows)
        rank = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(rows):
            at = rank.argmin(1)  # the leftmost minimum
            line = np.arange(len(rows))
            merged = rank[line, at]
            done = merged == NONE
            if done.any():
                for i, n, row in zip(rows[done].tolist(), length[done].tolist(), ids[done]):
                    out[i] = row[:n].tolist()
                keep = ~done
                rows, length, ids, rank, at, merged = (x[keep] for x in (rows, length, ids, rank, at, merged))
                line = np.arange(len(rows))
                if not len(rows):
                    return
            most = int(length.max())
            ids, rank = ids[:, :most], rank[:, :most - 1]
            ids[line, at] = merged
            # close the gap behind the merged pair
            ids = np.concatenate([np.where(np.arange(most - 1) > at[:, None], ids[:, 1:], ids[:, :-1]),
                                  np.full((len(rows), 1), -1, np.int32)], 1)
            rank = np.concatenate([np.where(np.arange(most - 2) > at[:, None], rank[:, 1:], rank[:, :-1]),
                                   np.full((len(rows), 1), NONE, np.int32)], 1)
            length = length - 1
            # the two pairs the merged token is now part of
            right = ids[line, np.minimum(at + 1, most - 1)]
            left = np.where(at > 0, ids[line, np.maximum(at - 1, 0)], -1)
            new = self.table.find(np.concatenate([left, merged]), np.concatenate([merged, right]))
            rank[line, np.maximum(at - 1, 0)] = new[:len(rows)]
            rank[line, at] = new[len(rows):]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: a heap of (rank, position) over a linked list."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        nxt, prv = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (r := self.table.get(ids[i], ids[i + 1])) is not None]
        heapq.heapify(heap)
        end = len(ids)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= end or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[i] < end:
                prv[nxt[i]] = i
                if (q := self.table.get(r, ids[nxt[i]])) is not None:
                    heapq.heappush(heap, (q, i, r, ids[nxt[i]]))
            if prv[i] >= 0 and (q := self.table.get(ids[prv[i]], r)) is not None:
                heapq.heappush(heap, (q, prv[i], ids[prv[i]], r))
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def latin_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts of code points below 256, its classes spelled out for Python's faster ``re``."""
    chars = list(map(chr, range(256)))
    spelled = {c: "".join(f"\\x{ord(x):02x}" for x in chars if regex.match(c, x)) for c in (r"\p{L}", r"\p{N}", r"\s")}
    spelled[r"\S"] = "^" + spelled[r"\s"]
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        inside = part == "[" or inside and part != "]"
        out.append((spelled[part] if inside else f"[{spelled[part]}]") if part in spelled else part)
    return re.compile("".join(out))


class _Encoded:
    """Encodes texts piece by piece, remembering pieces; each is (tokens, ids, decimal ids, decoded bytes)."""

    def __init__(self, path: str, pattern: str):
        self.codec, self.seen = codec(path, pattern), {}

    def pieces(self, texts: list[str]) -> list[list[tuple]]:
        cut = [self.codec.cut(t) for t in texts]
        new = list({p for ps in cut for p in ps if p not in self.seen})
        if len(self.seen) + len(new) > REMEMBERED:  # those of these texts stay, the others go
            self.seen = {p: self.seen[p] for ps in cut for p in ps if p in self.seen}
        for p, ids in zip(new, self.codec.encode_pieces([p.encode() for p in new])):
            self.seen[p] = (len(ids), ids, ",".join(map(str, ids)).encode(), self.codec.decode(ids))
        return [[self.seen[p] for p in ps] for ps in cut]

    def each(self, texts: list[str | None]) -> Iterator[list[tuple]]:
        """The pieces of each text in order, a bounded number of characters at a time."""
        part, chars = [], 0
        for t in texts:
            part.append(t or "")
            chars += len(part[-1])
            if chars >= CHUNK_CHARS:
                yield from self.pieces(part)
                part, chars = [], 0
        yield from self.pieces(part)


def encode_digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, text)`` -> doc_id, n_tokens and digests of the ids and of the bytes decoded from them.

    A null text counts as empty: 0 tokens and the digests of nothing.  Ids may
    be null or repeated; each row is encoded by itself.
    """
    path, pattern = path or public_tokenizers.path(RANK_FILE), pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _Encoded(path, pattern)
        for b in slices(batches):
            n, ids, raw = [], [], []
            for ps in enc.each(b.column("text").to_pylist()):
                n.append(sum([p[0] for p in ps]))
                ids.append(hashlib.sha256(b",".join([p[2] for p in ps])).hexdigest())
                raw.append(hashlib.sha256(b"".join([p[3] for p in ps])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Token ids of every text: the columns of ``docs`` and ``token_ids array<int>`` (replacing one of that name)."""
    path, pattern = path or public_tokenizers.path(RANK_FILE), pattern or public_tokenizers.PATTERN
    kept = docs.drop("token_ids")
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _Encoded(path, pattern)
        for b in slices(batches):
            ids = [[i for p in ps for i in p[1]] for ps in enc.each(b.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*b.schema.names, "token_ids"])

    schema = kept.withColumn("token_ids", F.array().cast("array<int>")).schema
    return kept.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``decoded binary``: the bytes of ``token_ids``; null for null."""
    path, pattern = path or public_tokenizers.path(RANK_FILE), pattern or public_tokenizers.PATTERN
    kept = encoded.drop("decoded")
    at = kept.columns.index("token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in batches:
            raw = [None if ids is None else c.decode(ids) for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], names=[*b.schema.names, "decoded"])

    return kept.mapInArrow(run, kept.withColumn("decoded", F.lit(None).cast("binary")).schema)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"))
