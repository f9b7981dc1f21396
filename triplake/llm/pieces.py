"""SentencePiece encoding and decoding of whole texts for merge-type (BPE) models.

Such a model merges the adjacent symbols whose joined text is the piece of
highest score (leftmost of equals) until none is left.  The same ids are found
without a queue of merges: a sequence of pieces is the encoding of a text
exactly if every piece and every two adjacent pieces, taken alone, merge back
into themselves (merges in a part of a text do not depend on the rest before
the first merge across its border).  So a text is read from the left, taking
at each position the longest piece of an Aho-Corasick match that is compatible
with the piece before; where no piece fits, the position is marked in a
bitfield as failed and the piece before gives way to its next shorter prefix.
What was accepted up to a position is the encoding of that prefix, so a
position that failed once fails on every way there, and each is left once.

No piece of the usual models holds a space mark behind another character;
where that is so, texts are cut before space marks and the distinct parts of
a batch are encoded once.

On Spark: one pass without a shuffle, each row by itself.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.llm.common import slices, table

MODEL_FILE = "piece_bpe_32k.model"
#: Encoded parts and compatible pairs that a worker remembers (of parts, as many again); longer parts are not remembered.
REMEMBERED = 1 << 18
REMEMBERED_CHARS = 64

# The mark that stands for a space, what an unknown piece decodes to, kinds of pieces.
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message: an int, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield tag >> 3, raw[at:at + size]
        at += size


class _Singles(dict):
    """character -> number of the piece it is; characters that are none get numbers behind those of pieces."""

    def __init__(self, model: "PieceModel"):
        super().__init__()
        self.model = model

    def __missing__(self, c: str) -> int:
        self[c] = n = self.model.add(c)
        return n


class PieceModel:
    """Encoder and decoder: pieces ``(text, kind)`` by id, and the scores of the normal ones."""

    def __init__(self, pieces: list[tuple[str, int]], score: dict[str, float]):
        self.piece, self.rank = pieces, {t: -s for t, s in score.items()}
        self.byte_id = [-1] * 256
        for i, (t, kind) in enumerate(pieces):
            if kind == BYTE:
                self.byte_id[int(t[3:5], 16)] = i
        #: two characters next to each other in a piece; across any other border nothing merges
        self.inside = {a + b for t in self.rank for a, b in zip(t, t[1:])}
        self.cuts = not any(x[0] != SPACE == x[1] for x in self.inside)
        self.plain = [t.replace(SPACE, " ") if kind == NORMAL else None for t, kind in pieces]
        self.decimal = [str(i).encode() for i in range(len(pieces))]
        # by number (ids, then characters that are no pieces): text, length, the next shorter piece that is a prefix
        self.text, self.size, self.shorter = [], [], []
        for t, _ in pieces:
            self.add(t)
        number = {t: i for i, (t, kind) in reversed(list(enumerate(pieces))) if kind == NORMAL}
        self.single = _Singles(self)
        self.single.update((t, i) for t, i in number.items() if len(t) == 1)
        #: pieces that merging their own characters gives
        made = {t for t in number if len(t) > 1 and self.merge(t) == [t]}
        self.matches = ahocorasick.Automaton()
        for t in made:
            prefix = next((t[:k] for k in range(len(t) - 1, 1, -1) if t[:k] in made), t[0])
            self.shorter[number[t]] = number[prefix] if len(prefix) > 1 else self.single[prefix]
            self.matches.add_word(t, (len(t) - 1, number[t]))
        if made:
            self.matches.make_automaton()
        self.together: dict[int, bool] = {}

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        """The model of a file.

        Only models whose texts need no rewriting are read: merge type, byte
        fallback, a dummy prefix, spaces kept and escaped, no character map,
        none but normal, byte, control and unknown pieces; others raise ValueError.
        """
        with open(path, "rb") as f:
            fields = list(_fields(f.read()))
        pieces: list[tuple[str, int]] = []
        score: dict[str, float] = {}
        # fixed values: field numbers of the format, and what a field left out means
        trainer, normalizer = {3: 1, 24: 0, 35: 0}, {2: b"", 3: 1, 4: 1, 5: 1}
        for number, value in fields:
            if number == 1:
                p = dict(_fields(value))
                text, kind = p[1].decode(), p.get(3, NORMAL)
                if kind not in (NORMAL, UNKNOWN, CONTROL, BYTE):
                    raise ValueError(f"pieces of kind {kind} are not read")
                if kind == NORMAL:
                    score.setdefault(text, struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                pieces.append((text, kind))
            elif number == 2:
                trainer.update(_fields(value))
            elif number == 3:
                normalizer.update(_fields(value))
        model = cls(pieces, score)
        if (trainer[3], trainer[24], trainer[35]) != (2, 0, 1) or min(model.byte_id) < 0:
            raise ValueError("not a merge-type model with byte fallback")
        if (normalizer[2], normalizer[3], normalizer[4], normalizer[5]) != (b"", 1, 0, 1) or SPACE not in score:
            raise ValueError("a model that rewrites texts is not read")
        return model

    def add(self, text: str) -> int:
        self.text.append(text), self.size.append(len(text)), self.shorter.append(-1)
        return len(self.text) - 1

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by the merges themselves: best pair first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, before: int, after: int) -> bool:
        """Whether two pieces stay apart when their joined text is merged anew."""
        known = self.together.get(before << 32 | after)
        if known is None:
            if len(self.together) >= REMEMBERED:
                self.together.clear()
            a, b = self.text[before], self.text[after]
            known = self.together[before << 32 | after] = a[-1] + b[0] not in self.inside or self.merge(a + b) == [a, b]
        return known

    def split(self, text: str) -> list[int]:
        """The numbers of the pieces of a text with marked spaces."""
        longest = list(map(self.single.__getitem__, text))
        for end, (k, t) in self.matches.iter(text) if len(self.matches) else ():  # of matches with one start the longest ends last
            longest[end - k] = t
        length, known, sizes = len(text), self.together, self.size
        failed, any_failed = bytearray((length >> 3) + 1), False
        out: list[int] = []
        at, before = 0, -1
        while at < length:
            t = longest[at]
            while True:
                end = at + sizes[t]
                if (not any_failed or not failed[end >> 3] >> (end & 7) & 1) and (
                        before < 0 or known.get(before << 32 | t) or self.compatible(before, t)):
                    out.append(t)
                    at, before = end, t
                    break
                if sizes[t] > 1:
                    t = self.shorter[t]
                else:  # no piece fits here: the one before must be a shorter one
                    failed[at >> 3] |= 1 << (at & 7)
                    any_failed = True
                    t = out.pop()
                    at -= sizes[t]
                    before = out[-1] if out else -1
        return out

    def ids(self, numbers: list[int]) -> list[int]:
        """Ids: a character that is no piece is the pieces of its bytes."""
        pieces = len(self.piece)
        if not numbers or max(numbers) < pieces:
            return numbers
        return [i for n in numbers for i in ([n] if n < pieces else [self.byte_id[b] for b in self.text[n].encode()])]

    def parts(self, text: str) -> list[str]:
        """A text with a dummy prefix and marked spaces, cut where no piece can reach across."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return _PARTS.findall(marked) if self.cuts else [marked]

    def decode(self, ids: list[int], inside: bool = False) -> str:
        """The text of ids: spaces for their marks, runs of byte pieces as UTF-8 (U+FFFD for each byte that is not).

        ``inside``: the ids follow others, so that no dummy prefix goes.
        """
        plain = list(map(self.plain.__getitem__, ids))
        if inside and None not in plain:
            return "".join(plain)
        text, raw, started = [], bytearray(), inside
        for i in [*ids, None]:
            t, kind = self.piece[i] if i is not None else ("", CONTROL)
            if kind == BYTE:
                raw.append(int(t[3:5], 16))
                continue
            if raw:
                text.append(utf8(bytes(raw)))
                raw, started = bytearray(), True
            if kind == NORMAL:
                # the dummy prefix goes from the first piece
                text.append((t if started or not t.startswith(SPACE) else t[1:]).replace(SPACE, " "))
                started = True
            elif kind == UNKNOWN:
                text.append(UNKNOWN_TEXT)
                started = True
        return "".join(text)


_PARTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def utf8(raw: bytes) -> str:
    """Bytes as UTF-8, one U+FFFD for every byte that is part of no character."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[:e.start].decode() + "�" + utf8(raw[e.start + 1:])


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel.load(path)


class Parts(dict):
    """part of a text -> what ``make`` makes of its ids, remembered while in use: two generations of REMEMBERED parts."""

    def __init__(self, model: PieceModel, make: Callable[[list[int]], object]):
        super().__init__()
        self.model, self.make, self.older = model, make, {}

    def __missing__(self, text: str):
        known = self.older.get(text)
        if known is None:
            known = self.make(self.model.ids(self.model.split(text)))
        if len(text) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = known
        return known

    def of(self, text: str | None) -> Iterator:
        """What was made of each part of a text, in order."""
        return map(self.__getitem__, self.model.parts(text or ""))


@lru_cache(maxsize=1)
def digested_parts(path: str) -> Parts:
    """Parts as (decimal ids, decoded bytes), remembered by a worker from one task to the next."""
    m = piece_model(path)
    return Parts(m, lambda ids: (b",".join(map(m.decimal.__getitem__, ids)), m.decode(ids, inside=True).encode()))


def encode_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` -> doc_id, n_tokens and digests of the ids and of the text decoded from them.

    A null text counts as empty: 0 tokens and the digests of nothing.  Ids may
    be null, repeated and of any type; each row is encoded by itself.  Other
    columns are not read.  No documents give no rows.
    """
    path = path or public_tokenizers.path(MODEL_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = digested_parts(path)
        for b in slices(batches):
            n, ids, raw = [], [], []
            for text in b.column("text").to_pylist():
                made, decoded = zip(*parts.of(text)) if text else ((), ())
                joined = b",".join(made)
                n.append(joined.count(b",") + 1 if made else 0)
                ids.append(hashlib.sha256(joined).hexdigest())
                # what the parts decode to, less the dummy prefix
                raw.append(hashlib.sha256(b"".join(decoded)[1:]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", "text")
    null = F.lit(None)
    return rows.mapInArrow(run, rows.select(
        "doc_id", null.cast("long").alias("n_tokens"), null.cast("string").alias("ids_sha256"),
        null.cast("string").alias("decoded_sha256")).schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Piece ids of every text: the columns of ``docs`` and ``piece_ids array<int>`` (replacing one of that name)."""
    path = path or public_tokenizers.path(MODEL_FILE)
    kept = docs.drop("piece_ids")
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(piece_model(path), list)
        for b in slices(batches):
            ids = [[i for p in parts.of(t) for i in p] for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*b.schema.names, "piece_ids"])

    return kept.mapInArrow(run, kept.withColumn("piece_ids", F.array().cast("array<int>")).schema)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``decoded string``: the text of ``piece_ids``; null for null."""
    path = path or public_tokenizers.path(MODEL_FILE)
    kept = encoded.drop("decoded")
    at = kept.columns.index("piece_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(path)
        for b in slices(batches):
            text = [None if ids is None else m.decode(ids) for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())],
                                             names=[*b.schema.names, "decoded"])

    return kept.mapInArrow(run, kept.withColumn("decoded", F.lit(None).cast("string")).schema)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"))
