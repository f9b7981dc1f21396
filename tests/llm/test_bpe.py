import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from triplake.llm import bpe

TEXTS = ["", " ", "Hello,  world!\n\nIt's 12345 and we'll see", "a\x1cb \x85 x y​z", "x" * 3000 + "  " * 700,
         "日本語テキスト und 한국어 é", "  \n\n\t x'll 're  ٣٤ ½ ²", "a" * 511 + "b", "ab" * 900, "퟿"]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.RANK_FILE), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcehtions éñ'\n 12.,\x1f\x1d　😀") for _ in range(rng.randint(0, 900)))
                     for _ in range(150)]
    enc = bpe._Encoded(P.path(bpe.RANK_FILE), P.PATTERN)
    for text, pieces in zip(texts, enc.each(texts)):
        ids = [i for p in pieces for i in p[1]]
        assert ids == library.encode_ordinary(text)
        assert enc.codec.decode(ids) == text.encode()


def test_matrix_and_heap_agree():
    c = bpe.codec(P.path(bpe.RANK_FILE), P.PATTERN)
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abnotihe") for _ in range(rng.randint(2, 200))) for _ in range(200)]
    assert [c.encode_pieces([p])[0] if p not in c.ranks else [c.ranks[p]] for p in pieces] == [
        c._merge_long(p) if p not in c.ranks else [c.ranks[p]] for p in pieces]


def test_digest_and_round_trip(spark, library):
    docs = spark.createDataFrame([(i, t, "src") for i, t in enumerate(TEXTS)] + [(None, None, "src"), (1, " ", "src")],
                                 "doc_id long, text string, token_ids string")
    rows = bpe.encode_digest(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = TEXTS[r.doc_id] if r.doc_id is not None else ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back)
    assert bpe.encode_digest(docs.limit(0)).count() == 0


def test_held_pieces_stay_bounded_and_keep_those_in_use(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 500)
    enc = bpe._Encoded(P.path(bpe.RANK_FILE), P.PATTERN)
    made = []
    encode = enc.codec.encode_pieces
    monkeypatch.setattr(enc.codec, "encode_pieces", lambda pieces: made.extend(pieces) or encode(pieces))
    texts = [f"always here{i}ab" + "".join(f" q{i}x{k}z" for k in range(40)) for i in range(60)]
    for text, pieces in zip(texts, enc.each(texts)):
        assert [i for p in pieces for i in p[1]] == library.encode_ordinary(text)
        assert len(enc.seen) <= 300
    assert made.count(b"always") == 1 and made.count(b" here") == 1


def test_codec_holds_its_pairs_once():
    c = bpe.codec(P.path(bpe.RANK_FILE), P.PATTERN)
    held = [v for v in vars(c).values() if isinstance(v, dict)]
    assert all(len(d) <= len(c.ranks) for d in held)  # no second table of pairs as Python objects
    some = [(a, b) for a, b in ((int(k) >> 32, int(k) & 0xFFFFFFFF) for k in c.table.keys[:4000] if k >= 0)]
    assert some and all(c.token[a] + c.token[b] == c.token[c.table.get(a, b)] for a, b in some)
    assert c.table.get(len(c.ranks) + 5, 3) is None
