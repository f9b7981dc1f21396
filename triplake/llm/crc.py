"""CRC-32 of many joined byte strings from the checksums of their parts.

``crc32(head + tail) = A(crc32(head)) xor crc32(tail)`` where ``A`` is linear
and depends on the length of the tail alone; so it is a table lookup for each
byte of the head's checksum.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np


@lru_cache(maxsize=1024)
def _shift(length: int) -> np.ndarray:
    """(4, 256): what each byte of a checksum becomes when ``length`` more bytes follow."""
    zeros = b"\0" * length
    none = zlib.crc32(zeros)
    bits = [zlib.crc32(zeros, 1 << k) ^ none for k in range(32)]
    out = np.zeros((4, 256), np.uint32)
    for k, v in enumerate(bits):
        byte, bit = divmod(k, 8)
        out[byte, np.flatnonzero(np.arange(256) >> bit & 1)] ^= np.uint32(v)
    return out


def joined(head: np.ndarray, tail: np.ndarray, tail_length: np.ndarray) -> np.ndarray:
    """Checksums of heads followed by tails, as unsigned 32-bit integers."""
    out = np.empty(len(head), np.uint32)
    order = np.argsort(tail_length, kind="stable")
    sizes, first = np.unique(tail_length[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, first[1:])):
        t, h = _shift(size), head[rows].astype(np.uint32)
        out[rows] = t[0][h & 255] ^ t[1][h >> 8 & 255] ^ t[2][h >> 16 & 255] ^ t[3][h >> 24] ^ tail[rows].astype(np.uint32)
    return out


#: DuckDB SQL: CRC-32 of ``w`` by its table, which a rule makes: 3988292384 is the polynomial of the checksum.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END)) AS t
)"""
CRC_SQL = """xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(octet_length(encode({w}))), lambda i: CAST('0x' || substr(hex(encode({w})), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c // 256, t[1 + (xor(c, b) & 255)])))"""
