"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

Archives often come as one gzip stream per file, which can only be read from
the start.  The normaliser inflates such a stream once, a block at a time,
and writes every record as a gzip member of its own, beside a sidecar index
with each member's offset and length; readers then seek.  Files live in a
folder that driver and executors share; a file belongs to the result only if
the row that names it was committed, so lost or repeated tasks leave nothing
half-written behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from triplake.lake import scratch_dir
from triplake.llm.common import stored, table

#: Record bytes after which a new archive is begun.
ARCHIVE_BYTES = 64 << 20
BLOCK = 1 << 18
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def _create(path: str):
    fs, name = _place(path)
    fs.create_dir(os.path.dirname(name), recursive=True)
    return fs.open_output_stream(name, compression=None)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload or, given ``refers_to``, a revisit without."""
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file (one member or several), a bounded block at a time."""
    z = zlib.decompressobj(31)
    while raw := stream.read(BLOCK):
        while raw:
            yield z.decompress(raw, 4 * BLOCK)
            raw = z.unconsumed_tail
            if z.eof:
                raw, z = z.unused_data, zlib.decompressobj(31)
    if tail := z.flush():
        yield tail


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, whole record) of each record of a gzip file, read once from start to end."""
    buffer, need = bytearray(), 0
    fields, head = None, 0
    for block in inflated(stream):
        buffer += block
        while len(buffer) >= need:
            if fields is None:
                head = buffer.find(b"\r\n\r\n")
                if head < 0:
                    need = len(buffer) + 1
                    break
                fields = parse_head(bytes(buffer[:head]))
                need = head + 4 + int(fields["content-length"]) + 4
            else:
                yield fields, bytes(buffer[:need])
                del buffer[:need]
                fields, need = None, 0
                if not buffer:
                    break
    if buffer or fields is not None:
        raise ValueError("archive ends within a record")


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``(page_id, url, payload, digest, refers_to)`` rows as whole-file gzip archives -> (archive, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), []
        out = None
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    made.append([f"{folder}/pages-{part:06d}-{len(made):04d}-{uuid.uuid4().hex[:8]}.warc.gz", 0])
                    out, z, size = _create(made[-1][0]), zlib.compressobj(6, zlib.DEFLATED, 31), 0
                raw = record(*row)
                out.write(z.compress(raw))
                size += len(raw)
                made[-1][1] += 1
                if size >= archive_bytes:
                    out.write(z.flush()), out.close()
                    out = None
        if out is not None:
            out.write(z.flush()), out.close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()),
                                          pa.array([m[1] for m in made], pa.int64())], names=["archive", "records"])

    return stored(pages.select("page_id", "url", "payload", "digest", "refers_to")
                  .mapInArrow(run, "archive string, records long"), "warc-archives")


def normalise(archives: DataFrame) -> DataFrame:
    """(archive) -> index rows (archive, offset, length, record_id, record_type) of the rewritten archives.

    Each file becomes ``*.records.warc.gz`` with one member a record, and
    ``*.records.index`` with the same rows as JSON lines.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column("archive").to_pylist():
                fs, name = _place(archive)
                base = f"{archive.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.records"
                index, at = [], 0
                with fs.open_input_stream(name, compression=None) as stream, _create(f"{base}.warc.gz") as out:
                    for fields, raw in records(stream):
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(raw) + z.flush()
                        out.write(member)
                        index.append((f"{base}.warc.gz", at, len(member), fields["warc-record-id"], fields["warc-type"]))
                        at += len(member)
                names = ["archive", "offset", "length", "record_id", "record_type"]
                with _create(f"{base}.index") as side:
                    side.write("".join(json.dumps(dict(zip(names[1:], r[1:]))) + "\n" for r in index).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in index], t) for i, t in enumerate(
                        (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=names)

    files = archives.select("archive")
    return stored(files.repartition(max(1, files.count()), "archive").mapInArrow(
        run, "archive string, offset long, length long, record_id string, record_type string"), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """Read each indexed record by offset -> page_id, payload_bytes, payload_digest, record_type, refers_to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, stream = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    fs, name = _place(archive)
                    opened, stream = archive, fs.open_input_file(name)
                stream.seek(offset)
                raw = zlib.decompress(stream.read(length), 31)
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = parse_head(head)
                http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
                size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))[15:])
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response":
                    size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest:
                        raise ValueError(f"{archive}@{offset}: payload digest {found}, expected {digest}")
                number = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None
                rows.append((number(fields["warc-record-id"]), size, digest, fields["warc-type"], number(fields.get("warc-refers-to"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    at = index.select("archive", "offset", "length")
    files = max(1, at.select("archive").distinct().count())
    return at.repartition(files, "archive").sortWithinPartitions("archive", "offset").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def with_revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` -> page_id, url, payload, digest, refers_to.

    Of equal payloads (null: empty) the one with the largest page_id is the
    response and the others refer to it; rows that share that page_id are all
    responses, and payloads of null ids alone stay responses.  Equal payloads
    are found through digest and length only; html moves in no shuffle unless
    the repeated payloads are too many to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("_sha", F.sha1("payload"))
    size = F.octet_length("payload")
    last = (rows.groupBy("_sha", size.alias("_n")).agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_rows"))
            .where("_rows > 1"))
    rows = rows.withColumn("_n", size).join(last.drop("_rows"), ["_sha", "_n"], "left")
    hexes = F.col("_sha")
    five = [F.conv(hexes.substr(5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    base32 = F.concat(*[alphabet.substr(F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                        for v in five for s in (15, 10, 5, 0)])
    refers = F.when(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return rows.select("page_id", "url", "payload", base32.alias("digest"), refers.alias("refers_to"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    archives = write_monolithic(pages, scratch_dir(spark, "warc"))
    return read_records(normalise(archives))


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS h,
         max(page_id) OVER (PARTITION BY payload) AS last FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, CAST(5 * (j // 4) + 1 AS INTEGER), 5) AS BIGINT) >> (5 * (3 - j % 4))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d
"""
