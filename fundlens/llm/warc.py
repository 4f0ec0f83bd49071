"""WARC archives with oversized payloads as a chunked record table.

Writing: every page becomes one WARC 1.1 record in a gzip member of its own. Payloads are cut
into rows of ``record, chunk number, chunk`` before they reach Python, and a record's chunks pass through
the writer one after the other, its digest and compressor running across Arrow batches; nothing but a
bounded slice of chunks is held, encoded, compressed or hashed at once. Reading streams an archive and yields one row
per chunk: ``record_id, chunk_no, offset, data, running_sha1, last`` and the record's
headers on its last row. ``running_sha1`` is the digest of the payload up to and with
that chunk, so a reader can check a prefix, and the last row's is the payload digest.
Memory in the reader is one chunk, however long a record is.

Records with equal payloads (SHA-1 and length) are written once: the one with the
largest ``page_id`` is the ``response``, the others are ``revisit`` records that name
it and carry no payload. Payloads of less than ``min_revisit_bytes`` are always
responses. Null html is an empty payload; an empty table gives no archive and no rows;
rows that repeat the largest ``page_id`` of an equal payload are all responses; a null
``page_id`` is written with an empty id, ranks last, and is read back as null; line breaks in a URL are
left out of its header line. Extra columns are ignored.

The group of a payload is found on narrow rows (id, length, digest), counted map-side,
and joined back over plain exchanges that adaptive execution can split; wide rows are
shuffled once, by their unique page id.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm.common import commit_file, filesystem, slices, staged, to_batch
from fundlens.session import scratch_dir

CHUNK = 256 * 1024
#: Characters of a payload in one row on its way to the writer: an Arrow batch of 10,000 rows stays bounded.
WRITE_CHARS = 8192
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_CHUNKS = pa.schema([
    ("record_id", pa.int64()), ("chunk_no", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()),
    ("data", pa.binary()), ("running_sha1", pa.string()), ("last", pa.bool_()),
    ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
_DDL = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean"}
MANIFEST_DDL = ", ".join(f"{f.name} {_DDL[f.type]}" for f in _MANIFEST)
CHUNKS_DDL = ", ".join(f"{f.name} {_DDL[f.type]}" for f in _CHUNKS)


def b32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_table(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, sha1, record_type, refers_to`` per (page, payload), from narrow rows."""
    payload: Column = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    narrow = staged(pages.select("page_id", F.length(payload).alias("bytes"), F.sha1(payload).alias("sha1"))
                    .groupBy("page_id", "bytes", "sha1").agg(F.count(F.lit(1)).alias("copies")), "payloads")
    groups = staged(narrow.filter(F.col("bytes") >= min_revisit_bytes).groupBy("bytes", "sha1")
                    .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").drop("n"), "payload-groups")
    joined = narrow.join(groups, ["bytes", "sha1"], "left")
    revisit = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return joined.select(F.col("page_id").alias("r_page"), F.col("sha1").alias("r_sha1"),
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("keep")).alias("refers_to"))


def _header(page_id, url, kind, refers_to, sha1, payload_bytes, block_bytes) -> bytes:
    uri = lambda x: f"<urn:page:{'' if x is None else x}>"
    clean = "".join(c for c in (url or "") if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {uri(page_id)}",
             f"WARC-Target-URI: {clean}", "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{b32(sha1)}", f"X-Payload-Length: {payload_bytes}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {uri(refers_to)}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {block_bytes}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def payload_rows(rows: DataFrame, chars: int = WRITE_CHARS) -> DataFrame:
    """The records as rows ``page_id, url, sha1, bytes, record_type, refers_to, chunk_no, chunks, data``, a record's
    chunks following each other in order; a record without payload is one row without data."""
    payload = F.when(F.col("record_type") == "response", F.coalesce(F.col("html"), F.lit("")))
    pieces = F.when(F.octet_length(payload) <= chars, F.array(payload)) \
        .otherwise(F.regexp_extract_all(payload, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0)))
    cut = rows.select("page_id", "url", "sha1", "bytes", "record_type", "refers_to", pieces.alias("pieces"))
    first = F.col("chunk_no") == 0
    return cut.select("*", F.posexplode(F.coalesce("pieces", F.array(F.lit(None).cast("string")))).alias("chunk_no", "data")) \
        .select("page_id", F.when(first, F.col("url")).alias("url"), "sha1", "bytes", "record_type", "refers_to", "chunk_no",
                F.coalesce(F.size("pieces"), F.lit(1)).alias("chunks"), "data")


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll_bytes: int) -> Iterator[pa.RecordBatch]:
    """Archives of this task, each up to about ``roll_bytes``; a manifest row per committed archive.
    A record ends with its last chunk, in whatever batch that comes."""
    out, done, n, written, pack, digest, due = None, [], 0, 0, None, None, 0

    def put(data: bytes):
        nonlocal written
        if data:
            out.write(data)
            written += len(data)

    def close():
        out.close()
        file_system.move(temp, final)
        done.append((final, n, written))

    for cols, texts in slices(batches, "data"):
        for page_id, url, sha1, size, kind, refers_to, no, chunks, text in zip(*(cols[c] for c in (
                "page_id", "url", "sha1", "bytes", "record_type", "refers_to", "chunk_no", "chunks")), texts, strict=True):
            if no != due:
                raise ValueError(f"page {page_id}: chunk {no} came where {due} was due")
            if out is None:
                file_system, temp, final = commit_file(folder, f"pages-{len(done):05d}", uuid.uuid4().hex)
                final += ".warc.gz"
                out, n, written = file_system.open_output_stream(temp, compression=None), 0, 0
            if no == 0:
                pack, digest = zlib.compressobj(3, zlib.DEFLATED, 31), hashlib.sha1()
                put(pack.compress(_header(page_id, url, kind, refers_to, sha1, size, 0 if kind == "revisit" else size)))
            data = text.encode("utf-8")
            digest.update(data)
            put(pack.compress(data))
            due = no + 1
            if due == chunks:
                if kind == "response" and digest.hexdigest() != sha1:
                    raise ValueError(f"payload of page {page_id} changed while it was written")
                put(pack.compress(b"\r\n\r\n") + pack.flush())
                n, due = n + 1, 0
                if written >= roll_bytes:
                    close()
                    out = None
    if due:
        raise ValueError("the last record is not complete")
    if out is not None:
        close()
    if done:
        yield to_batch(list(zip(*done, strict=True)), _MANIFEST)


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0,
                   roll_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) into archives under
    ``folder`` (shared by all executors); the manifest: ``file, records, bytes``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    wide = pages.select("page_id", "url", "html", F.length(payload).cast("long").alias("bytes"),
                        F.sha1(payload).alias("sha1"))
    types = record_table(pages, min_revisit_bytes)
    on = wide["page_id"].eqNullSafe(types["r_page"]) & (wide["sha1"] == types["r_sha1"])
    rows = wide.join(types, on, "left").drop("r_page", "r_sha1")
    written = payload_rows(rows).mapInArrow(partial(_write, folder=folder, roll_bytes=roll_bytes), MANIFEST_DDL)
    return staged(written, "warc-manifest")


class _Stream:
    """Bytes of a multi-member gzip file, decompressed piece by piece."""

    def __init__(self, raw, piece: int = 1 << 16):
        self.raw, self.piece, self.left, self.buffer, self.unzip = raw, piece, b"", bytearray(), None

    def fill(self) -> bool:
        while True:
            if self.unzip is None or self.unzip.eof:
                self.left = (self.unzip.unused_data if self.unzip else b"") or self.left or self.raw.read(self.piece)
                if not self.left:
                    return False
                self.unzip = zlib.decompressobj(31)
            data = self.unzip.unconsumed_tail or self.left or self.raw.read(self.piece)
            self.left = b""
            if not data:
                raise ValueError("archive ends inside a record")
            got = self.unzip.decompress(data, 4 * self.piece)
            if got:
                self.buffer += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.fill():
                if self.buffer:
                    raise ValueError("archive ends inside a header")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[:at + len(mark)]
        return out

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size and self.fill():
            pass
        if len(self.buffer) < size:
            raise ValueError("archive ends inside a payload")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        return out


def _record_rows(path: str, chunk: int, with_data: bool) -> Iterator[tuple]:
    """Chunk rows of one archive, in order."""
    file_system, local = filesystem(path)
    with file_system.open_input_stream(local, compression=None) as raw:
        stream = _Stream(raw)
        while (head := stream.until(b"\r\n\r\n")) is not None:
            version, *lines = head.decode("utf-8").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record: {version[:40]!r}")
            fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
            number = lambda x: int(y) if (y := x[len("<urn:page:"):-1]) else None
            record, kind = number(fields["WARC-Record-ID"]), fields["WARC-Type"]
            refers_to = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
            claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            left, no, offset, digest = int(fields["Content-Length"]), 0, 0, hashlib.sha1()
            while True:
                data = stream.take(min(chunk, left))
                left -= len(data)
                digest.update(data)
                running = base64.b32encode(digest.digest()).decode()
                if not left and kind == "response" and running != claimed:
                    raise ValueError(f"digest of record {record} differs")
                yield (record, no, offset, len(data), data if with_data else None, running, not left,
                       fields["WARC-Target-URI"], kind, refers_to,
                       int(fields["X-Payload-Length"]) if kind == "revisit" else offset + len(data), claimed)
                offset, no = offset + len(data), no + 1
                if not left:
                    break
            if stream.take(4) != b"\r\n\r\n":
                raise ValueError(f"record {record} doesn't end where its length says")


def _read(batches: Iterator[pa.RecordBatch], chunk: int, with_data: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for batch in batches:
        for path in batch.column("file").to_pylist():
            for row in _record_rows(path, chunk, with_data):
                rows.append(row)
                held += row[3] if with_data else 300
                if held > 4_000_000:
                    yield to_batch(list(zip(*rows, strict=True)), _CHUNKS)
                    rows, held = [], 0
    if rows:
        yield to_batch(list(zip(*rows, strict=True)), _CHUNKS)


def read_chunks(spark: SparkSession, manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives that ``manifest`` names."""
    files = manifest.select("file")
    n = max(1, files.count())
    numbered = files.coalesce(1).withColumn("number", F.monotonically_increasing_id())  # a row per archive
    return numbered.repartitionById(n, F.pmod("number", F.lit(n)).cast("int")).mapInArrow(
        partial(_read, chunk=chunk, with_data=with_data), CHUNKS_DDL)


def records(chunk_rows: DataFrame) -> DataFrame:
    """One row per record, from the last row of each: its digest covers the whole payload."""
    return chunk_rows.filter("last").select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url", (F.col("chunk_no") + 1).alias("n_chunks"))


def warc_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    spark = pages.sparkSession
    manifest = write_archives(pages, scratch_dir(spark, "warc"), min_revisit_bytes)
    return records(read_chunks(spark, manifest, with_data=False))
