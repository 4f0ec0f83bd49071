"""Token ids in binary files under a canonical length-limited Huffman code.

1. ``token_table`` encodes whole texts to ids (with an end id each) and writes them once.
2. The ids are counted over all documents; the counts (one row per id, so at most the
   vocabulary) give code lengths of at most ``limit`` bits by package-merge, and these
   alone the canonical codes. The lengths are the code book, kept beside the files.
3. Documents are sorted by id over range partitions (rows of one id, or of none, are spread by
   their place), coded there, and each partition writes one file of frames, in ascending order of ``doc_id``. A frame holds
   its documents' ids and lengths, the bit offset of every block of ``BLOCK`` ids (the
   checkpoints), and the code bits; a document starts on a byte.
4. Reading decodes all blocks of a frame side by side: one table look-up of ``limit``
   bits gives each block's next id and its code length. Blocks need nothing from each
   other, so any of them can be read alone from its checkpoint (``decode_blocks``).

Null text counts as empty (only its end id); a null ``doc_id`` sorts first and stays
null; rows repeating an id are all written; an empty table writes no file and reads as
no rows. Memory is one slice of texts or one frame (or one longer document).
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundlens.llm.common import commit_file, filesystem, shuffle_partitions, slices, staged, text_or_empty, to_batch
from fundlens.llm.pieces import ENCODE_CHARS, encoder
from fundlens.session import scratch_dir

BLOCK = 1024
LIMIT = 16
FRAME_IDS = 2_000_000
_MAGIC = b"HUFIDS1\n"
_FRAME = struct.Struct("<qqqq")

_IDS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("bits", pa.binary()), ("marks", pa.binary())])
_FILES = pa.schema([("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()),
                    ("bytes", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                   ("ids", pa.binary())])
_DDL = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


# ---- ids -------------------------------------------------------------------------------------------------------

def id_width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def binary_rows(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """The values as one binary value per row of ``n`` items, without a copy for each."""
    at = np.concatenate([[0], np.cumsum(n)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _encode_texts(batches, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Rows of ids, and last a row with -1 ids that holds this task's count of each id."""
    enc = encoder(path)
    size = max(enc.tokenizer.get_vocab_size(), end_id + 1)
    total = np.zeros(size, np.int64)
    for cols, texts in slices(batches, max_chars=ENCODE_CHARS):
        ids, n = enc.ids_of(texts, end_id)
        total += np.bincount(ids, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(n), binary_rows(ids.astype(id_width(size)), n)],
                                         schema=_IDS)
    if total.any():
        yield to_batch([[None], [-1], [total.tobytes()]], _IDS)


@dataclass
class Tokens:
    """``ids``: doc_id, n_tokens, ids (unsigned little-endian, as wide as the vocabulary asks);
    ``counts``: id, n over all documents."""

    ids: DataFrame
    counts: DataFrame


def token_table(docs: DataFrame, path: str, end_id: int = 1) -> Tokens:
    """The ids of whole texts, written once, and their counts, summed in the tasks that made them."""
    rows = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
                  .mapInArrow(partial(_encode_texts, path=path, end_id=end_id), ddl(_IDS)), "token-ids")
    counts = rows.filter("n_tokens = -1").select("ids").mapInArrow(_count_ids, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n"))
    return Tokens(rows.filter("n_tokens > 0"), counts)


def _widths(n: list[int], blobs: list[bytes]) -> str:
    return f"<u{len(blobs[0]) // n[0]}"


def _count_ids(batches) -> Iterator[pa.RecordBatch]:
    """(id, n) of the ids that a task has met."""
    for batch in batches:
        for blob in batch.column("ids").to_pylist():
            total = np.frombuffer(blob, np.int64)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])


# ---- code ------------------------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits per symbol (0: unused) of an optimal prefix code of at most ``limit`` bits (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, levels = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        level = both[by]
        levels.append(by < len(leaves))
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of every symbol: ascending by (length, symbol)."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        own = np.flatnonzero(lengths == bits)
        code <<= bits - last
        codes[own] = code + np.arange(len(own))
        code, last = code + len(own), bits
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, code length) for each value of the next ``limit`` bits."""
    used = np.flatnonzero(lengths)
    by = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (limit - lengths[by].astype(np.int64))
    symbols, bits = np.zeros(1 << limit, np.int32), np.zeros(1 << limit, np.int64)
    fill = int(spans.sum())
    symbols[:fill], bits[:fill] = np.repeat(by, spans), np.repeat(lengths[by], spans)
    return symbols, bits


def pack(ids: np.ndarray, n: np.ndarray, lengths: np.ndarray, codes: np.ndarray,
         block: int = BLOCK) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bits, byte offset of each document, bit offset in its document of each block, blocks per document)."""
    size = lengths[ids].astype(np.int64)
    last = np.cumsum(n)
    ends = np.cumsum(size)
    doc_ends = np.concatenate([[0], ends])[last]
    doc_first = np.concatenate([[0], doc_ends[:-1]])
    doc_bytes = np.concatenate([[0], np.cumsum((doc_ends - doc_first + 7) // 8)])
    inside = ends - size - np.repeat(doc_first, n)
    start = inside + np.repeat(8 * doc_bytes[:-1], n)
    value = codes[ids].astype(np.uint64) << (64 - (start & 31) - size).astype(np.uint64)
    word = start >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words = np.zeros((int(doc_bytes[-1]) + 3) // 4 + 2, np.uint64)
    words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
    words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    blocks = (n + block - 1) // block
    at = np.repeat(last - n, blocks) + block * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    return words.astype(">u4").tobytes()[:int(doc_bytes[-1])], doc_bytes, inside[at], blocks


def decode_blocks(bits: bytes, at: np.ndarray, n: np.ndarray, symbols: np.ndarray, sizes: np.ndarray,
                  limit: int = LIMIT) -> np.ndarray:
    """The ids of blocks that start at the bit offsets ``at`` and hold ``n`` ids each, one after the other."""
    raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.int64)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    by = np.argsort(-n, kind="stable")
    where, place = at[by].astype(np.int64), (np.cumsum(n) - n)[by]
    out = np.empty(int(n.sum()), np.int32)
    alive = np.searchsorted(-n[by], -np.arange(int(n.max(initial=0))), side="left")
    mask, drop = (1 << limit) - 1, 32 - limit
    for step, live in enumerate(alive):
        p = where[:live]
        key = (window[p >> 3] >> (drop - (p & 7))) & mask
        out[place[:live] + step] = symbols[key]
        p += sizes[key]
    return out


# ---- files -----------------------------------------------------------------------------------------------------

def _code_texts(batches, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    codes = canonical_codes(lengths)
    for batch in batches:
        at = 0
        doc_id, n, blobs = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))
        while at < len(n):
            end, total = at, 0
            while end < len(n) and (end == at or total + n[end] <= FRAME_IDS):
                total, end = total + n[end], end + 1
            sizes = np.array(n[at:end], np.int64)
            ids = np.frombuffer(b"".join(blobs[at:end]), _widths(n, blobs))
            bits, starts, marks, blocks = pack(ids, sizes, lengths, codes)
            ends = np.cumsum(blocks)
            yield to_batch([doc_id[at:end], sizes, [bits[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)],
                            [marks[a:b].astype("<i8").tobytes() for a, b in zip(ends - blocks, ends, strict=True)]],
                           _CODED)
            at = end


def _frame(rows: list[tuple]) -> bytes:
    ids, n, bits, marks = zip(*rows, strict=True)
    starts = np.cumsum([0, *map(len, bits)])[:-1]
    at = np.concatenate([np.frombuffer(m, "<i8") + 8 * s for m, s in zip(marks, starts, strict=True)])
    return b"".join([_FRAME.pack(len(rows), sum(n), len(at), sum(map(len, bits))),
                     np.array([x is not None for x in ids], np.uint8).tobytes(),
                     np.array([x or 0 for x in ids], "<i8").tobytes(), np.array(n, "<i8").tobytes(),
                     at.astype("<i8").tobytes(), *bits])


def _write(batches, folder: str, book: bytes, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    out, rows, held, docs, tokens, size = None, [], 0, 0, 0, 0
    part = TaskContext.get().partitionId()
    for batch in _code_texts(batches, lengths):
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "bits", "marks")), strict=True):
            if out is None:
                file_system, temp, final = commit_file(folder, f"ids-{part:06d}", uuid.uuid4().hex)
                out = file_system.open_output_stream(temp, compression=None)
                out.write(_MAGIC + book)
                size = len(_MAGIC + book)
            if rows and held + row[1] > FRAME_IDS:
                out.write(frame := _frame(rows))
                size, rows, held = size + len(frame), [], 0
            rows.append(row)
            held, docs, tokens = held + row[1], docs + 1, tokens + row[1]
    if out is not None:
        out.write(frame := _frame(rows))
        out.close()
        file_system.move(temp, final)
        yield to_batch([[part], [final], [docs], [tokens], [size + len(frame)]], _FILES)


def write_files(tokens: Tokens, folder: str, limit: int = LIMIT) -> DataFrame:
    """Code the ids and write them under ``folder``; the index: ``part, file, docs, tokens, bytes``,
    and the ids in all earlier files as ``first``. The code book is ``folder/codebook``."""
    spark = tokens.ids.sparkSession
    counts = tokens.counts.toPandas()  # a row per id: at most the vocabulary
    table = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    table[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = code_lengths(table, max(limit, int(len(counts)).bit_length()))
    book = hashlib.sha256(lengths.tobytes()).digest()
    file_system, temp, final = commit_file(folder, "codebook", "1")
    with file_system.open_output_stream(temp, compression=None) as f:
        f.write(zlib.compress(lengths.tobytes()))
    file_system.move(temp, final)
    placed = tokens.ids.withColumn("place", F.monotonically_increasing_id())  # of a written table, so the same at every attempt
    index = staged(placed.repartitionByRange(shuffle_partitions(spark), "doc_id", "place").sortWithinPartitions("doc_id", "place")
                   .mapInArrow(partial(_write, folder=folder, book=book, lengths=lengths), ddl(_FILES)), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return index.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))


def _read(batches, folder: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    file_system, base = filesystem(folder)
    with file_system.open_input_stream(f"{base}/codebook-1", compression=None) as f:
        lengths = np.frombuffer(zlib.decompress(f.read()), np.uint8)
    limit = max(LIMIT, int(lengths.max(initial=0)))
    symbols, sizes = decode_table(lengths, limit)
    book = hashlib.sha256(lengths.tobytes()).digest()
    for batch in batches:
        for path, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
            with file_system.open_input_stream(path, compression=None) as f:
                if f.read(len(_MAGIC) + len(book)) != _MAGIC + book:
                    raise ValueError(f"{path} was written under another code book")
                while head := f.read(_FRAME.size):
                    docs, total, blocks, size = _FRAME.unpack(head)
                    known = np.frombuffer(f.read(docs), np.uint8)
                    doc_id = np.frombuffer(f.read(8 * docs), "<i8")
                    n = np.frombuffer(f.read(8 * docs), "<i8")
                    at = np.frombuffer(f.read(8 * blocks), "<i8")
                    per = (n + BLOCK - 1) // BLOCK
                    place = np.arange(blocks) - np.repeat(np.cumsum(per) - per, per)
                    held = np.minimum(BLOCK, np.repeat(n, per) - BLOCK * place)
                    raw = memoryview(decode_blocks(f.read(size), at, held, symbols, sizes, limit)
                                     .astype("<u4").tobytes())
                    cuts = np.concatenate([[0], np.cumsum(n)])
                    parts = [raw[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield to_batch([[int(d) if k else None for d, k in zip(doc_id, known, strict=True)],
                                    first + cuts[:-1], n, [zlib.crc32(p) for p in parts],
                                    [bytes(p) if with_ids else None for p in parts]], _READ)
                    first += total


def read_files(spark: SparkSession, index: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` (unsigned 32-bit little-endian) from the files."""
    files = staged(index.select("part", "file", "first"), "token-index")
    n = max(1, (files.agg(F.max("part")).first()[0] or 0) + 1)
    return files.repartitionById(n, F.col("part").cast("int")).mapInArrow(partial(_read, folder=folder, with_ids=with_ids), ddl(_READ))


def token_round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    spark = docs.sparkSession
    folder = scratch_dir(spark, "huffman")
    index = write_files(token_table(docs, path, end_id), folder)
    return read_files(spark, index, folder, with_ids=False)
