"""Vector code compression: product codes found by an integer Walsh-Hadamard search.

1. ``quantised`` turns every component into an integer (``floor(scale * x)``) in the JVM,
   drops vectors that are null or hold null or non-finite components, and writes the rest.
2. A vector is cut into ``parts`` equal consecutive parts. The codebook of a part position
   starts as that part of the vectors with the smallest ids.
3. ``nearest`` compares parts with entries in the Walsh-Hadamard domain: both are padded with
   zeros to a power of two P and transformed by integer butterflies, rows in sequency order.
   The transform keeps distances up to the factor P, so squared differences are added up
   coefficient block by coefficient block and an entry is given up as soon as its sum
   passes P times the distance of a complete candidate. All of it is integer arithmetic:
   64-bit where the sums provably fit, Python integers otherwise.
4. A round assigns all parts and replaces each entry by the floored mean of its parts. Tasks
   hand on one row of sums per (part, entry, position); a distributed sum adds them. Only the
   codebooks, ``entries`` times the width of a vector, ever reach the driver.

Defined cases: vectors shorter than the longest are continued with zeros, to a multiple of
``parts`` (an empty vector is all zeros); rows of one id count each, in the order of their
components; null ids come last, null labels form one label; fewer vectors than entries give
smaller codebooks; an empty table gives no rows; extra columns are ignored. Components of
2^50 and more in magnitude cannot be held as integers and raise an error that says so. An error
beyond a 64-bit integer is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from fundlens.llm.common import staged

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Components that a Python task transforms at once.
SLICE_CELLS = 1 << 20

_SUMS = pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])
_LIMIT = 2.0 ** 50


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row (a power of two long), rows of the matrix in
    sequency order, that is by their number of sign changes."""
    n, size = x.shape
    out, half = x.copy(), 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency_order(size)]


def sequency_order(size: int) -> np.ndarray:
    """Where the row with k sign changes stands in natural order: the reversed bits of k's Gray code."""
    k = np.arange(size)
    gray, out = k ^ (k >> 1), np.zeros(size, np.int64)
    for _ in range(size.bit_length() - 1):
        out, gray = (out << 1) | (gray & 1), gray >> 1
    return out


def _padded(x: np.ndarray) -> np.ndarray:
    size = 1 << max(x.shape[1] - 1, 0).bit_length()
    return np.concatenate([x, np.zeros((len(x), size - x.shape[1]), x.dtype)], axis=1)


def exact_dtype(values: int, largest: int) -> type:
    """64-bit integers if every scaled distance of parts of this size and magnitude fits, else Python's."""
    size = 1 << max(values - 1, 0).bit_length()
    return np.int64 if size * size * 4 * largest * largest < 1 << 63 else object


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, ties to the lower; its squared distance) of each part, exactly."""
    n, width = parts.shape
    if not n or not width:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    kind = exact_dtype(width, max(int(abs(x).max()) for x in (parts, entries)))
    a, b = (walsh_hadamard(_padded(x.astype(kind))) for x in (parts, entries))
    size = a.shape[1]
    cuts = [0, *(1 << i for i in range(size.bit_length()))]
    first = a[:, None, :1] - b[None, :, :1]
    sums = (first * first)[:, :, 0]
    guess = sums.argmin(axis=1)
    bound = ((a - b[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for lo, hi in zip(cuts[1:], cuts[2:], strict=False):
        sums = sums + ((a[row, lo:hi] - b[entry, lo:hi]) ** 2).sum(axis=1)
        stay = (sums <= bound[row]).astype(bool)
        row, entry, sums = row[stay], entry[stay], sums[stay]
    # The guess survives in every row, so each row has a run of complete sums, entries ascending.
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    least = np.minimum.reduceat(sums, starts)
    hits = np.flatnonzero((sums == np.repeat(least, np.diff(np.r_[starts, len(row)]))).astype(bool))
    best = hits[np.searchsorted(hits, starts)]
    return entry[best], sums[best] // size


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows by parts) and squared distances of integer vectors; ``books`` is parts by entries by width."""
    width = books.shape[2]
    found = [nearest(vectors[:, p * width:(p + 1) * width], book) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in blocks of bounded size, with their vectors as an integer matrix."""
    step = max(1, SLICE_CELLS // max(width, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            block = batch.slice(at, step)
            flat = block.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield block, flat.reshape(block.num_rows, width)


def _partial_sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per (part, entry, position), numbered through, the number of parts assigned and their sum in this task."""
    n_parts, n_entries, width = books.shape
    count = np.zeros((n_parts, n_entries), np.int64)
    total = np.zeros((n_parts, n_entries, width), object)
    for block, vectors in _blocks(batches, n_parts * width):
        codes, _ = assign(vectors, books)
        small = int(abs(vectors).max(initial=0)) * block.num_rows < 1 << 62
        for p in range(n_parts):
            part = vectors[:, p * width:(p + 1) * width]
            here = np.zeros((n_entries, width), np.int64 if small else object)
            np.add.at(here, codes[:, p], part if small else part.astype(object))
            total[p] += here
            count[p] += np.bincount(codes[:, p], minlength=n_entries)
    used = np.flatnonzero(np.repeat(count.ravel(), width))
    if len(used):
        yield pa.RecordBatch.from_arrays([
            pa.array(used), pa.array(np.repeat(count.ravel(), width)[used]),
            pa.array([Decimal(int(x)) for x in total.ravel()[used]], _SUMS.field("total").type)], schema=_SUMS)


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for block, vectors in _blocks(batches, books.shape[0] * books.shape[2]):
        codes, errors = assign(vectors, books)
        text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
        error = [e if e < 1 << 63 else None for e in (sum(map(int, row)) for row in errors)]
        yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("label"),
                                          pa.array(text, pa.string()), pa.array(error, pa.int64())], schema=schema)


def quantised(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, q``: the integer components of every vector that can be coded, written."""
    x = F.col(vector).cast("array<double>")
    kept = vectors.select("vec_id", "label", x.alias("x")).filter(
        F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    refused = F.raise_error(F.lit("a component of 2^50 or more in magnitude cannot be coded")).cast("long")
    rows = staged(kept.select("vec_id", "label", F.transform(
        "x", lambda c: F.when(F.abs(c) < _LIMIT, F.floor(c * scale)).otherwise(refused)).alias("q")), "quantised")
    longest = rows.agg(F.max(F.size("q")), F.min(F.size("q"))).first()
    width = -(-(longest[0] or 0) // parts) * parts
    if longest[0] is None or longest[1] == width:
        return rows
    return rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("q"))))


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts by entries by width, integers) after ``rounds`` rounds over all ``rows``."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    width = len(first[0]["q"]) // parts if first else 0
    books = np.array([r["q"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds if books.size else 0):
        sums = rows.select("q").mapInArrow(partial(_partial_sums, books=books), "cell long, n long, total decimal(38,0)") \
            .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        flat = books.copy().reshape(-1)
        for r in sums:
            flat[r["cell"]] = int(r["total"]) // r["n"]
        books = flat.reshape(books.shape)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry and position, as decimal text."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of each row."""
    out = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return rows.mapInArrow(partial(_coded, books=books, schema=to_arrow_schema(out)), out)


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([book[int(code[2 * p:2 * p + 2], 16)] for p, book in enumerate(books)])


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each kept vector.

    The error sums of the labels are a written table, so adaptive execution can split a label
    that holds most of the rows when they are joined back (null-safe).
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes of two hex digits hold 1 to 256 entries")
    rows = quantised(vectors, vector, parts, scale)
    books = train_codebooks(rows, parts, entries, rounds)
    coded = staged(encode(rows, books), "vector-codes")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    totals = staged(sums.select(F.col("label").alias("total_of"), "label_error"), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("total_of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
