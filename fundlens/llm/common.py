"""Helpers shared by the operators: staged tables, Arrow slices, shared-folder files."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.session import scratch_dir
from fundlens.sources.names import unused_names

#: Words of 64 bits in the filter that is broadcast before wide rows are joined.
FILTER_WORDS = 2 ** 18
#: Characters of text that a Python task handles at once; one longer text is a slice of its own.
SLICE_CHARS = 4_000_000


_kept: dict = {}


def let_go(family: str) -> None:
    """Drop what a Python worker keeps for other families than this one, and return its memory. Workers
    are used again by later stages, which call this before they need memory of their own."""
    if old := [k for k in _kept if k[0] != family]:
        for k in old:
            del _kept[k]
        release_memory()


def worker_cache(family: str, key, make: Callable):
    """``make()``, kept between the tasks of a Python worker under (family, key). What another family
    has kept is let go first: a worker never holds the tables of two operators."""
    let_go(family)
    if (family, key) not in _kept:
        _kept[family, key] = make()
    return _kept[family, key]


def release_memory() -> None:
    """Give freed memory back to the system (where the C library can)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def batch_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                 max_chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches, all columns, cut like :func:`slices`, with their texts (null as empty)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            end, total = at, 0
            while end < batch.num_rows and (end == at or total + sizes[end] <= max_chars):
                total += int(sizes[end])
                end += 1
            part = batch.slice(at, end - at)
            yield part, [x or "" for x in part.column(text).to_pylist()]
            at = end


def ship(spark: SparkSession) -> None:
    """Let the Python workers of a local master import this package from wherever they
    start. On a cluster the package comes with ``--py-files`` or the executors' PYTHONPATH."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local":
        root = str(Path(__file__).resolve().parents[2])
        path = sc.environment.get("PYTHONPATH", "")
        if root not in path.split(os.pathsep):
            sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts
    the lineage, survives a lost executor, and gives later uses the very same rows."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _filtered(df: DataFrame, key: Column, listed: DataFrame, words: int) -> tuple[DataFrame, str, list[str]]:
    """``df`` with a flag, its name, and the names of the columns added: whether the hash of ``key`` has its bit set by the
    first column of ``listed``. Rows with a listed key always have it; others hardly, while the ids are fewer than the bits."""
    place, word, bits, flag = unused_names(df.columns, 4)
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(64 * words))
    marks = listed.select(at(F.col(listed.columns[0])).alias(place)).select(F.shiftright(place, 6).alias(word), place) \
        .groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, cast({place} & 63 as int)))").alias(bits))
    out = df.withColumn(place, at(key)).withColumn(word, F.shiftright(place, 6)).join(F.broadcast(marks), word, "left") \
        .withColumn(flag, F.expr(f"coalesce(getbit({bits}, cast({place} & 63 as int)), 0) = 1"))
    return out, flag, [place, word, bits, flag]


def may_be_listed(df: DataFrame, key: Column, listed: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``df`` whose ``key`` (of the type of the first column of ``listed``, null meets null) may be listed: all that
    are, and a few more. The filter, at most ``words`` rows, is broadcast, so wide rows that it rules out are
    never shuffled; an exact join is to follow."""
    out, flag, added = _filtered(df, key, listed, words)
    return out.filter(F.col(flag)).drop(*added)


def without(df: DataFrame, keys: Sequence[Column], listed: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The rows of ``df`` whose ``keys`` are not in ``listed`` (its columns in the same order, null meets null).
    Only rows whose first key passes the filter of :func:`may_be_listed` are joined."""
    out, flag, added = _filtered(df, keys[0], listed, words)
    own = unused_names(df.columns, len(keys))
    gone = listed.toDF(*own)
    on = [k.eqNullSafe(F.col(n)) for k, n in zip(keys, own, strict=True)]
    doubtful = out.filter(F.col(flag)).drop(*added).join(gone, on, "left_anti")
    return out.filter(~F.col(flag)).drop(*added).union(doubtful)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc_fold(col: str = "doc_id", parts: int = 5):
    """crc32 of the id written as text, modulo ``parts`` (null ids: as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def py_fold(doc_id, parts: int = 5) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_chars: int = SLICE_CHARS) -> Iterator[tuple[dict[str, list], list[str]]]:
    """Python columns of the batches, cut so that no slice but a single long text
    holds more than ``max_chars`` bytes; the second part is the text column, null as empty."""
    for part, texts in batch_slices(batches, text, max_chars):
        yield {c: part.column(c).to_pylist() for c in part.schema.names if c != text}, texts


def to_batch(columns: Sequence, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                                      schema=schema)


def filesystem(uri: str):
    """(file system, path) of a folder that driver and executors share."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def commit_file(uri: str, name: str, attempt: str):
    """(file system, temporary path, final path) for a task's output file. The final name
    carries the attempt, so a retried or speculative task never touches another's file;
    only files that the written manifest names are read."""
    file_system, base = filesystem(uri)
    file_system.create_dir(base, recursive=True)
    return file_system, f"{base}/.{name}-{attempt}.tmp", f"{base}/{name}-{attempt}"
