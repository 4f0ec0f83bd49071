"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a string of ``LENGTH`` bytes which also starts anywhere else (in the
same document or another) is removed; a string never crosses documents. Call the string
at a byte its window. The decision on every window is made on sorted suffixes:

1. ``slice_table`` writes the texts as rows of concatenated documents. Of equal texts
   one stands for all: a text with a copy, if it holds a window at all, goes whole.
2. ``repeated_grams`` leaves out what provably cannot repeat. Of all 32-byte grams those whose hash
   is divisible by ``SAMPLE`` are counted over all texts; a window that holds a gram that occurs once
   occurs once itself. Tasks send sorted distinct hashes, cut into hash ranges, and get back the repeated ones.
3. ``contexts`` deals the windows that are left to shards by their content: a window's key
   is its least gram, equal windows have equal keys, and neighbouring windows with the
   same gram travel as one context, the text they cover. Keys with more than ``SHARD_ROWS``
   contexts are spread over several shards by position.
4. A shard's contexts, equal ones once, get a suffix array (``suffix_array``: Larsson-Sadakane
   refinement, ranks of twice the length from pairs of ranks, only unsorted groups again) and
   the common prefixes of its neighbours (``common_prefixes``: Kasai's walk, all contexts in
   step). A window repeats if it shares ``LENGTH`` bytes with a neighbour or its context has copies.
5. Shards of a spread key are merged: each sends the digests of its distinct windows, sorted and
   cut into ranges by binary search, and a task per range finds by binary search those
   that another shard has too.
6. The repeated stretches go back to their slices, and one pass removes them.

A slice, a shard and a range are bounded, whatever repeats. The tables between the steps lie under the
shared checkpoint folder; the small ones are read back per part of the slice table, so the
texts themselves are never shuffled. Null text counts as empty, a document shorter
than ``LENGTH`` loses nothing, equal ids and repeated rows are documents of their own, an
empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import filesystem, shuffle_partitions, staged, to_batch
from fundlens.llm.ngram_join import mix
from fundlens.session import scratch_dir

LENGTH = 400
GRAM = 32
#: One gram in so many is counted, chosen by its hash.
SAMPLE = 32
#: Bytes of a slice (a longer text is a slice of its own) and of a block that is hashed at once.
SLICE = 2_000_000
#: Slices whose grams are sent, and asked for, together.
GROUP = 32
#: Bytes of contexts that get one suffix array, and contexts of one key that may share it.
SHARD = 4_000_000
SHARD_ROWS = 4096
#: Distinct windows of spread keys in a range.
RANGE = 1_000_000

_SLICES = pa.schema([("part", pa.int32()), ("no", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                     ("digests", pa.list_(pa.binary())), ("data", pa.binary())])
_SENT = pa.schema([("range", pa.int64()), ("part", pa.int32()), ("grp", pa.int64()), ("hashes", pa.binary()), ("twice", pa.binary())])
_REPEATED = pa.schema([("part", pa.int32()), ("grp", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary())])
_CONTEXTS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("no", pa.int64()), ("at", pa.binary()), ("text", pa.binary())])
_FOUND = pa.schema([("part", pa.int32()), ("no", pa.int64()), ("spans", pa.binary()), ("key", pa.int64()), ("salt", pa.int64()),
                    ("range", pa.int64()), ("windows", pa.binary()), ("owners", pa.binary())])
_SPANS = pa.schema([("part", pa.int32()), ("no", pa.int64()), ("spans", pa.binary())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string())])
_DDL = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>",
        pa.list_(pa.binary()): "array<binary>"}

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_POSITION = np.uint64((1 << 28) - 1)


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for f in schema)


# Slices


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part, no = TaskContext.get().partitionId(), 0
    held, held_bytes = [], 0

    def row(docs):
        ids, texts = zip(*docs, strict=True)
        return to_batch(([part], [no], [ids], [[len(t) for t in texts]], [[hashlib.sha256(t).digest() for t in texts]],
                         [b"".join(texts)]), _SLICES)

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            text = text.as_py() or b""
            if held and held_bytes + len(text) > size:
                yield row(held)
                held, held_bytes, no = [], 0, no + 1
            held.append((doc_id, text))
            held_bytes += len(text)
    if held:
        yield row(held)


def slice_table(docs: DataFrame, size: int = SLICE) -> DataFrame:
    """The documents as rows of about ``size`` bytes, written: ``part, no`` name a row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return staged(texts.mapInArrow(partial(_cut, size=size), _ddl(_SLICES)), "byte-slices")


def _by_part(df: DataFrame, name: str, *order: str) -> str:
    """``df`` written with a folder per ``part``; a task reads those of its own slices."""
    path = scratch_dir(df.sparkSession, name)
    df.repartition("part").sortWithinPartitions("part", *order).write.partitionBy("part").parquet(path)
    return path


def _part_reader(path: str, columns: list[str]) -> Callable[[int], pa.Table | None]:
    """Reads the rows of one part; the last part is kept."""
    @lru_cache(maxsize=1)
    def read(part: int) -> pa.Table | None:
        from pyarrow import fs

        file_system, base = filesystem(path)
        found = file_system.get_file_info(fs.FileSelector(f"{base}/part={part}", allow_not_found=True))
        tables = [pq.ParquetFile(file_system.open_input_file(f.path)).read(columns) for f in found if f.path.endswith(".parquet")]
        return pa.concat_tables(tables) if tables else None
    return read


def _copies(slices: DataFrame) -> DataFrame:
    """``part, no, i, first`` of every document whose text other documents have too."""
    docs = slices.select("part", "no", F.posexplode(F.arrays_zip("sizes", "digests")).alias("i", "d")) \
        .select("part", "no", "i", F.col("d.digests").alias("digest"), F.col("d.sizes").alias("size"))
    docs = docs.filter(F.col("size") >= LENGTH)
    groups = staged(docs.groupBy("digest").agg(F.min(F.struct("part", "no", "i")).alias("head"), F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("digest", "head"), "equal-texts")
    return docs.join(groups, "digest").select("part", "no", "i", (F.struct("part", "no", "i") == F.col("head")).alias("first"))


class _Slice:
    """A row of the slice table with the documents that take part in the search."""

    def __init__(self, part: int, no: int, sizes: list[int], data: bytes, copies: pa.Table | None):
        self.part, self.no, self.data = part, no, np.frombuffer(data, np.uint8)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.starts = self.ends - np.array(sizes, np.int64)
        copied = [(i, first) for n, i, first in zip(*(copies.column(c).to_pylist() for c in ("no", "i", "first")), strict=True)
                  if n == no] if copies is not None else []
        self.copied = [i for i, _ in copied]
        self.live = np.ones(len(sizes), bool)
        self.live[[i for i, first in copied if not first]] = False

    def blocks(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(first, end) of the window starts of a block and the end of its bytes."""
        for at in range(0, len(self.data), size):
            yield at, min(at + size, len(self.data)), min(at + size + LENGTH - 1, len(self.data))

    def within(self, positions: np.ndarray, width: int) -> np.ndarray:
        """Which of the positions start ``width`` bytes within a live document."""
        doc = np.searchsorted(self.ends, positions, side="right")
        ok = doc < len(self.ends)
        doc[~ok] = 0
        return ok & self.live[doc] & (positions + width <= self.ends[doc])


def _slices(batches: Iterator[pa.RecordBatch], copies: str) -> Iterator[_Slice]:
    read = _part_reader(copies, ["no", "i", "first"])
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.column("part")[i].as_py()
            yield _Slice(part, batch.column("no")[i].as_py(), batch.column("sizes")[i].as_py(), batch.column("data")[i].as_buffer(), read(part))


# Grams


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes at each position, from running sums."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << (n - 1).bit_length())
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[:n], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[:n - width + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sampled(s: _Slice, first: int, end: int, hashes: np.ndarray, sample: int) -> np.ndarray:
    """Positions in the block of counted grams that lie within one live document."""
    at = np.flatnonzero(hashes % np.uint64(sample) == 0)
    return at[s.within(at + first, GRAM)]


def _send(batches: Iterator[pa.RecordBatch], copies: str, ranges: int, sample: int, block: int) -> Iterator[pa.RecordBatch]:
    """The distinct counted grams of each group of slices, sorted and cut into hash ranges."""
    group, held = None, []

    def cut():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(_range(values, ranges), np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(cuts)):
            mine = slice(cuts[r], cuts[r + 1])
            yield (int(r), *group, values[mine].tobytes(), np.packbits(counts[mine] > 1).tobytes())

    for s in _slices(batches, copies):
        if group != (s.part, s.no // GROUP):
            if held:
                yield to_batch(list(zip(*cut(), strict=True)) or [[]] * len(_SENT), _SENT)
            group, held = (s.part, s.no // GROUP), []
        for first, end, stop in s.blocks(block):
            h = gram_hashes(s.data[first:stop])
            held.append(h[_sampled(s, first, end, h, sample)])
    if held:
        yield to_batch(list(zip(*cut(), strict=True)) or [[]] * len(_SENT), _SENT)


def _range(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range, arriving in one run, the grams of each group that occur twice or more over all groups."""
    now, rows = None, []

    def repeated():
        arrays = [np.frombuffer(h, np.uint64) for _, _, h, _ in rows]
        values = np.concatenate(arrays)
        often = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=len(a)) for a, (_, _, _, t) in zip(arrays, rows, strict=True)])
        order = np.argsort(values, kind="stable")
        v = values[order]
        heads = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        total = np.add.reduceat(1 + often[order].astype(np.int64), heads)
        hit = np.zeros(len(values), bool)
        hit[order] = np.repeat(total > 1, np.diff(np.r_[heads, len(v)]))
        at = 0
        for a, (part, grp, _, _) in zip(arrays, rows, strict=True):
            yield part, grp, now, a[hit[at:at + len(a)]].tobytes()
            at += len(a)

    for batch in batches:
        for r, part, grp, hashes, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r != now:
                if rows:
                    yield to_batch(list(zip(*repeated(), strict=True)), _REPEATED)
                now, rows = r, []
            rows.append((part, grp, hashes, twice))
    if rows:
        yield to_batch(list(zip(*repeated(), strict=True)), _REPEATED)


def repeated_grams(slices: DataFrame, copies: str, sample: int = SAMPLE, block: int = SLICE) -> str:
    """Where the counted grams lie, by part and group of slices, that occur twice or more anywhere."""
    ranges = max(1, shuffle_partitions(slices.sparkSession))
    sent = slices.select("part", "no", "sizes", "data") \
        .mapInArrow(partial(_send, copies=copies, ranges=ranges, sample=sample, block=block), _ddl(_SENT))
    counted = sent.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(_count, _ddl(_REPEATED))
    return _by_part(counted, "repeated-grams", "grp", "range")


# Contexts


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.diff(np.r_[False, flags, False].astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _dealt(hashes: np.ndarray, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, first window and number of windows of each context of the candidate windows."""
    width = LENGTH - GRAM + 1
    first, end = runs(candidate)
    if not len(first):
        return np.zeros(0, np.int64), first, first
    sizes = end - first + width - 1
    at = spread(first, sizes)
    # The least gram by the upper bits of its hash, the leftmost of equal ones.
    least = sliding_min((hashes[at] & ~_POSITION) | np.arange(len(at), dtype=np.uint64), width)
    offset = np.cumsum(sizes) - sizes
    least = least[spread(offset, end - first)]
    window = spread(first, end - first)
    heads = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    keys = hashes[at[(least[heads] & _POSITION).astype(np.int64)]].view(np.int64)
    return keys, window[heads], np.diff(np.r_[heads, len(least)])


def _contexts(batches: Iterator[pa.RecordBatch], copies: str, grams: str, sample: int, block: int) -> Iterator[pa.RecordBatch]:
    read = _part_reader(grams, ["grp", "hashes"])

    @lru_cache(maxsize=1)
    def known(part: int, grp: int) -> np.ndarray:
        rows = read(part)
        mine = [] if rows is None else [h for g, h in zip(rows.column("grp").to_pylist(), rows.column("hashes").to_pylist(), strict=True) if g == grp]
        return np.unique(np.frombuffer(b"".join(mine), np.uint64))

    for s in _slices(batches, copies):
        repeated = known(s.part, s.no // GROUP)
        found: dict[tuple[int, bytes], list[int]] = {}
        for first, end, stop in s.blocks(block):
            data = s.data[first:stop]
            if len(data) < LENGTH:
                continue
            h = gram_hashes(data)
            at = _sampled(s, first, end, h, sample)
            place = np.searchsorted(repeated, h[at])
            alone = at[place == len(repeated)] if not len(repeated) else at[repeated[np.minimum(place, len(repeated) - 1)] != h[at]]
            count = np.zeros(len(data) + 1, np.int32)
            count[alone + 1] = 1
            np.cumsum(count, out=count)
            n = min(len(data) - LENGTH + 1, end - first)
            candidate = count[LENGTH - GRAM + 1:LENGTH - GRAM + 1 + n] == count[:n]
            here = np.flatnonzero(candidate)
            candidate[here[~s.within(here + first, LENGTH)]] = False
            raw = data.tobytes()
            for key, lo, size in zip(*(x.tolist() for x in _dealt(h, candidate)), strict=True):
                found.setdefault((key, raw[lo:lo + size + LENGTH - 1]), []).append(first + lo)
        if found:
            yield to_batch(([k for k, _ in found], [s.part] * len(found), [s.no] * len(found),
                            [np.array(v, np.int64).tobytes() for v in found.values()], [t for _, t in found]), _CONTEXTS)


def contexts(slices: DataFrame, copies: str, grams: str, sample: int = SAMPLE, block: int = SLICE) -> DataFrame:
    """``key, part, no, at, text`` of all contexts of windows that may repeat, written; those of one slice
    with equal texts are one row with all their positions."""
    rows = slices.select("part", "no", "sizes", "data") \
        .mapInArrow(partial(_contexts, copies=copies, grams=grams, sample=sample, block=block), _ddl(_CONTEXTS))
    return staged(rows, "contexts")


# Suffix arrays


def suffix_array(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes of several strings in order: (positions, their ranks, bytes left at each position, the
    first seven bytes at each position as a number).

    ``ends`` are the strings' ends in ``text``; a suffix ends with its string, and equal suffixes are
    ordered by position. Larsson-Sadakane: the first ranks come from seven bytes; each round sorts the
    groups of equal rank by the rank of what follows the bytes compared so far, which doubles their number.
    """
    n = len(text)
    starts = np.r_[0, ends[:-1]]
    left = np.repeat(ends, ends - starts) - np.arange(n)
    padded = np.zeros(n + 7, np.uint64)
    padded[:n] = text
    word = np.zeros(n, np.uint64)
    for i in range(7):
        word = (word << np.uint64(8)) | np.where(left > i, padded[i:n + i], np.uint64(0))
    key = (word << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    slots, key, width = np.arange(n), key[order], 7
    while True:
        # slots: the places in order of the suffixes just sorted, key: their keys, ascending.
        new = np.r_[True, key[1:] != key[:-1]]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.r_[heads, len(slots)])
        rank[order[slots]] = np.repeat(slots[heads], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            break
        at = order[slots]
        # A suffix that ends here comes first, equal ones by position; others by the rank of what follows.
        follows = np.where(left[at] > width, n + rank[np.minimum(at + width, n - 1)], at)
        key = (rank[at].astype(np.uint64) << np.uint64(32)) | follows.astype(np.uint64)
        sort = np.argsort(key)
        order[slots], key, width = at[sort], key[sort], 2 * width
    return order, rank, left, word


def common_prefixes(order: np.ndarray, rank: np.ndarray, left: np.ndarray, word: np.ndarray, ends: np.ndarray,
                    windows: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """By rank, the bytes (``limit`` at most) that a suffix shares with the one before it, for the first
    ``windows`` suffixes of each string (others: 0).

    Kasai: the suffix after one that shares k bytes shares k - 1 at least with its own predecessor. All
    strings take each step together.
    """
    starts = np.r_[0, ends[:-1]]
    by_size = np.argsort(-windows, kind="stable")
    starts, windows = starts[by_size], windows[by_size]
    shared = np.zeros(len(order), np.int32)
    k = np.zeros(len(starts), np.int64)
    for step in range(int(windows.max(initial=0))):
        live = int(np.searchsorted(-windows, -step, side="left"))
        at = starts[:live] + step
        r = rank[at]
        before = order[np.maximum(r - 1, 0)]
        k = np.maximum(k[:live] - 1, 0)
        most = np.minimum(np.minimum(left[at], left[before]), limit)
        most[r == 0] = 0
        k = np.minimum(k, most)
        todo = np.flatnonzero(k < most)
        while len(todo):
            a, b, j = at[todo], before[todo], k[todo]
            differ = word[a + j] ^ word[b + j]
            # Equal leading bytes of the seven: from the highest set bit of their difference.
            same = np.where(differ == 0, 7, np.maximum(6 - (np.frexp(differ.astype(np.float64))[1] - 1) // 8, 0))
            k[todo] = np.minimum(j + same, most[todo])
            todo = todo[(differ == 0) & (k[todo] < most[todo])]
        shared[r] = k
    return shared


class _Shard:
    """Distinct contexts with their places, up to the bytes of one suffix array."""

    def __init__(self):
        self.texts: list[bytes] = []
        self.places: list[list[tuple[int, int, bytes]]] = []
        self.keys: list[tuple[int, int, int]] = []
        self.size = 0

    def add(self, key: tuple[int, int, int], text: bytes, place: tuple[int, int, bytes]) -> None:
        if self.texts and self.keys[-1] == key and self.texts[-1] == text:
            self.places[-1].append(place)
            return
        self.texts.append(text)
        self.places.append([place])
        self.keys.append(key)
        self.size += len(text)

    def decide(self, ranges: int) -> Iterator[tuple]:
        """Rows of ``_FOUND``: the repeated stretches by slice, and the distinct windows of spread keys."""
        sizes = np.array([len(t) for t in self.texts])
        ends, windows = np.cumsum(sizes), sizes - LENGTH + 1
        starts = ends - sizes
        order, rank, left, word = suffix_array(np.frombuffer(b"".join(self.texts), np.uint8), ends)
        shared = common_prefixes(order, rank, left, word, ends, windows)
        near = shared >= LENGTH
        hit = np.zeros(len(order), bool)
        hit[order] = near | np.r_[near[1:], False]
        many = np.array([len(p) > 1 or len(p[0][2]) > 8 for p in self.places])
        hit[spread(starts[many], windows[many])] = True
        yield from self._spans(hit, starts, ends)
        loose = np.array([k[2] > 1 for k in self.keys])
        if loose.any():
            yield from self._sorted_windows(order, near, hit, starts, windows, loose, ranges)

    def _spans(self, hit: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        first, end = runs(hit)  # never across contexts: the last bytes of each start no window
        context = np.searchsorted(ends, first, side="right")
        by_slice: dict[tuple[int, int], list[np.ndarray]] = {}
        for c, lo, n in zip(context.tolist(), (first - starts[context]).tolist(), (end - first).tolist(), strict=True):
            for part, no, at in self.places[c]:
                p = np.frombuffer(at, np.int64) + lo
                by_slice.setdefault((part, no), []).append(np.stack([p, p + n + LENGTH - 1], axis=1))
        for (part, no), spans in by_slice.items():
            yield part, no, np.concatenate(spans).tobytes(), None, None, None, None, None

    def _sorted_windows(self, order, near, hit, starts, windows, loose, ranges) -> Iterator[tuple]:
        """Per key, salt and range the digests of the distinct windows, ascending, and who owns them:
        (part, slice, position) of a window not yet found to repeat, else part -1."""
        wanted = np.zeros(len(order), bool)
        wanted[spread(starts[loose], windows[loose])] = True
        heads = order[~near & wanted[order]]
        context = np.searchsorted(starts, heads, side="right") - 1
        by_key: dict[tuple[int, int], list[tuple[bytes, int, int, int]]] = {}
        for c, lo, found in zip(context.tolist(), (heads - starts[context]).tolist(), hit[heads].tolist(), strict=True):
            part, no, at = self.places[c][0]
            owner = (-1, 0, 0) if found else (part, no, int.from_bytes(at[:8], "little") + lo)
            digest = hashlib.blake2b(self.texts[c][lo:lo + LENGTH], digest_size=16).digest()
            by_key.setdefault(self.keys[c][:2], []).append((digest, *owner))
        for (key, salt), rows in by_key.items():
            rows.sort()
            high = np.array([int.from_bytes(d[:8], "big") for d, *_ in rows], np.uint64)
            cuts = np.searchsorted(_range(high, ranges), np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                mine = rows[cuts[r]:cuts[r + 1]]
                yield (None, None, None, key, salt, r, b"".join(d for d, *_ in mine),
                       np.array([o for _, *o in mine], np.int64).tobytes())


def _decide(batches: Iterator[pa.RecordBatch], ranges: int, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by key, salt and text in; a suffix array per ``shard_bytes``, cut between keys."""
    shard = _Shard()
    for batch in batches:
        names = batch.schema.names
        cols = {c: batch.column(names.index(c)).to_pylist() for c in names}
        for key, salt, salts, part, no, at, text in zip(*(cols[c] for c in ("key", "salt", "salts", "part", "no", "at", "text")), strict=True):
            if shard.size >= shard_bytes and shard.keys[-1] != (key, salt, salts):
                yield to_batch(list(zip(*shard.decide(ranges), strict=True)) or [[]] * len(_FOUND), _FOUND)
                shard = _Shard()
            shard.add((key, salt, salts), text, (part, no, at))
    if shard.texts:
        yield to_batch(list(zip(*shard.decide(ranges), strict=True)) or [[]] * len(_FOUND), _FOUND)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted windows by key and range in, the stretches of owners whose window another shard has too out."""
    now, rows = None, []

    def both():
        arrays = [np.frombuffer(w, "S16") for w, _ in rows]
        merged = np.sort(np.concatenate(arrays))
        for mine, (_, owners) in zip(arrays, rows, strict=True):
            # Windows are distinct within a shard, so two in the merged list are of two shards.
            twice = np.searchsorted(merged, mine, side="right") - np.searchsorted(merged, mine, side="left") > 1
            own = np.frombuffer(owners, np.int64).reshape(-1, 3)
            for part, no, at in own[twice & (own[:, 0] >= 0)].tolist():
                yield part, no, np.array([at, at + LENGTH], np.int64).tobytes()

    for batch in batches:
        for key, r, windows, owners in zip(*(batch.column(c).to_pylist() for c in ("key", "range", "windows", "owners")), strict=True):
            if now != (key, r):
                if rows:
                    yield to_batch(list(zip(*both(), strict=True)) or [[]] * len(_SPANS), _SPANS)
                now, rows = (key, r), []
            rows.append((windows, owners))
    if rows:
        yield to_batch(list(zip(*both(), strict=True)) or [[]] * len(_SPANS), _SPANS)


def repeated_spans(found: DataFrame, shard_rows: int = SHARD_ROWS, shard_bytes: int = SHARD, range_windows: int = RANGE) -> DataFrame:
    """``part, no, spans`` of the stretches (pairs of 64-bit positions in the slice) that repeat."""
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows)
    hot = staged(counts.select("key", F.ceil(F.col("n") / shard_rows).cast("long").alias("salts")), "spread-keys")
    largest = hot.agg(F.max("salts")).first()[0] or 1
    ranges = max(1, -(-largest * shard_rows * LENGTH // range_windows))
    one = F.lit(1).cast("long")
    dealt = found.withColumn("salts", one) if largest == 1 else found.join(hot, "key", "left").withColumn("salts", F.coalesce("salts", one))
    dealt = dealt \
        .withColumn("salt", F.pmod(F.xxhash64("part", "no", "at"), F.col("salts")))
    decided = staged(dealt.repartition("key", "salt").sortWithinPartitions("key", "salt", "text")
                     .mapInArrow(partial(_decide, ranges=ranges, shard_bytes=shard_bytes), _ddl(_FOUND)), "decided-windows")
    spans = decided.filter("part IS NOT NULL").select("part", "no", "spans")
    if largest == 1:
        return spans
    merged = decided.filter("part IS NULL").select("key", "range", "windows", "owners").repartition("key", "range") \
        .sortWithinPartitions("key", "range").mapInArrow(_merge, _ddl(_SPANS))
    return spans.unionByName(merged)


# Results


def _remove(batches: Iterator[pa.RecordBatch], copies: str, spans: str) -> Iterator[pa.RecordBatch]:
    read_copies, read_spans = _part_reader(copies, ["no", "i", "first"]), _part_reader(spans, ["no", "spans"])
    for batch in batches:
        for i in range(batch.num_rows):
            part, no = batch.column("part")[i].as_py(), batch.column("no")[i].as_py()
            doc_ids, sizes = batch.column("doc_ids")[i].as_py(), batch.column("sizes")[i].as_py()
            s = _Slice(part, no, sizes, batch.column("data")[i].as_buffer(), read_copies(part))
            rows = read_spans(part)
            mine = [] if rows is None else [x for n, x in zip(rows.column("no").to_pylist(), rows.column("spans").to_pylist(), strict=True) if n == no]
            edge = np.zeros(len(s.data) + 1, np.int32)
            for pair in [np.frombuffer(b"".join(mine), np.int64).reshape(-1, 2), np.stack([s.starts, s.ends], axis=1)[s.copied]]:
                np.add.at(edge, pair[:, 0], 1)
                np.add.at(edge, pair[:, 1], -1)
            gone = np.cumsum(edge[:-1]) > 0
            out = []
            for doc_id, a, b in zip(doc_ids, s.starts.tolist(), s.ends.tolist(), strict=True):
                cut = gone[a:b]
                kept = s.data[a:b][~cut] if cut.any() else s.data[a:b]
                out.append((doc_id, b - a, b - a - len(kept), len(runs(cut)[0]), hashlib.sha256(kept.tobytes()).hexdigest()))
            yield to_batch(list(zip(*out, strict=True)), _RESULT)


def remove_repeats(docs: DataFrame, sample: int = SAMPLE, slice_bytes: int = SLICE, shard_rows: int = SHARD_ROWS,
                   shard_bytes: int = SHARD, range_windows: int = RANGE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of each document."""
    slices = slice_table(docs, slice_bytes)
    copies = _by_part(_copies(slices), "copied-texts", "no", "i")
    grams = repeated_grams(slices, copies, sample, slice_bytes)
    found = contexts(slices, copies, grams, sample, slice_bytes)
    spans = _by_part(repeated_spans(found, shard_rows, shard_bytes, range_windows), "repeated-spans", "no")
    return slices.mapInArrow(partial(_remove, copies=copies, spans=spans), _ddl(_RESULT))
