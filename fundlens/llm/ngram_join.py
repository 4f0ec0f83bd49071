"""N-gram Jaccard join by MinHash banding.

1. A text's n-grams are its distinct runs of five words (lower case, letters and digits);
   a shorter text has one n-gram, all its words. Texts with equal n-gram sets are copies and
   form one class; everything below works on classes.
2. ``choose_bands`` picks rows and bands from the threshold and the target recall: the most
   selective band (most rows) whose bands still fit ``MAX_HASHES``. Band hashes are
   shuffled; classes that share one are linked to the least class of the bucket (counted and
   joined, so a bucket of any size emits one row per member).
3. Candidates are the pairs that share a band. To meet each of them once, however many bands
   it shares, the components of the links are cut into blocks of bounded size, and a class goes to
   the pairs of blocks in which it shares a band with another class: to its own block if the
   component has one, to all if one bucket holds a large part of the component (nearly every pair is a
   candidate then), else to the blocks that its buckets reach. Each pair of blocks is one
   task group, which finds the candidates among its classes by their bands and compares the full
   n-gram sets of these: partner by partner, or at once by products of incidence matrices where
   most pairs are candidates. It emits one row per class and block pair (link count and a
   spanning link), never a row per pair; no candidate is left out.
   The texts of these classes are found by a filter of their ids that is broadcast, at most ``FILTER_WORDS``
   rows, before the exact join, and become n-gram sets in the same pass: other texts are never shuffled.
4. Verified spanning links give the near-duplicate groups by connected components.

A pair at the threshold is missed with probability ``1 - recall`` at most; a more similar
one less often. Texts without words have no n-grams: they are linked to nothing, and each
is a group of its own. Null text counts as empty, a null ``doc_id`` never names a group
unless all its members have none, repeated rows are copies, extra columns are ignored, and
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import (batch_slices, may_be_listed, shuffle_partitions, slices, staged, text_or_empty, to_batch, without,
                                 worker_cache)
from fundlens.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
BLOCK_CLASSES = 512
BLOCK_NGRAMS = 1_500_000
#: Words whose hashes a worker keeps, and the longest of them.
KEPT_WORDS, KEPT_CHARS = 150_000, 64
#: A component goes to all its block pairs if its largest bucket holds one class in so many.
DENSE = 8

_WORD = re.compile(r"[^\W_]+")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # multipliers of the splitmix64 finaliser
_SIGNED = pa.schema([("doc_id", pa.int64()), ("set_id", pa.binary()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("set_id", pa.binary()), ("ngrams", pa.binary())])
_LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())])


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(rows, bands): a pair at the threshold shares a band with probability ``recall`` at least."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if rows * bands > max_hashes:
            break
        best = rows, bands
    if best is None:
        raise ValueError("no bands reach the recall within max_hashes")
    return best


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """word -> 64-bit hash, the same in every process; bounded."""

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = h
        return h


def _word_hashes() -> _WordHashes:
    return worker_cache("ngrams", "words", _WordHashes)


def ngram_set(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit n-gram hashes of a whole text."""
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_word_hashes().__getitem__, found), np.uint64, len(found))
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i])
    return np.unique(h)


def set_id(ngrams: np.ndarray) -> bytes:
    return hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest()


def _hash_params(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds[:count] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[count:] >> np.uint64(32)).astype(np.uint32)


def min_hashes(ngrams: np.ndarray, mult: np.ndarray, add: np.ndarray, piece: int = 4096) -> np.ndarray:
    x, out = (ngrams >> np.uint64(32)).astype(np.uint32), np.full(len(mult), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), piece):
        np.minimum(out, (mult[:, None] * x[None, at:at + piece] + add[:, None]).min(axis=1), out=out)
    return out


def band_hashes(signatures: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """(texts, bands) of 64-bit band keys, distinct between bands."""
    parts = signatures[:, :rows * bands].reshape(len(signatures), bands, rows).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return h.view(np.int64)


def _sign(batches, words: int, rows: int, bands: int) -> Iterator[pa.RecordBatch]:
    mult, add = _hash_params(rows * bands)
    for cols, texts in slices(batches):
        sets = [ngram_set(t, words) for t in texts]
        full = [s for s in sets if len(s)]
        keys = band_hashes(np.stack([min_hashes(s, mult, add) for s in full]), rows, bands) if full else np.zeros((0, bands), np.int64)
        counts = np.array([bands if len(s) else 0 for s in sets])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                                          pa.array([len(s) for s in sets], pa.int64()), lists], schema=_SIGNED)


def _sets(batches, words: int) -> Iterator[pa.RecordBatch]:
    for _, texts in slices(batches):
        found = [ngram_set(t, words) for t in texts]
        yield to_batch([[set_id(s) for s in found], [s.tobytes() for s in found]], _SETS)


def _texts_to_sets(batches, words: int) -> Iterator[pa.RecordBatch]:
    """The rows with ``ngrams`` in the place of ``text``, the last column."""
    for part, texts in batch_slices(batches):
        sets = pa.array([ngram_set(t, words).tobytes() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], sets], names=[*part.schema.names[:-1], "ngrams"])


def linked(sets: list[np.ndarray], threshold: Fraction, side: np.ndarray | None = None, piece: int = 4096) -> np.ndarray:
    """The boolean matrix of pairs with Jaccard similarity of the threshold at least (none with
    itself); with ``side``, only pairs from different sides."""
    k, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, shared = np.repeat(np.arange(k), sizes), times > 1
    rank = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], rank[column[use]]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    common = np.zeros((k, k), np.float64)
    for at in range(0, int(shared.sum()), piece):
        a, b = np.searchsorted(column, [at, at + piece])
        cells = np.zeros((k, piece), np.float32)
        cells[row[a:b], column[a:b] - at] = 1
        common += cells @ cells.T
    common = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    out = common * threshold.denominator >= union * threshold.numerator
    np.fill_diagonal(out, False)
    return out if side is None else out & (side[:, None] != side[None, :])


def sharing(bands: np.ndarray) -> np.ndarray:
    """The boolean matrix of pairs of rows that have a band in common (none with itself)."""
    out = np.zeros((len(bands), len(bands)), bool)
    for band in bands.T:
        out |= band[:, None] == band[None, :]
    np.fill_diagonal(out, False)
    return out


def linked_partners(sets: list[np.ndarray], pairs: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Like :func:`linked`, but only the ``pairs`` of a symmetric boolean matrix are compared."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    parts = np.split(column, np.cumsum(sizes)[:-1])
    held, out = np.zeros(len(values), bool), np.zeros_like(pairs)
    for a in np.flatnonzero(pairs.any(axis=1)):
        others = a + 1 + np.flatnonzero(pairs[a, a + 1:])
        if not len(others):
            continue
        held[parts[a]] = True
        starts = np.cumsum(sizes[others]) - sizes[others]
        common = np.add.reduceat(held[np.concatenate([parts[b] for b in others])].astype(np.int64), starts)
        held[parts[a]] = False
        out[a, others] = common * threshold.denominator >= (sizes[a] + sizes[others] - common) * threshold.numerator
    return out | out.T


def verified(sets: list[np.ndarray], bands: np.ndarray, threshold: Fraction, side: np.ndarray | None = None) -> np.ndarray:
    """The boolean matrix of linked pairs among those that share a band; with ``side``, only pairs from different sides."""
    pairs = sharing(bands)
    if side is not None:
        pairs &= side[:, None] != side[None, :]
    if 2 * int(pairs.sum()) <= len(sets) * (len(sets) - 1):
        return linked_partners(sets, pairs, threshold)
    return linked(sets, threshold, side) & pairs


def _roots(matrix: np.ndarray) -> np.ndarray:
    """The least member of each one's connected component."""
    label = np.arange(len(matrix))
    while True:
        low = np.where(matrix, label[None, :], len(matrix)).min(axis=1, initial=len(matrix))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(batches, threshold: Fraction) -> Iterator[pa.RecordBatch]:
    """Groups of equal (part, i, j), which follow one another; at most two blocks at a time are held."""
    key, group = None, []

    def close():
        node, block, copies, bands, sets = zip(*group, strict=True)
        matrix = verified([np.frombuffer(s, np.uint64) for s in sets], np.array(bands, np.int64), threshold,
                          np.array(block) if key[1] != key[2] else None)
        some = np.flatnonzero(matrix.any(axis=1))
        ids = np.array(node, np.int64)
        return to_batch([ids[some], (matrix @ np.array(copies, np.int64))[some], ids[_roots(matrix)][some]], _LINKS)

    for batch in batches:
        for part, i, j, *rest in zip(*(batch.column(c).to_pylist() for c in ("part", "i", "j", "node", "block", "copies", "bands", "ngrams")), strict=True):
            if (part, i, j) != key:
                if len(group) > 1:
                    yield close()
                key, group = (part, i, j), []
            group.append(rest)
    if len(group) > 1:
        yield close()


def _destinations(blocked: DataFrame) -> DataFrame:
    """``node, other``: the blocks of its component in which a class may have candidates."""
    fixed = blocked.filter("blocks = 1 OR dense").select("node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    inside = staged(blocked.filter("blocks > 1 AND NOT dense").select("node", "block", F.explode("bands").alias("band")), "ngram-inside")
    reached = staged(inside.groupBy("band", F.col("block").alias("other")).agg(F.count(F.lit(1)).alias("members")), "ngram-reached")
    by_band = inside.join(reached, "band").filter("block <> other OR members > 1").select("node", "other").distinct()
    return fixed.unionByName(by_band)


def class_sets(texts: DataFrame, wanted: DataFrame, words: int, unclear: bool) -> DataFrame:
    """``wanted`` with the ``ngrams`` of each class. Texts are found by the id that names the class, behind a filter, so of all others
    none is shuffled; where ids are missing or repeated (``unclear``), more texts come along and are told apart by their set."""
    near = may_be_listed(texts, F.col("doc_id"), wanted.select("copy_id"))
    if unclear:
        sets = near.select("text").mapInArrow(partial(_sets, words=words), "set_id binary, ngrams binary")
        sets = sets.join(wanted.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"])
        return wanted.join(sets, "set_id")
    rows = wanted.join(near, F.col("copy_id") == F.col("doc_id")).select(*wanted.columns, "text")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema)
    return rows.mapInArrow(partial(_texts_to_sets, words=words), f"{shape}, ngrams binary")


def ngram_join(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
               max_hashes: int = MAX_HASHES, block_classes: int = BLOCK_CLASSES) -> DataFrame:
    """A row per document: ``doc_id, class_id`` (least id of its near-duplicate group),
    ``copy_id`` (least id of the texts with the same n-grams), ``n_links`` (other documents
    at the threshold or above that share a band, copies included), ``n_ngrams``."""
    spark = docs.sparkSession
    rows, bands = choose_bands(threshold, recall, max_hashes)
    exact = Fraction(str(threshold))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = staged(texts.mapInArrow(partial(_sign, words=words, rows=rows, bands=bands),
                                     "doc_id long, set_id binary, n long, bands array<long>"), "ngram-signatures")
    classes = staged(signed.filter("set_id is not null").groupBy("set_id")
                     .agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
                          F.first("bands").alias("bands"))
                     .withColumn("node", F.monotonically_increasing_id()), "ngram-classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    hubs = staged(banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members"))
                  .filter("members > 1"), "ngram-buckets")
    candidates = staged(components(banded.join(hubs.drop("members"), "band").filter("node <> hub")
                                   .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()), "ngram-candidates")
    largest = hubs.groupBy(F.col("hub").alias("node")).agg(F.max("members").alias("members"))
    sizes = staged(candidates.join(classes.select("node", "n"), "node").join(largest, "node", "left").groupBy("label")
                   .agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_classes), F.ceil(F.sum("n") / BLOCK_NGRAMS)).cast("int").alias("blocks"),
                        (F.max("members") * DENSE >= F.count(F.lit(1))).alias("dense")), "ngram-blocks")
    blocked = staged(candidates.join(classes, "node").join(sizes, "label")
                     .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")), "ngram-blocked")
    others = _destinations(blocked).groupBy("node").agg(F.collect_list("other").alias("others"))
    wanted = staged(blocked.join(others, "node").select("set_id", "copy_id", "label", "others", "node", "block", "copies", "bands"), "ngram-wanted")
    unclear = signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")) \
        .filter("rows > 1 OR doc_id IS NULL").limit(1).count() > 0
    keyed = class_sets(texts, wanted, words, unclear) \
        .select(F.col("label").alias("part"), "node", "block", "copies", "bands", "ngrams", F.explode("others").alias("other")) \
        .select("part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "copies", "bands", "ngrams")
    links = staged(keyed.repartition(shuffle_partitions(spark), "part", "i", "j").sortWithinPartitions("part", "i", "j")
                   .mapInArrow(partial(_verify, threshold=exact), "node long, links long, hub long"), "ngram-links")
    groups = components(links.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    labelled = (classes.select("node", "set_id", "copy_id", "copies")
                .join(groups, "node", "left").join(counted, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    labelled = staged(labelled, "ngram-labelled")
    first = staged(labelled.groupBy("label").agg(F.min("copy_id").alias("class_id")), "ngram-groups")
    result = staged(labelled.join(first, "label")
                    .select("set_id", "copy_id", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "ngram-result")
    return (signed.select("doc_id", "set_id", F.col("n").alias("n_ngrams")).join(result, "set_id", "left")
            .select("doc_id", F.when(F.col("links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.when(F.col("links").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "n_ngrams"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one document, the one of the least id, of each near-duplicate group. Rows
    without an id can't be told apart: they stay if one of them does."""
    found = ngram_join(docs, **params).groupBy("doc_id").agg(F.max(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))
    return without(docs, [F.col("doc_id").cast("long")], staged(found.filter("NOT kept").select("doc_id"), "ngram-dropped"))
