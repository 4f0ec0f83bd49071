"""Packing into windows of a fixed size by minimum bin slack.

1. Every document's ids (with its end id) are written once. A document is cut into
   whole windows of ``capacity`` ids and one remaining piece, shorter than a window.
2. Only the histogram of the remaining lengths matters for the plan: at most
   ``capacity`` counts, whatever the corpus holds. ``plan_windows`` fills one window
   pattern at a time: the longest remaining length opens it, then a bitset subset-sum
   dynamic programme over the other lengths and their counts finds the multiset whose sum
   comes closest to what is left, and backtracking gives the count of each length. The
   pattern is used as often as its counts last, so the number of patterns is bounded by
   the window size, not by the corpus.
3. If no multiset fills a window, the next longest piece is cut to fill the gap and its
   rest returns to the histogram; documents are cut for nothing else. So only the very
   last window can have slack. It is padded unless its length is a power of two.
4. Each piece is the n-th of its length: counted inside its task, plus the earlier
   tasks' counts (a row per task and length), joined on (task, length): a length that a
   third of all documents share is spread over as many keys as there are tasks. The plan
   maps (length, n) to a window and an offset by binary search.

Null text counts as empty (one window piece of the end id); repeated rows and repeated
or null ids are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import let_go, slices, staged, text_or_empty, to_batch
from fundlens.llm.huffman import binary_rows, ddl, id_width
from fundlens.llm.pieces import ENCODE_CHARS, MAX_PIECES, encoder

CAPACITY = 2048
#: ``max_pieces`` where earlier stages have filled the executors' heap: less memory, more pieces encoded anew.
FEW_PIECES = 300_000
#: Ids that are cut into window pieces at once; one longer document is taken by itself.
EMIT_IDS = 1_000_000

_IDS = pa.schema([("part", pa.int64()), ("rest", pa.int64()), ("rank", pa.int64()), ("whole_before", pa.int64()),
                  ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("ids", pa.binary())])


def _best_fill(lengths: list[int], counts: np.ndarray, room: int) -> dict[int, int]:
    """The multiset of the given lengths (descending) whose sum is the largest up to ``room``.

    Reachable sums are the bits of one integer; a length's count is split into powers
    of two, so each step is a shift and an or. The steps' bit sets allow backtracking.
    """
    keep, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        left, power = min(int(counts[length]), room // length), 1
        while left:
            times = min(power, left)
            grown = (reach | reach << (times * length)) & keep
            if grown != reach:
                steps.append((length, times, reach))
                reach = grown
            left, power = left - times, power * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= times * length
    return chosen


def plan_windows(histogram: np.ndarray, capacity: int = CAPACITY) -> dict:
    """Where the n-th piece of each remaining length goes.

    ``histogram[l]`` counts the pieces of length ``l`` (0 < l < capacity). Arrays of the
    result, a row per run of equal placements, ordered by (length, lo): pieces
    ``lo <= n < hi`` of the length; ``per`` such pieces in each window of the pattern;
    the pattern's first window ``window``; ``slot`` points to ``offsets``. ``gap`` is the
    part of the piece that is placed (the length itself unless cut); a cut piece's rest is
    piece ``rest_from + (n - lo)`` of length ``length - gap``.
    """
    counts = np.zeros(capacity, np.int64)
    counts[:len(histogram)] = histogram
    used = np.zeros(capacity, np.int64)  # pieces of each length that are placed
    born = counts.copy()  # pieces of each length there are so far, rests of cut ones included
    rows, offsets, window = [], [], 0
    alive = [-int(x) for x in np.flatnonzero(counts)[::-1]]  # negated, so ascending order is longest first
    while alive:
        top = -alive[0]
        counts[top] -= 1
        others = [-x for x in alive if counts[-x]]
        chosen = _best_fill(others, counts, capacity - top)
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        slack = capacity - sum(k * v for k, v in chosen.items())
        times = min(int(counts[k]) // v for k, v in chosen.items())
        gap_of = 0
        if slack:
            left = {-x: int(counts[-x]) - chosen.get(-x, 0) for x in alive}
            gap_of = max((x for x, n in left.items() if n > 0 and x > slack), default=0)
            if gap_of:
                both = chosen | {gap_of: chosen.get(gap_of, 0) + 1}
                times = min(int(counts[k]) // v for k, v in both.items())
            else:
                times = 1  # the last window
        at = 0
        for length in sorted(chosen, reverse=True):
            per = chosen[length]
            rows.append((length, used[length], used[length] + per * times, per, window, len(offsets), length, 0))
            offsets.extend(at + length * i for i in range(per))
            at += length * per
            used[length] += per * times
            counts[length] -= per * times
        if gap_of:
            rest = gap_of - slack
            rows.append((gap_of, used[gap_of], used[gap_of] + times, 1, window, len(offsets), slack, born[rest]))
            offsets.append(at)
            used[gap_of] += times
            counts[gap_of] -= times
            if not counts[rest] and -rest not in alive:
                insort(alive, -rest)
            counts[rest] += times
            born[rest] += times
        window += times
        alive = [x for x in alive if counts[-x]]
    table = np.array(sorted(rows), np.int64).reshape(-1, 8)
    return {"length": table[:, 0], "lo": table[:, 1], "hi": table[:, 2], "per": table[:, 3], "window": table[:, 4],
            "slot": table[:, 5], "gap": table[:, 6], "rest_from": table[:, 7], "offsets": np.array(offsets, np.int64),
            "windows": window}


def place(plan: dict, length: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(which, from, size, window, offset) of the parts of the n-th pieces of the lengths; a
    piece has more than one part only if it was cut."""
    which, done = np.arange(len(length)), np.zeros(len(length), np.int64)
    stride = int(max(plan["hi"].max(initial=0), n.max(initial=0))) + 1
    ranks = plan["length"] * stride + plan["lo"]
    while len(which):
        row = np.searchsorted(ranks, length * stride + n, side="right") - 1
        inside = n - plan["lo"][row]
        copy, slot = np.divmod(inside, plan["per"][row])
        gap = plan["gap"][row]
        yield which, done, gap, plan["window"][row] + copy, plan["offsets"][plan["slot"][row] + slot]
        more = np.flatnonzero(gap < length)
        which, done = which[more], (done + gap)[more]
        n = (plan["rest_from"][row] + inside)[more]
        length = (length - gap)[more]


def _encode(batches, path: str, end_id: int, capacity: int, max_pieces: int = MAX_PIECES) -> Iterator[pa.RecordBatch]:
    enc, part = encoder(path, max_pieces), TaskContext.get().partitionId()
    width = id_width(max(enc.tokenizer.get_vocab_size(), end_id + 1))
    seen, whole = np.zeros(capacity, np.int64), 0
    for cols, texts in slices(batches, max_chars=ENCODE_CHARS):
        ids, n = enc.ids_of(texts, end_id)
        full, rest = np.divmod(n, capacity)
        by = np.argsort(rest, kind="stable")
        values, first, sizes = np.unique(rest[by], return_index=True, return_counts=True)
        rank = np.empty(len(n), np.int64)
        rank[by] = np.arange(len(n)) - np.repeat(first, sizes) + np.repeat(seen[values], sizes)
        seen[values] += sizes
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), part)), pa.array(rest), pa.array(rank),
                                          pa.array(whole + np.cumsum(full) - full), pa.array(cols["doc_id"], pa.int64()), pa.array(n),
                                          binary_rows(ids.astype(width), n)], schema=_IDS)
        whole += int(full.sum())


def _by_ids(batches) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no part but a single document holds more than ``EMIT_IDS`` ids."""
    for batch in batches:
        n, at = batch.column("n_tokens").to_pylist(), 0
        while at < len(n):
            end, total = at, 0
            while end < len(n) and (end == at or total + n[end] <= EMIT_IDS):
                total, end = total + n[end], end + 1
            yield batch.slice(at, end - at)
            at = end


def _emit(batches, plan: dict, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    let_go("packing")  # the encoder has done its work
    for batch in _by_ids(batches):
        col = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "rest", "rank", "whole_before",
                                                                          "n_tokens", "rank_from", "whole_from")}
        doc_id, blobs = batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()
        full = col["n_tokens"] // capacity
        number = np.flatnonzero(full)
        which = np.repeat(number, full[number])
        k = np.arange(len(which)) - np.repeat(np.cumsum(full[number]) - full[number], full[number])
        window = plan["windows"] + (col["whole_from"] + col["whole_before"])[which] + k
        parts = [(which, k * capacity, np.full(len(which), capacity), window, np.zeros(len(which), np.int64))]
        has = np.flatnonzero(col["rest"])
        for w, done, gap, win, off in place(plan, col["rest"][has], (col["rank_from"] + col["rank"])[has]):
            parts.append((has[w], (full * capacity)[has[w]] + done, gap, win, off))
        which, start, size, window, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
        by = np.lexsort((start, which))
        which, start, size, window, offset = (x[by] for x in (which, start, size, window, offset))
        width = len(blobs[0]) // int(col["n_tokens"][0])
        ids, crc = [None] * len(which), []
        for i, (w, a, s) in enumerate(zip(which.tolist(), start.tolist(), size.tolist(), strict=True)):
            own = np.frombuffer(blobs[w], f"<u{width}", count=s, offset=a * width).astype("<u4").tobytes()
            crc.append(zlib.crc32(own))
            if with_ids:
                ids[i] = own
        yield to_batch([[doc_id[w] for w in which], start, size, crc, col["n_tokens"][which], window, offset, ids], _PIECES)


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY,
                   with_ids: bool = True, max_pieces: int = MAX_PIECES) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.
    A worker's encoder keeps ``max_pieces`` pieces; the rows are the same whatever it is."""
    tokens = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
                    .mapInArrow(partial(_encode, path=path, end_id=end_id, capacity=capacity, max_pieces=max_pieces), ddl(_IDS)), "pack-ids")
    counts = staged(tokens.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("n_tokens") / capacity)).alias("whole")), "pack-counts")
    histogram = np.zeros(capacity, np.int64)
    for row in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        histogram[row["rest"]] = row["n"]
    histogram[0] = 0
    plan = plan_windows(histogram, capacity)
    by_length = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    zero = F.lit(0).cast("long")
    ranks = counts.select("part", "rest", F.coalesce(F.sum("n").over(by_length), zero).alias("rank_from"))
    whole = counts.groupBy("part").agg(F.sum("whole").alias("whole")) \
        .select("part", F.coalesce(F.sum("whole").over(by_part), zero).alias("whole_from"))
    rows = tokens.join(staged(ranks.join(whole, "part"), "pack-ranks"), ["part", "rest"])
    return rows.mapInArrow(partial(_emit, plan=plan, capacity=capacity, with_ids=with_ids), ddl(_PIECES))


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the windows themselves, pieces in order (at most a window a group)."""
    return pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                                 lambda x: F.hex(x["ids"])), "").alias("hex")) \
        .select("sequence_id", "length", F.unhex("hex").alias("ids"))
