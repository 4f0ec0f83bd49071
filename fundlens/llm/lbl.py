"""Language-model scoring by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are the words of a text (ASCII letters lower-cased, split at ASCII white space)
and one end. Every token that occurs ``LEAST`` times and a ``SHARE`` of all training tokens (and the
``TOP`` most frequent in any case) is a unit with a context vector and an output vector of its own, so units
grow with the vocabulary and ``1 / SHARE`` bounds them whatever the corpus holds; each rarer token belongs to one of
``TAIL`` further units by its last byte. The model predicts the unit of a token from the units of the ``CONTEXT`` tokens
before it: the context vector is the sum of the earlier units' vectors, each weighted per position and dimension.
Units in order of frequency are cut into groups where the running sum of the square roots of their shares passes a whole
number, which makes groups and units of a group about equally many for the average token; a unit's probability is that of its
group times its own within the group, each by a vector times the context vector plus a bias. So all probabilities are
normalised exactly for two small matrix products a token. Within a tail unit a token
has its smoothed share of the unit's training counts, with one slot per tail unit for unseen
words, so the probabilities of all tokens and unseen slots add up to one.

Word counts are summed over the training documents, all those outside the held-out fold. Texts are then written once as
the unit numbers of their tokens, with the rarer tokens and their counts beside them; training and scoring read the
numbers. The training documents are dealt to the rounds, so every one is trained on. Each round every task runs stochastic
gradient steps of noise-contrastive estimation in numpy over its documents of the round, from the same start: groups against
noise groups, units against noise units of their group. Noise is shared by the tokens of a step (those of a group), so
its scores are dense products; a step takes a run of whole texts, so each token's vector is read and moved once, not once per
position. The parameters are averaged by a distributed sum, each vector weighted by the squared gradients it has met (one
that one task alone has moved keeps its move), and start the next round. Moves travel in half precision (a relative error of 2^-11).

The count of every token of every document enters its score. Those of units go to the tasks; all others
are joined by token over plain shuffles, one row per document and distinct rare token.

Null text counts as empty (only its end); repeated rows are scored each; a text of any length is whole; extra columns are
left aside, whatever their names; without training documents N and V are 0, the base score follows from its formula, and the
model keeps its uniform start; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from copy import copy
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm.common import SLICE_CHARS, crc_fold, filesystem, staged, text_or_empty, to_batch
from fundlens.session import scratch_dir

TOP = 448
LEAST = 8
SHARE = 1e-6
TAIL = 64
CONTEXT = 4
WIDTH = 24
NOISE = 64
NEAR_NOISE = 16
BLOCK = 64
BATCH = 8192
#: How a step is computed, not what: tokens of a group in one product, rows of a run that are added place by place, rows multiplied as one.
TILE = 16
SHORT = 4
FLAT = 512
READ = 1 << 20
ROUNDS = 4
RATE = 0.1
HELD_OUT = 1
END = b""

_COUNTS = pa.schema([("token", pa.binary()), ("c", pa.int64())])
_PARAMS = pa.schema([("i", pa.int64()), ("v", pa.binary()), ("w", pa.binary())])
_PARAMS_DDL = "i long, v binary, w binary"


def tokens(text: str) -> list[bytes]:
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


# ---- counts ----------------------------------------------------------------------------------------------------

def token_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the tokens of all texts one after the other, tokens of each text), as :func:`tokens` cuts them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten().cast(pa.binary())
    full = np.flatnonzero(pc.binary_length(words).to_numpy() > 0)
    ends = np.searchsorted(full, np.cumsum(pc.list_value_length(lists).to_numpy()))
    places = np.insert(full, ends, len(words))
    return pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(places)), np.diff(ends, prepend=0) + 1


def _slices(batches, max_chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that none but a single long text holds more than ``max_chars`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            many = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), max_chars, "right")))
            yield batch.slice(at, many)
            at += many


def _count(batches, flush: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0

    def summed() -> pa.RecordBatch:
        got = pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
        return to_batch([got["token"].combine_chunks(), got["c_sum"].combine_chunks()], _COUNTS)

    for part in _slices(batches):
        own = pc.value_counts(token_runs(part.column("text"))[0])
        parts.append(pa.table([own.field(0), own.field(1)], schema=_COUNTS))
        held += len(own)
        if held > flush:
            got = summed()
            if len(got) > flush // 2:  # little is shared: let the shuffle add
                yield got
                parts, held = [], 0
            else:
                parts, held = [pa.Table.from_batches([got])], len(got)
    if parts:
        yield summed()


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, c`` over all given texts, summed per task first."""
    return staged(texts.select("text").mapInArrow(_count, "token binary, c long")
                  .groupBy("token").agg(F.sum("c").alias("c")), "lm-counts")


def tail_class(token: bytes) -> int:
    return token[-1] % TAIL if token else 0


class Vocabulary:
    """The tokens that are units, with their counts, and the training mass of each tail unit."""

    def __init__(self, frequent: list[tuple[bytes, int]], mass: dict[int, float], total: int, distinct: int):
        top = sorted(frequent, key=lambda x: (-x[1], x[0]))
        self.own = max(TOP, len(top))  # of a small corpus the last of them may be empty
        self.index = [t for t, _ in top]
        self.counts = np.array([c for _, c in top] + [0] * (self.own - len(top)), np.float64)
        self.mass = np.array([mass.get(k, 0.0) for k in range(TAIL)]) + 0.5
        for t, c in top:
            self.mass[tail_class(t)] -= c + 0.5
        self.total, self.distinct = total, distinct
        share = np.concatenate([self.counts, np.maximum(self.mass, 0.5)]) + 0.5
        self.noise = share / share.sum()
        self.starts = np.flatnonzero(np.diff(np.floor(np.cumsum(np.sqrt(self.noise))), prepend=-1))  # of the groups
        self.norm = np.log10(total + 0.5 * (distinct + 1))

    def shares(self) -> Vocabulary:
        """What training and scoring need: all but the tokens."""
        out = copy(self)
        out.index = []
        return out

    def numbers(self, found: pa.Array) -> np.ndarray:
        """The unit of each token (an Arrow array of bytes)."""
        unit = pc.fill_null(pc.index_in(found, value_set=pa.array(self.index, pa.binary())), -1).to_numpy().astype(np.int32)
        rare = np.flatnonzero(unit < 0)
        ends = pc.binary_slice(found.take(pa.array(rare)), -1).fill_null(END)
        if len(rare):
            cuts = np.frombuffer(ends.buffers()[1], np.int32)[ends.offset:ends.offset + len(ends) + 1]
            last = np.zeros(len(rare), np.int32)
            last[np.diff(cuts) > 0] = np.frombuffer(ends.buffers()[2] or b"", np.uint8)[cuts[0]:cuts[-1]]
            unit[rare] = self.own + last % TAIL
        return unit


def vocabulary(counts: DataFrame) -> Vocabulary:
    last = F.when(F.length("token") > 0, F.conv(F.hex(F.expr("substring(token, -1, 1)")), 16, 10).cast("int") % TAIL).otherwise(0)
    mass = counts.groupBy(last.alias("k")).agg(F.sum(F.col("c") + 0.5).alias("m"), F.sum("c").alias("n"),
                                              F.count(F.lit(1)).alias("v")).collect()  # a row per tail class
    total = sum(r["n"] for r in mass)
    units = counts.filter(F.col("c") >= max(LEAST, SHARE * total)).collect()  # at most 1 / SHARE rows, as counts add up to the total
    if len(units) < TOP:
        units = counts.orderBy(F.desc("c"), "token").limit(TOP).collect()
    return Vocabulary([(bytes(r["token"]), r["c"]) for r in units], {r["k"]: float(r["m"]) for r in mass}, total, sum(r["v"] for r in mass))


# ---- texts as unit numbers ---------------------------------------------------------------------------------------

_ENCODED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_own", pa.int64()), ("base", pa.float64()),
                      ("units", pa.binary()), ("rare", pa.list_(pa.struct([("token", pa.binary()), ("tf", pa.int64())])))])
_ENCODED_DDL = "row long, doc_id long, n_tokens long, n_own long, base double, units binary, rare array<struct<token: binary, tf: long>>"


def shared_file(spark: SparkSession, name: str, value) -> str:
    """``value`` as a file in the shared folder: tasks read it there, so no executor keeps copies of it on its disk."""
    uri = scratch_dir(spark, name)
    files, base = filesystem(uri)
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/value.pickle") as out:
        pickle.dump(value, out, protocol=5)
    return uri


def from_shared(uri: str):
    files, base = filesystem(uri)
    with files.open_input_stream(f"{base}/value.pickle") as source:
        return pickle.loads(source.readall())


def _encode(batches, vocabulary_file: str) -> Iterator[pa.RecordBatch]:
    words = from_shared(vocabulary_file)
    log_counts = np.concatenate([np.log10(words.counts + 0.5), np.zeros(TAIL)])
    for part in _slices(batches):
        found, lengths = token_runs(part.column("text"))
        unit, ends = words.numbers(found), np.cumsum(lengths)
        first = ends - lengths
        # rarer tokens, counted per text
        rare = np.flatnonzero(unit >= words.own)
        coded = found.take(pa.array(rare)).dictionary_encode()
        many = max(1, len(coded.dictionary))
        entry, tf = np.unique(np.searchsorted(ends, rare, "right") * many + coded.indices.to_numpy(), return_counts=True)
        offsets = np.searchsorted(entry // many, np.arange(len(lengths) + 1)).astype(np.int32)
        entries = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(entry % many)), pa.array(tf)], ["token", "tf"])
        data = pa.py_buffer(np.ascontiguousarray(unit))
        cuts = pa.py_buffer((np.append(0, ends) * unit.itemsize).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            part.column("row"), part.column("doc_id"), pa.array(lengths),
            pa.array(lengths - np.add.reduceat((unit >= words.own).astype(np.int64), first)), pa.array(np.add.reduceat(log_counts[unit], first)),
            pa.Array.from_buffers(pa.binary(), len(lengths), [None, cuts, data]),
            pa.ListArray.from_arrays(pa.array(offsets), entries)], schema=_ENCODED)


def encoded(texts: DataFrame, words: Vocabulary) -> DataFrame:
    """Every text as the 32-bit numbers of its tokens' units, with its rarer tokens and the base score of the others."""
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return staged(rows.mapInArrow(partial(_encode, vocabulary_file=shared_file(texts.sparkSession, "lm-words", words)), _ENCODED_DDL), "lm-units")


def _runs(batches, columns: tuple[str, ...], size: int = READ) -> Iterator[tuple[list[list], list[np.ndarray]]]:
    """Rows with the units of their tokens, as many as hold about ``size`` tokens."""
    rows, runs, held = [], [], 0
    for batch in batches:
        others = zip(*(batch.column(c).to_pylist() for c in columns), strict=True) if columns else repeat(())
        for other, units in zip(others, batch.column("units"), strict=False):
            runs.append(np.frombuffer(units.as_buffer(), np.int32))
            rows.append(other)
            held += len(runs[-1])
            if held >= size:
                yield rows, runs
                rows, runs, held = [], [], 0
    if runs:
        yield rows, runs


def padded(runs: list[np.ndarray], units: int) -> np.ndarray:
    """The runs one after the other, each behind ``CONTEXT`` times the start of a text (number ``units``)."""
    start = np.full(CONTEXT, units, np.int32)
    return np.concatenate([x for r in runs for x in (start, r)])


# ---- model -----------------------------------------------------------------------------------------------------

def _log_total(x: np.ndarray, vectors: np.ndarray, cells: int = 1 << 16) -> np.ndarray:
    """Log of the sum of exp(x . vector) over the vectors, for every row of ``x``."""
    out, rows, ones = np.empty(len(x), np.float32), max(64, cells // len(vectors)), np.ones(len(vectors), np.float32)
    scores = np.empty((min(rows, len(x)), len(vectors)), np.float32)
    turned = np.ascontiguousarray(vectors.T)
    # lengths bound the scores: below 60 nothing overflows and no shift is needed
    small = np.einsum("ij,ij->i", x, x).max() * np.einsum("ij,ij->i", vectors, vectors).max() < 3600
    for at in range(0, len(x), rows):
        part = x[at:at + rows]
        own, top = np.matmul(part, turned, out=scores[:len(part)]), 0.0
        if not small:
            top = own.max(axis=1)
            own -= top[:, None]
        np.exp(own, out=own)
        out[at:at + rows] = np.log(own @ ones) + top
    return out


def _sorted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers, from 0 to 2^31 - 1, in order, the places they stood at; equal ones keep their order)."""
    both = np.sort((numbers.astype(np.int64) << 32) | np.arange(len(numbers)))
    return both >> 32, both & 0xFFFFFFFF


def _weighted(rows: np.ndarray, weights: np.ndarray, shifts: range, out: np.ndarray) -> None:
    """``out[t]`` becomes the sum of ``rows[t + shift] * weight`` over the shifts, one row of weights each."""
    size = FLAT * rows.shape[1]
    flat, to, held = rows.reshape(-1), out.reshape(-1), np.empty(size, rows.dtype)
    weights = np.tile(weights, (1, FLAT))  # many short rows are multiplied as one long one
    for at in range(0, len(to), size):
        own = to[at:at + size]
        for i, shift in enumerate(shifts):
            part = np.multiply(flat[at + shift * rows.shape[1]:][:len(own)], weights[i, :len(own)], out=held[:len(own)] if i else own)
            if i:
                own += part


class Model:
    """One row of ``WIDTH + 1`` components per vector: those of context units (the last is the start of a text), position weights,
    predicted units and groups. The last component of the latter two is their bias, of the others zero."""

    def __init__(self, rows: np.ndarray, starts: np.ndarray):
        k = (len(rows) - 1 - CONTEXT - len(starts)) // 2
        self.rows, self.units, self.starts = rows, k, starts
        self.of = np.repeat(np.arange(len(starts)), np.diff(starts, append=k))
        self.seen, self.place, self.next, self.group = np.split(rows, np.cumsum([k + 1, CONTEXT, k]))

    @staticmethod
    def start(words: Vocabulary) -> np.ndarray:
        noise, mass = words.noise, np.add.reduceat(words.noise, words.starts)
        size = 2 * len(noise) + 1 + CONTEXT + len(mass)
        rows = np.random.default_rng(1).normal(0, 0.1, (size, WIDTH + 1)).astype(np.float32)
        model = Model(rows, words.starts)
        model.place[:] = 1 / CONTEXT
        model.seen[:, -1] = model.place[:, -1] = 0
        model.next[:, -1] = np.log(noise / mass[model.of])
        model.group[:, -1] = np.log(mass)
        return rows

    def context(self, vectors: np.ndarray) -> np.ndarray:
        """The context vector, and 1 for the bias, of every place of a run of units, from their vectors (right from place ``CONTEXT`` on)."""
        h = np.zeros_like(vectors)
        _weighted(vectors, self.place, range(CONTEXT - 1, -1, -1), h[CONTEXT:])
        h[:, -1] = 1
        return h

    def log_probabilities(self, h: np.ndarray, kind: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """Natural log of P(unit | context vector): of its group among all groups plus its own among the group's units.
        ``places`` are those of the units' context vectors in ``h``, if it holds others too."""
        kind, by = _sorted(kind)
        of = self.of[kind]
        x = h.take(by if places is None else places[by], axis=0)
        got = np.einsum("ij,ij->i", x, self.group.take(of, axis=0) + self.next.take(kind, axis=0)) - _log_total(x, self.group)
        cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
        ends = np.append(self.starts, self.units)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            got[a:b] -= _log_total(x[a:b], self.next[ends[of[a]]:ends[of[a] + 1]])
        out = np.empty(len(kind))
        out[by] = got
        return out


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of the runs of rows that start at ``first``: place by place, as most are short, and what is left of long ones at once."""
    sizes = np.diff(first, append=len(values))
    out, more = values.take(first, axis=0), np.flatnonzero(sizes > 1)
    for k in range(1, SHORT):
        out[more] += values.take(first[more] + k, axis=0)
        more = more[sizes[more] > k + 1]
    if len(more):
        left = sizes[more] - SHORT
        cuts = np.cumsum(left) - left
        rows = np.arange(left.sum()) + np.repeat(first[more] + SHORT - cuts, left)
        out[more] += np.add.reduceat(values.take(rows, axis=0), cuts, axis=0)
    return out


def _sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, the sums of their values)."""
    own, by = _sorted(rows)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    return own[first], _sums(values.take(by, axis=0), first)


def _chance(x: np.ndarray, times: int = 1) -> np.ndarray:
    """``times / (1 + exp(x))`` in place."""
    with np.errstate(over="ignore"):  # of 1 / inf the right 0 comes
        np.exp(x, out=x)
    x += 1
    return np.divide(times, x, out=x)


class Trainer:
    """Noise-contrastive steps with per-parameter step sizes (AdaGrad)."""

    def __init__(self, start: np.ndarray, words: Vocabulary, rate: float, seed: int):
        self.model, self.squares = Model(start.copy(), words.starts), Model(np.ones_like(start), words.starts)
        self.groups = np.add.reduceat(words.noise, words.starts)
        self.log_groups = (np.log(self.groups) + np.log(NOISE)).astype(np.float32)
        self.log_noise = (np.log(words.noise / self.groups[self.model.of]) + np.log(NEAR_NOISE)).astype(np.float32)
        self.ends = np.cumsum(words.noise)
        self.rate, self.rng = rate, np.random.default_rng(seed)

    def _move(self, name: str, rows, grad) -> None:
        squares, values = getattr(self.squares, name), getattr(self.model, name)
        total = squares.take(rows, axis=0)
        total += grad * grad
        squares[rows] = total
        grad /= np.sqrt(total, out=total)
        grad *= self.rate
        grad += values.take(rows, axis=0)
        values[rows] = grad

    def _noise_units(self, of: np.ndarray) -> np.ndarray:
        """``NEAR_NOISE`` units of each group by their training shares."""
        first, last = self.model.starts[of], np.append(self.model.starts, self.model.units)[of + 1] - 1
        low = np.where(first > 0, self.ends[first - 1], 0.0)
        found = np.searchsorted(self.ends, low[:, None] + self.rng.random((len(of), NEAR_NOISE)) * (self.ends[last] - low)[:, None])
        return np.clip(found, first[:, None], last[:, None])

    def step(self, run: np.ndarray) -> None:
        """One step on the units of a padded run behind its first ``CONTEXT`` places."""
        m = self.model
        own, by = _sorted(run)
        vectors = m.seen.take(run, axis=0)
        target = by[(own < m.units) & (by >= CONTEXT)]
        if not len(target):
            return
        kind, x = run.take(target), m.context(vectors).take(target, axis=0)  # sorted by unit, so by group too
        of = m.of.take(kind)
        first, unit_first = (np.flatnonzero(np.diff(v, prepend=-1)) for v in (of, kind))
        here, sizes = of[first], np.diff(first, append=len(of))
        # groups against noise groups; the bias of a noise vector takes the log of its share, as its gradient counts for nothing in ``back``
        fake = self.rng.choice(len(self.groups), NOISE, p=self.groups)
        right, wrong = m.group.take(of, axis=0), m.group[fake]
        wrong[:, -1] -= self.log_groups[fake]
        group_true = _chance(np.einsum("ij,ij->i", x, right) - self.log_groups[of])[:, None]
        false = _chance(x @ -wrong.T, -1)
        back = np.multiply(group_true, right, out=right)
        back += false @ wrong
        group_false = false.T @ x
        # units against noise units of their group, shared by its tokens: these lie in tiles of one group each, the last filled up with zeros
        right = m.next.take(kind, axis=0)
        true = _chance(np.einsum("ij,ij->i", x, right) - self.log_noise[kind])[:, None]
        right *= true
        back += right
        tiles = -(-sizes // TILE)
        tile_first = np.cumsum(tiles) - tiles
        slot = np.arange(len(of)) + np.repeat(tile_first * TILE - first, sizes)
        tiled = np.zeros((tiles.sum(), TILE, WIDTH + 1), np.float32)
        tiled.reshape(-1, WIDTH + 1)[slot] = x
        noise = self._noise_units(here)
        wrong = m.next.take(noise, axis=0)
        wrong[:, :, -1] -= self.log_noise[noise]
        wrong = wrong.repeat(tiles, axis=0)
        false = np.zeros((len(tiled), TILE, NEAR_NOISE + 1), np.float32)  # the last column: what a token's group is moved by
        false.reshape(-1, NEAR_NOISE + 1)[slot, -1] = group_true[:, 0]
        false[:, :, :-1] = _chance(tiled @ -wrong.transpose(0, 2, 1), -1)
        back += (false[:, :, :-1] @ wrong).reshape(-1, WIDTH + 1).take(slot, axis=0)
        grad = _sums((false.transpose(0, 2, 1) @ tiled).reshape(len(tiled), -1), tile_first).reshape(len(here), NEAR_NOISE + 1, WIDTH + 1)
        group_at, group = _sum_rows(np.concatenate([here, fake]), np.concatenate([grad[:, -1], group_false]))
        x *= true
        unit_at, unit = _sum_rows(np.concatenate([kind[unit_first], noise.ravel()]),
                                  np.concatenate([_sums(x, unit_first), grad[:, :-1].reshape(-1, WIDTH + 1)]))
        # back through the context vectors: a token's vector meets the CONTEXT places behind it
        pull = np.zeros((len(run) + CONTEXT, WIDTH + 1), np.float32)
        back[:, -1] = 0
        pull[target] = back
        place, seen = np.empty_like(m.place), np.empty_like(vectors)
        for i in range(CONTEXT):
            place[i] = np.einsum("ij,ij->j", pull[i + 1:len(run)], vectors[:len(run) - i - 1])
        _weighted(pull, m.place, range(1, CONTEXT + 1), seen)
        seen_first = np.flatnonzero(np.diff(own, prepend=-1))
        self._move("group", group_at, group)
        self._move("next", unit_at, unit)
        self._move("seen", own[seen_first], _sums(seen.take(by, axis=0), seen_first))
        self._move("place", np.arange(CONTEXT), place / CONTEXT)


def _train(batches, model_file: str, rate: float, seed: int) -> Iterator[pa.RecordBatch]:
    words, start = from_shared(model_file)
    trainer, total = Trainer(start, words, rate, seed * 1_000_003 + TaskContext.get().partitionId()), 0
    for _, runs in _runs(batches, ()):
        run = padded([runs[i] for i in trainer.rng.permutation(len(runs))], trainer.model.units)
        for at in range(0, len(run) - CONTEXT, BATCH):
            trainer.step(run[at:at + BATCH + CONTEXT])
        total += len(run)
    if total:
        # a move and the root of its weight per vector, in half precision: a task's rows are its shuffle
        w = np.sqrt((trainer.squares.rows - 1).mean(axis=1) + 1e-6)
        v = trainer.model.rows - start
        at = range(0, len(v), BLOCK)
        yield to_batch([range(len(at)), *([x[i:i + BLOCK].astype(np.float16).tobytes() for i in at] for x in (v, w))], _PARAMS)


def _added(batches) -> Iterator[pa.RecordBatch]:
    """Sums a task's rows of each block; the rows come sorted by block."""
    last, sums = None, None
    for batch in batches:
        for i, *parts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            move, root = (np.frombuffer(x, np.float16).astype(np.float64) for x in parts)
            own = [move.reshape(len(root), -1) * (root * root)[:, None], root * root]
            if i != last and last is not None:
                yield _block(last, sums)
            sums = own if i != last else [a + b for a, b in zip(sums, own, strict=True)]
            last = i
    if last is not None:
        yield _block(last, sums)


def _block(i: int, sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i]), *[pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in sums]], schema=_PARAMS)


def train(rows: DataFrame, words: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """The averaged vectors after all rounds over encoded rows (``row``, ``units``), each row in one round."""
    model = Model.start(words)
    for k in range(rounds):
        got = rows.filter(F.pmod(F.xxhash64("row"), F.lit(rounds)) == k).select("units") \
            .mapInArrow(partial(_train, model_file=shared_file(rows.sparkSession, "lm-model", (words.shares(), model)), rate=rate, seed=k), _PARAMS_DDL) \
            .repartition("i").sortWithinPartitions("i").mapInArrow(_added, _PARAMS_DDL).collect()  # a row per block of vectors
        for r in got:
            weights = np.frombuffer(r["w"], np.float32)[:, None]
            model[r["i"] * BLOCK:][:len(weights)] += np.frombuffer(r["v"], np.float32).reshape(len(weights), -1) / weights
    return model


# ---- scores ----------------------------------------------------------------------------------------------------

_SCORED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_own", pa.int64()), ("base", pa.float64()),
                     ("model", pa.float64())])
_SCORED_DDL = "row long, doc_id long, n_tokens long, n_own long, base double, model double"


def _score(batches, model_file: str) -> Iterator[pa.RecordBatch]:
    words, trained = from_shared(model_file)
    model = Model(trained, words.starts)
    log_mass = np.concatenate([np.zeros(words.own), np.log10(words.mass)])
    for rows, runs in _runs(batches, ("row", "doc_id", "n_tokens", "n_own", "base"), READ // 4):
        run = padded(runs, model.units)
        real = np.flatnonzero(run < model.units)
        kind = run[real]
        chance = model.log_probabilities(model.context(model.seen.take(run, axis=0)), kind, real) / np.log(10) - log_mass[kind]
        lengths = np.array([len(r) for r in runs])
        yield to_batch([*zip(*rows, strict=True), np.add.reduceat(chance, np.cumsum(lengths) - lengths)], _SCORED)


def score_texts(docs: DataFrame, rounds: int = ROUNDS, held_out: int = HELD_OUT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10) per document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts = token_counts(texts.filter(crc_fold() != held_out))
    words = vocabulary(counts)
    rows = encoded(texts, words)
    trained = train(rows.filter(crc_fold() != held_out), words, rounds)
    model_file = shared_file(docs.sparkSession, "lm-model", (words.shares(), trained))
    scored = rows.select("row", "doc_id", "n_tokens", "n_own", "base", "units").mapInArrow(partial(_score, model_file=model_file), _SCORED_DDL)
    # a rare token's rows are at most those of its documents; both inputs are scans, so a hot one can be split. The counts, one row
    # per distinct token of a shuffle partition, are the hashed side: neither they nor the many rare tokens are sorted
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.tf") \
        .join(counts.hint("shuffle_hash"), "token", "left") \
        .groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_sum"),
                            F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known"))
    extra = F.coalesce("rare_sum", F.lit(0.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", (crc_fold() == held_out).alias("held_out"), "n_tokens",
        (F.col("n_own") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(float(words.norm))).alias("base_score"),
        (F.col("model") + extra).alias("score"))
