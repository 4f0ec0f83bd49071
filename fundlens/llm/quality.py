"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a whole text is cut into at most ``BINS`` bins at quantiles of the
training rows. Boosting goes round the features; each turn fits a shallow tree (at most
four leaves) on one feature's binned gradients and adds it to the feature's look-up table.
Then the pairs whose coarse two-way histograms still explain most are boosted the same
way, with trees that cut both features once (four quadrants). The number of rounds is
chosen on a fifth of the training rows. A score is the sum of table entries, taken for a
whole batch at once, through the logistic function.

Only text features enter: labels, language, source and ids never do. Null text counts as
empty and is scored like any text; repeated rows are scored alike; without training rows
every score is 0.5, with one class only it is that class's smoothed share. Labels come
from a bounded sample (``labelled.MAX_ROWS``); every document is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import batch_slices, let_go, py_fold, slices, text_or_empty, to_batch
from fundlens.llm.labelled import MAX_ROWS, training_rows

BINS = 32
COARSE = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.15
THRESHOLD = 0.3

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "symbols", "spaces", "distinct_words", "top_word",
            "repeated_lines", "line_length", "decorated", "bare_symbols", "stops", "commas", "distinct_pairs", "longest_word")
_TAIL = re.compile(r"[^\w\s]{2,}(?=\s|\Z)|\W[^\w\s](?=\s)")
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def _char_classes(size: int = 0x300) -> np.ndarray:
    """0 space, 1 upper-case letter, 2 other letter, 3 digit, 4 symbol; by code point, the last for all beyond."""
    kind = [0 if c.isspace() else 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4 for c in map(chr, range(size))]
    kind[-1] = 2
    return np.array(kind, np.int64)


_CLASSES = _char_classes()


def features(text: str) -> list[float]:
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = np.bincount(_CLASSES[np.minimum(chars, len(_CLASSES) - 1)], minlength=5)
    total, letters = max(1, len(text)), max(1, int(n[1] + n[2]))
    words = text.lower().split()
    k = max(1, len(words))
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = text.split("\n")
    own = Counter(lines)
    return [np.log1p(len(text)), np.log1p(len(words)), (total - int(n[0])) / k, n[1] / letters, n[3] / total, n[4] / total,
            n[0] / total, len(seen) / k, max(seen.values(), default=0) / k,
            sum(len(x) * (c - 1) for x, c in own.items() if c > 1) / total, np.log1p(len(text) / len(lines)),
            len(_TAIL.findall(text)) / k, text.count("|") / k, (text.count(".") + text.count("?") + text.count("!")) / k,
            text.count(",") / k, pairs / max(1, len(words) - 1), np.log1p(max(map(len, seen), default=0))]


@dataclass
class Additive:
    """Bin edges per feature, a table per feature and per pair, and the intercept."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores from the summed tables, for all rows at once."""
        total, bins = np.full(len(x), self.intercept), self.bins(x)
        for table, own in zip(self.tables, bins, strict=True):
            total += table[own]
        for a, b, table in self.pairs:
            total += table[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int, ridge: float) -> tuple[float, int]:
    """(gain, cut) of the best split of the bins lo..hi-1; gain 0 if none helps."""
    if hi - lo < 2:
        return 0.0, lo
    cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
    left, right = cg[:-1] ** 2 / (ch[:-1] + ridge), (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + ridge)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + ridge)
    at = int(gain.argmax())
    return max(0.0, float(gain[at])), lo + at + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Values per bin of a tree of depth two on one feature's binned gradients."""
    out, spans = np.zeros(len(g)), [(0, len(g))]
    for _ in range(2):
        spans = [part for lo, hi in spans for gain, cut in [_best_cut(g, h, lo, hi, ridge)]
                 for part in ([(lo, cut), (cut, hi)] if gain > 0 else [(lo, hi)])]
    for lo, hi in spans:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """(gain, values) of the best cut of both features of a two-way histogram."""
    best, out = 0.0, np.zeros_like(g)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    base = cg[-1, -1] ** 2 / (ch[-1, -1] + ridge)

    def quarters(c):
        a, top, left = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return a, top - a, left - a, c[-1, -1] - top - left + a

    qg, qh = quarters(cg), quarters(ch)
    gain = sum(x ** 2 / (y + ridge) for x, y in zip(qg, qh, strict=True)) - base
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[i, j] > 0:
        best = float(gain[i, j])
        v = [float(x[i, j] / (y[i, j] + ridge)) for x, y in zip(qg, qh, strict=True)]
        out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return best, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = BINS, coarse: int = COARSE, rounds: int = ROUNDS,
        pair_rounds: int = PAIR_ROUNDS, n_pairs: int = PAIRS, rate: float = RATE, ridge: float = 2.0) -> Additive:
    """The model of the training rows ``x`` (rows, features) with labels ``y`` 0 or 1."""
    n, width = x.shape
    if not n:
        return Additive(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width, [np.zeros(1, np.int64)] * width, [])
    share = (y.sum() + 0.5) / (n + 1)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    model = Additive(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges],
                     [np.arange(len(e) + 1) * coarse // (len(e) + 1) for e in edges], [])
    if y.min() == y.max():
        return model
    own, check = model.bins(x), np.arange(n) % 5 == 4
    learn, total = ~check, np.full(n, model.intercept)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return (y - p) * learn, p * (1 - p) * learn

    def loss():
        use = check if check.any() else learn
        return float(np.logaddexp(0, np.where(y[use] > 0, -total[use], total[use])).mean())

    best = (loss(), [t.copy() for t in model.tables])
    worse = 0
    for _ in range(rounds):
        for f in range(width):
            g, h = gradients()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(own[f], g, size), np.bincount(own[f], h, size), ridge)
            model.tables[f] += step
            total += step[own[f]]
        now = loss()
        best, worse = ((now, [t.copy() for t in model.tables]), 0) if now < best[0] else (best, worse + 1)
        if worse >= 10:
            break
    model.tables = best[1]
    total = model.intercept + sum(t[b] for t, b in zip(model.tables, own, strict=True))
    small = [model.coarse[f][own[f]] for f in range(width)]

    def two_way(a, b, g, h):
        cell = small[a] * coarse + small[b]
        return (np.bincount(cell, v, coarse * coarse).reshape(coarse, coarse) for v in (g, h))

    g, h = gradients()
    ranked = sorted(((_quadrants(*two_way(a, b, g, h), ridge)[0], a, b) for a, b in combinations(range(width), 2)), reverse=True)
    pairs = [[a, b, np.zeros((coarse, coarse))] for _, a, b in ranked[:n_pairs]]
    best, worse = (loss(), [p[2].copy() for p in pairs]), 0
    for _ in range(pair_rounds):
        for pair in pairs:
            g, h = gradients()
            step = rate * _quadrants(*two_way(pair[0], pair[1], g, h), ridge)[1]
            pair[2] += step
            total += step[small[pair[0]], small[pair[1]]]
        now = loss()
        best, worse = ((now, [p[2].copy() for p in pairs]), 0) if now < best[0] else (best, worse + 1)
        if worse >= 10:
            break
    model.pairs = [(a, b, t) for (a, b, _), t in zip(pairs, best[1], strict=True)]
    return model


def _feature_rows(batches) -> Iterator[pa.RecordBatch]:
    let_go("quality")
    for cols, texts in slices(batches):
        yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["y"], pa.int32()),
                                          pa.array([features(t) for t in texts], pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, hold_out: int | None = 0) -> Additive:
    rows = training_rows(docs, labels, "quality", max_rows, hold_out) \
        .mapInArrow(_feature_rows, "doc_id long, y int, x array<double>").toPandas()
    rows = rows.sort_values(["doc_id", "y"], kind="stable")
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    by = np.lexsort((*x.T, rows["doc_id"].to_numpy()))
    by = by[np.argsort([py_fold(d, 1 << 30) for d in rows["doc_id"].to_numpy()[by]], kind="stable")]
    return fit(x[by], rows["y"].to_numpy(np.float64)[by])


def _score(batches, model: Additive, threshold: float) -> Iterator[pa.RecordBatch]:
    let_go("quality")
    for cols, texts in slices(batches):
        score = model.score(np.array([features(t) for t in texts]))
        yield to_batch([cols["doc_id"], [py_fold(d) == 0 for d in cols["doc_id"]], score, (score >= threshold).astype(np.int32)], _SCORES)


def score_quality(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .mapInArrow(partial(_score, model=model, threshold=threshold), "doc_id long, held_out boolean, score double, predicted int")


def _keep(batches, model: Additive, threshold: float) -> Iterator[pa.RecordBatch]:
    let_go("quality")
    for part, texts in batch_slices(batches):
        yield part.filter(pa.array(model.score(np.array([features(t) for t in texts])) >= threshold))


def keep_good(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, without the documents that the model rejects."""
    return docs.mapInArrow(partial(_keep, model=model, threshold=threshold), docs.schema)
