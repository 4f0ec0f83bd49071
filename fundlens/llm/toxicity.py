"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. Each has a logistic model on the presence
of selected words and word beginnings (four to eight letters, as stems carry inflected
forms that the training rows lack) and on the probabilities of all earlier categories. In training these
probabilities are out of fold: they come from models of the earlier category that did
not see the row, so a later model meets them as it will meet them on new texts.

The marks are all words and beginnings whose presence tells toxic and other training rows apart (G
test on document counts of ``MIN_G`` or more, at least ``MIN_DOCS`` documents). Marks found in the very same training rows (mostly a word
and its beginnings) are one feature, which a text has if it has any of them. From the label three categories
are derived for the query's chain: ``abusive`` (toxic, with a word that speaks for it),
``repeated`` (toxic, with several different ones) and ``toxic``, the label itself.

Labels come from a bounded sample (``labelled.MAX_ROWS``); every whole text is scored. Null
text counts as empty, repeated rows are scored alike, and without training rows or with
one class only the models are constants. An empty table gives no rows, very long texts are read whole, extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm.common import py_fold, slices, staged, text_or_empty
from fundlens.llm.labelled import MAX_ROWS, training_rows

STEMS = (4, 5, 6, 7, 8)
MIN_DOCS = 3
MIN_G = 15.0
THRESHOLD = 0.5
FOLDS = 5
_WORD = re.compile(r"[^\W_]+")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Presence:
    """Which of ``width`` features each row has: the places (row, feature) that are one, and dense columns beside them."""

    row: np.ndarray
    feature: np.ndarray
    rows: int
    width: int
    beside: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray | Presence) -> Presence:
        if isinstance(x, cls):
            return x
        row, feature = np.nonzero(x)
        return cls(row, feature, len(x), x.shape[1], np.zeros((len(x), 0)))

    def plus(self, columns: np.ndarray) -> Presence:
        return Presence(self.row, self.feature, self.rows, self.width, np.hstack([self.beside, columns]))

    def take(self, keep: np.ndarray) -> Presence:
        """The rows where ``keep`` is true."""
        inside, number = keep[self.row], np.cumsum(keep) - 1
        return Presence(number[self.row[inside]], self.feature[inside], int(keep.sum()), self.width, self.beside[keep])

    def times(self, w: np.ndarray) -> np.ndarray:
        """Rows times weights: features, dense columns, intercept."""
        return np.bincount(self.row, w[self.feature], self.rows) + self.beside @ w[self.width:-1] + w[-1]

    def sums(self, v: np.ndarray) -> np.ndarray:
        """Per weight the sum of ``v`` over the rows, each times its value."""
        return np.r_[np.bincount(self.feature, v[self.row], self.width), self.beside.T @ v, v.sum()]

    def squares(self, v: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(self.feature, v[self.row], self.width), (self.beside ** 2).T @ v, v.sum()]

    def count(self, wanted: np.ndarray) -> np.ndarray:
        """How many of the wanted features each row has."""
        return np.bincount(self.row, wanted[self.feature], self.rows)


def logistic(x: np.ndarray | Presence, y: np.ndarray, ridge: float = 0.3, steps: int = 50, start: np.ndarray | None = None) -> np.ndarray:
    """Weights, the intercept last, of a ridge logistic regression: Newton steps, each solved by conjugate
    gradients scaled by the diagonal, so that the cost follows the features that rows have. The loss
    is convex: ``start`` (weights of nearly the same rows) saves steps and changes nothing else."""
    x = Presence.of(x)
    n = x.width + x.beside.shape[1] + 1
    w, penalty = (np.zeros(n) if start is None else start.copy()), np.full(n, ridge)
    penalty[-1] = 1e-3

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * penalty @ (w * w))

    z = x.times(w)
    for _ in range(steps):
        p = _sigmoid(z)
        slope = x.sums(y - p) - penalty * w
        size = np.abs(slope).max(initial=0)
        if size < 1e-6:
            break
        v = p * (1 - p)
        scale = x.squares(v) + penalty
        step, rest = np.zeros(n), slope.copy()
        move = rest / scale
        fall = rest @ move
        until = fall * min(0.01, size) ** 2
        for _ in range(200):
            image = x.sums(v * x.times(move)) + penalty * move
            a = fall / (move @ image)
            step += a * move
            rest -= a * image
            near = rest / scale
            before, fall = fall, rest @ near
            if fall <= until:
                break
            move = near + (fall / before) * move
        now, gain, part = loss(w, z), slope @ step, 1.0
        change = x.times(step)
        while loss(w + part * step, z + part * change) > now - 1e-4 * part * gain and part > 1e-6:
            part /= 2
        w, z = w + part * step, z + part * change
    return w


@dataclass
class Chain:
    """The features (marks set apart by spaces), and per category its name and weights (features, earlier categories, intercept)."""

    words: list[str]
    names: list[str]
    weights: list[np.ndarray]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, categories): each category's probability feeds the next ones."""
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.hstack([out, _sigmoid(np.hstack([x, out]) @ w[:-1] + w[-1])[:, None]])
        return out


def out_of_fold(x: Presence, y: np.ndarray, held: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probabilities of the held rows by a model of the others."""
    return _sigmoid(x.take(held).times(logistic(x.take(~held), y[~held], start=start)))


def _fold_rows(batches, x: Presence, y: np.ndarray, folds: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for fold in batch.column("fold").to_pylist():
            p = out_of_fold(x, y, folds == fold, start)
            yield pa.RecordBatch.from_arrays([pa.array([fold], pa.int64()), pa.array([p], pa.list_(pa.float64()))], names=["fold", "p"])


def fit_chain(x: np.ndarray | Presence, y: np.ndarray, folds: np.ndarray, words: Sequence[str], names: Sequence[str],
              spark: SparkSession | None = None) -> Chain:
    """``x`` word presence, ``y`` (rows, categories) in chain order, ``folds`` the fold of each row. With ``spark``
    the folds of a category are tasks (their rows are the bounded sample)."""
    x, weights, numbers = Presence.of(x), [], np.unique(folds).tolist()
    for c in range(y.shape[1]):
        weights.append(logistic(x, y[:, c]))
        out = np.zeros(x.rows)
        if spark is not None and numbers:
            tasks = spark.createDataFrame([(f,) for f in numbers], "fold long").repartition(len(numbers), "fold")
            found = tasks.mapInArrow(partial(_fold_rows, x=x, y=y[:, c], folds=folds, start=weights[-1]), "fold long, p array<double>")
            for r in found.collect():
                out[folds == r["fold"]] = r["p"]
        else:
            for fold in numbers:
                out[folds == fold] = out_of_fold(x, y[:, c], folds == fold, weights[-1])
        x = x.plus(out[:, None])
    return Chain(list(words), list(names), weights)


def telling_words(rows: DataFrame) -> list[tuple[str, bool]]:
    """(word, speaks for label 1) of the words that tell the labels of ``doc_id, text, y`` apart."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    n, t = totals["n"], totals["t"]
    if not 0 < t < n:
        return []
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def stems(n):
        long = F.filter(F.col("ws"), lambda w: F.length(w) > n)
        return F.array_distinct(F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*"))))

    words = rows.select("y", F.array_distinct(found).alias("ws")) \
        .select("y", F.explode(F.concat("ws", *map(stems, STEMS))).alias("w")) \
        .groupBy("w").agg(F.count(F.lit(1)).alias("k"), F.sum("y").alias("a")).filter(F.col("k") >= MIN_DOCS)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    a, k = F.col("a").cast("double"), F.col("k").cast("double")
    g = 2 * (part(a, k * t / n) + part(k - a, k * (n - t) / n) + part(t - a, (n - k) * t / n)
             + part(n - t - k + a, (n - k) * (n - t) / n))
    found = words.withColumn("g", F.round(g, 9)).filter(F.col("g") >= MIN_G).orderBy(F.desc("g"), "w").collect()  # words of a bounded sample
    return [(r["w"], r["a"] * n > r["k"] * t) for r in found]


class _Marks(dict):
    """word -> numbers of the marks it carries (itself and its beginnings); bounded."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index, self.features = index, max(index.values(), default=-1) + 1

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 400_000:
            self.clear()
        own = [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]
        got = self[word] = tuple({self.index[x] for x in own if x in self.index})
        return got


def presence(texts: list[str], marks: _Marks) -> np.ndarray:
    x = np.zeros((len(texts), marks.features))
    for i, text in enumerate(texts):
        for w in set(_WORD.findall(text.lower())):
            for k in marks[w]:
                x[i, k] = 1
    return x


def _presence_rows(batches, index: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Numbers of the marks of each text."""
    marks = _Marks(index)
    for cols, texts in slices(batches):
        found = [sorted({k for w in set(_WORD.findall(text.lower())) for k in marks[w]}) for text in texts]
        yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["y"], pa.int32()),
                                          pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "y", "x"])


def folded(found: list, words: list[tuple[str, bool]]) -> tuple[Presence, list[str], np.ndarray]:
    """(presence of each feature, its marks, whether it speaks for label 1); marks with the same rows are one feature."""
    rows: list[list[int]] = [[] for _ in words]
    for i, own in enumerate(found):
        for k in own:
            rows[k].append(i)
    features: dict[tuple, list[int]] = {}
    for k, own in enumerate(rows):
        features.setdefault(tuple(own), []).append(k)
    row = np.array([i for own in features for i in own], np.int64)
    feature = np.repeat(np.arange(len(features)), [len(own) for own in features])
    x = Presence(row, feature, len(found), len(features), np.zeros((len(found), 0)))
    return x, [" ".join(words[k][0] for k in ks) for ks in features.values()], np.array([words[ks[0]][1] for ks in features.values()], bool)


def severity(x: Presence, y: np.ndarray, speaks: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The query's categories in chain order, from the label and the words that speak for it."""
    found = x.count(speaks)
    return ["abusive", "repeated", "toxic"], np.stack([y * (found >= 1), y * (found >= 3), y], axis=1)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, hold_out: int | None = 0,
          categories: Callable = severity) -> Chain:
    rows = staged(training_rows(docs, labels, "toxic", max_rows, hold_out), "toxic-sample")
    words = telling_words(rows)
    index = {w: i for i, (w, _) in enumerate(words)}
    got = rows.mapInArrow(partial(_presence_rows, index=index), "doc_id long, y int, x array<int>").toPandas() \
        .sort_values("doc_id", kind="stable")
    x, features, speaks = folded(got["x"].tolist(), words)
    y = got["y"].to_numpy(np.float64)
    names, many = categories(x, y, speaks)
    folds = np.array([py_fold(d, 1 << 20) // 5 % FOLDS for d in got["doc_id"]], np.int64)
    return fit_chain(x, many, folds, features, names, docs.sparkSession)


def _score(batches, chain: Chain, threshold: float) -> Iterator[pa.RecordBatch]:
    marks = _Marks({w: i for i, own in enumerate(chain.words) for w in own.split(" ")})
    for cols, texts in slices(batches):
        p = chain.predict(presence(texts, marks))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols["doc_id"], pa.int64()), *[pa.array(c) for c in p.T], pa.array(p[:, -1]), pa.array((p[:, -1] >= threshold).astype(np.int32))],
            names=["doc_id", *[f"p_{n}" for n in chain.names], "score", "predicted"])


def score_toxicity(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, p_<category>..., score`` (of the last category) ``, predicted`` for every document."""
    shape = ", ".join(["doc_id long", *[f"p_{n} double" for n in chain.names], "score double", "predicted int"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")) \
        .mapInArrow(partial(_score, chain=chain, threshold=threshold), shape)
