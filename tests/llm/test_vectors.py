"""Vector codes against exhaustive integer search."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from fundlens.llm import vector_codes as vc

SHAPE = "vec_id long, embedding array<float>, label int, q int, code string, error string"


def _brute(rows, parts, entries, rounds):
    kept = [(i, x, y) for i, x, y in rows if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    kept = [(i, [math.floor(4096 * float(np.float32(c))) for c in x], y) for i, x, y in kept]
    width = -(-max((len(x) for _, x, _ in kept), default=0) // parts)
    kept = [(i, x + [0] * (parts * width - len(x)), y) for i, x, y in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[x[p * width:(p + 1) * width] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def find(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            codes = [find(c[p], books[p])[1] for c in cut]
            for j in set(codes):
                mine = [c[p] for c, k in zip(cut, codes, strict=True) if k == j]
                books[p][j] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    out = []
    for (i, _, y), c in zip(kept, cut, strict=True):
        best = [find(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best), y))
    sums = {}
    for _, _, e, y in out:
        sums[y] = sums.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[y], digest) for i, c, e, y in out), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(i, x, y, 1, "clash", "clash") for i, x, y in rows], SHAPE)


@pytest.mark.parametrize("size", [1, 2, 4, 8, 16, 32])
def test_transform_is_in_sequency_order_and_keeps_distances(size):
    matrix = vc.walsh_hadamard(np.eye(size, dtype=np.int64)).T
    assert [int((np.diff(np.sign(r)) != 0).sum()) for r in matrix] == list(range(size))
    a, b = np.random.default_rng(1).integers(-9999, 9999, (2, 20, size))
    assert (((vc.walsh_hadamard(a) - vc.walsh_hadamard(b)) ** 2).sum(axis=1) == size * ((a - b) ** 2).sum(axis=1)).all()


@pytest.mark.parametrize(("width", "scale"), [(1, 9), (3, 2), (5, 10 ** 6), (8, 3), (8, 2 ** 45)])
def test_nearest_is_exact_with_ties_to_the_lower_index(width, scale):
    rnd = np.random.default_rng(2)
    parts, entries = rnd.integers(-3, 4, (500, width)) * scale, rnd.integers(-3, 4, (16, width)) * scale
    entries[9] = entries[4]
    code, error = vc.nearest(parts, entries)
    d = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e, strict=True)) for e in entries] for p in parts]
    assert code.tolist() == [min(range(16), key=lambda j: (r[j], j)) for r in d]
    assert list(map(int, error)) == [min(r) for r in d]


def test_early_elimination_leaves_few_entries_to_the_end():
    rnd = np.random.default_rng(3)
    centres = rnd.integers(-2000, 2000, (16, 8))
    code, _ = vc.nearest(centres[rnd.integers(0, 16, 400)] + rnd.integers(-50, 50, (400, 8)), centres)
    assert len(set(code.tolist())) == 16


def test_codes_equal_brute_force_with_odd_rows(spark):
    rnd = random.Random(4)
    rows = [(1000 - 3 * i, [rnd.gauss(0, 0.2) for _ in range(20)], i % 3 or None) for i in range(120)]
    rows += [(5, [0.25] * 20, None), (5, [0.25] * 20, None), (5, [-0.5] * 20, 7), (None, [0.1] * 20, 7), (8, [], 7),
             (9, [1.5, -2.0], 1), (10, None, 1), (11, [None] * 20, 1), (12, [float("nan")] * 20, 1),
             (13, [float("inf")] + [0.0] * 19, 1), (14, [-300.5] * 20, 2)]
    got = vc.compress(_frame(spark, rows).repartition(5), rounds=3)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == _brute(rows, 8, 16, 3)


def test_fewer_vectors_than_entries_and_wide_magnitudes(spark):
    rows = [(3, [2.0 ** 40] * 8, 1), (1, [-(2.0 ** 40)] * 8, 1), (2, [0.0] * 8, 2)]
    assert sorted(map(tuple, vc.compress(_frame(spark, rows)).collect()), key=repr) == _brute(rows, 8, 16, 6)
    assert vc.compress(_frame(spark, rows[:1])).first()["code"] == "00" * 8


def test_empty_tables(spark):
    assert vc.compress(_frame(spark, [(1, None, 1)])).collect() == []
    assert vc.compress(_frame(spark, []).limit(0)).collect() == []
    assert vc.compress(_frame(spark, [(1, [], 1), (2, [], None)])).orderBy("vec_id").first()["error"] == 0


def test_codes_decode_to_their_entries(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.random() for _ in range(16)], 1) for i in range(60)]
    q = vc.quantised(_frame(spark, rows))
    books = vc.train_codebooks(q)
    vectors = {r["vec_id"]: np.array(r["q"]) for r in q.collect()}
    for r in vc.encode(q, books).collect():
        assert int(((vectors[r["vec_id"]] - vc.decode(r["code"], books)) ** 2).sum()) == r["error"]
