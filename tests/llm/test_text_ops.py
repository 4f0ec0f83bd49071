"""Exact dedup, n-gram join and decontamination against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import decontamination as dc
from fundlens.llm import exact_dedup as ed
from fundlens.llm import ngram_join as nj
from fundlens.llm.components import components

SHAPE = "doc_id long, text string, keep_id long, class_id string"  # extra columns with clashing names


@pytest.fixture(scope="module")
def odd_docs(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=60)) for _ in range(12)]
    near = [" ".join(["new", *b.split()[1:]]) for b in base[:5]]
    long = " ".join(rnd.choices(words, k=30_000))
    texts = [*base, *near, base[0], base[0], "", "", None, "one", "one two", "One, two!", long, long + " end"]
    rows = [(100 + 7 * i % 61, t, 1, "x") for i, t in enumerate(texts)]
    rows += [rows[0], (None, base[1], 2, None), (None, None, None, None)]
    return spark.createDataFrame(rows, SHAPE)


def _rows(df):
    return sorted(df.collect(), key=lambda r: tuple((x is not None, x) for x in r))


def test_chunks_add_up_to_the_text(odd_docs):
    got = odd_docs.select("text", F.array_join(ed.chunks(F.coalesce("text", F.lit(""))), "").alias("again")).collect()
    assert all(r["again"] == (r["text"] or "") for r in got)


@pytest.mark.parametrize("buckets", [None, 3])
def test_exact_dedup_equals_brute_force(odd_docs, buckets):
    """With ``buckets`` nearly all chunk hashes collide, and the verified identifiers tell them apart."""
    hashed = F.xxhash64 if buckets is None else lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    groups = defaultdict(list)
    for r in odd_docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            want.append((i, keep, len(ids), i == keep and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != keep
    got = ed.exact_dedup(odd_docs, hashed).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("repeated", [False, True])
def test_stages_keep_extra_columns_whatever_their_names(spark, repeated):
    names = ["__id", "__sha", "__row", "__kept", "_h0", "_h1", "_h2", "kept", "row", "text_sha256", "class_id", "set_id"]
    shape = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    words = [" ".join(f"w{i * j % 97}" for i in range(1, 40)) for j in range(1, 6)]
    texts = [*words, words[0], None, "", "x " * 50_000, words[1] + " end"]
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    rows += [rows[2], (None, words[3], *names)] if repeated else []
    docs = spark.createDataFrame(rows, shape)
    whole = {tuple(r) for r in rows}
    for out, gone in ((ed.drop_copies(docs), {words[0]}), (nj.keep_one(docs), {words[1]})):
        assert out.columns == docs.columns
        got = [tuple(r) for r in out.collect()]
        assert set(got) <= whole and gone <= {r[1] for r in got}
    kept = [r[1] or "" for r in ed.drop_copies(docs).collect()]
    assert sorted(kept) == sorted({t or "" for t in texts})
    left = [r[0] for r in nj.keep_one(docs).collect()]
    assert 0 in left and 1 in left and not {5, 9} & set(left) and {6, 7, 8} <= set(left)


def test_drop_copies_keeps_columns_and_one_of_each(odd_docs, spark):
    kept = ed.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r["text"] or "" for r in odd_docs.collect()})
    assert ed.drop_copies(spark.createDataFrame([], SHAPE)).count() == 0


def _grams(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("block", [1, 512])
def test_ngram_join_equals_brute_force(odd_docs, block):
    rows = [(r["doc_id"], _grams(r["text"])) for r in odd_docs.collect()]
    n = len(rows)
    near = [[i != j and bool(a) and 5 * len(a & b) >= 4 * len(a | b) for j, (_, b) in enumerate(rows)] for i, (_, a) in enumerate(rows)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in range(n) if near[i][j])]) for i in range(n)]
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    want = [(rows[i][0], least([rows[j][0] for j in range(n) if label[j] == label[i]]),
             least([rows[j][0] for j in range(n) if rows[j][1] == rows[i][1] and (rows[i][1] or j == i)]), sum(near[i])) for i in range(n)]
    got = nj.ngram_join(odd_docs, block_classes=block).select("doc_id", "class_id", "copy_id", "n_links")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_near_copies_in_a_large_group_are_all_linked(spark):
    base = [f"t{i}" for i in range(80)]
    rows = [(i, " ".join([*base[:40], f"x{i}", *base[41:]])) for i in range(60)]
    got = nj.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), block_classes=7).collect()
    assert {r["class_id"] for r in got} == {0} and {r["n_links"] for r in got} == {59}
    assert nj.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def _drifting(n, step=9, words=60):
    """Texts of which each differs from the one before in nine words at its ends: a long component of few links."""
    return [" ".join(f"w{k}" for k in range(step * i // 2, step * i // 2 + words)) for i in range(n)]


def _drift_signs(texts):
    rows, bands = nj.choose_bands()
    sets = [nj.ngram_set(t) for t in texts]
    mult, add = nj._hash_params(rows * bands)
    return sets, nj.band_hashes(np.stack([nj.min_hashes(s, mult, add) for s in sets]), rows, bands)


def test_only_pairs_that_share_a_band_are_compared():
    sets, bands = _drift_signs(_drifting(200))
    pairs = nj.sharing(bands)
    want = np.array([[i != j and bool(set(a.tolist()) & set(b.tolist())) for j, b in enumerate(bands)] for i, a in enumerate(bands)])
    assert (pairs == want).all() and 0 < pairs.sum() < 200 * 199 // 8
    full = nj.linked(sets, Fraction(4, 5))
    assert not (full & ~pairs).any()  # at this recall
    assert (nj.verified(sets, bands, Fraction(4, 5)) == full).all()
    side = np.arange(200) % 3
    assert (nj.verified(sets, bands, Fraction(4, 5), side) == (full & (side[:, None] != side[None, :]))).all()
    close = [f"{' '.join(f'a{k}' for k in range(100))} b{i}" for i in range(30)]  # most pairs are candidates
    sets, bands = _drift_signs(close)
    assert (nj.verified(sets, bands, Fraction(4, 5)) == nj.linked(sets, Fraction(4, 5))).all()


def test_a_drifting_component_goes_only_where_bands_meet(spark):
    texts = _drifting(120)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [_grams(t) for t in texts]
    links = [sum(i != j and 5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in nj.ngram_join(docs, block_classes=6).collect()}
    label = list(range(120))
    for i in range(1, 120):
        if 5 * len(sets[i] & sets[i - 1]) >= 4 * len(sets[i] | sets[i - 1]):
            label[i] = label[i - 1]
    assert got == {i: (label[i], links[i]) for i in range(120)}

    _, bands = _drift_signs(texts)
    blocked = spark.createDataFrame([(i, i % 20, 20, False, b.tolist()) for i, b in enumerate(bands)],
                                    "node long, block int, blocks int, dense boolean, bands array<long>")
    pairs = nj.sharing(bands)
    want = {(i, j % 20) for i in range(120) for j in np.flatnonzero(pairs[i])}
    sent = [tuple(r) for r in nj._destinations(blocked).collect()]
    assert len(sent) == len(set(sent)) and set(sent) == want and len(sent) < 120 * 20


def test_bands_reach_the_recall():
    rows, bands = nj.choose_bands(0.8, 0.9999, 192)
    assert rows * bands <= 192 and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


def test_ngram_join_of_nothing(spark):
    assert nj.ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def _nearest(item, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (c != d)))
        prev = row
    return min(prev)


def test_myers_equals_the_table():
    rnd = random.Random(5)
    for _ in range(300):
        item = "".join(rnd.choices("abc ", k=rnd.randint(1, 90)))
        text = "".join(rnd.choices("abc ", k=rnd.randint(0, 60)))
        want, budget = _nearest(item, text), rnd.randint(0, 40)
        got = dc.myers(item, text, budget)
        assert (got[0] if got else None) == (want if want <= budget else None)


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(150)]
    items = [" ".join(rnd.choices(words, k=rnd.randint(6, 30))) for _ in range(12)] + ["too short item", "", None]
    def edited(s, k):
        s = list(s)
        for _ in range(k):
            s[rnd.randrange(len(s))] = rnd.choice("xyz")
        return "".join(s)
    docs = []
    for i in range(60):
        parts = rnd.choices(words, k=rnd.randint(0, 60))
        if i % 3 == 0:
            item = items[i % 12]
            parts.insert(rnd.randint(0, len(parts)), edited(item, rnd.randint(0, int(0.12 * len(item)))).title())
        docs.append((i, ",\n".join(parts), 1))
    docs += [(1000, None, 0), (1001, "", 0), (None, items[0], 0), (0, docs[0][1], 0)]
    want = []
    for doc_id, text, _ in docs:
        for k, item in enumerate(items):
            norm = dc.normalise(item or "")
            if len(norm.split()) >= dc.MIN_WORDS:
                d = _nearest(norm, dc.normalise(text or ""))
                if d <= int(dc.ERROR_RATE * len(norm)):
                    want.append((doc_id, k, d))
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert len(want) > 10
    for block in (dc.BLOCK_CHARS, 300):
        got = dc.find_leaks(frame, bench, block_chars=block).select("doc_id", "item_id", "distance").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        clean = dc.drop_leaks(frame, bench, block_chars=block)
        assert clean.columns == frame.columns
        assert sorted((r["doc_id"] for r in clean.collect()), key=str) == sorted((d[0] for d in docs if d[0] not in {w[0] for w in want}), key=str)
    assert dc.find_leaks(frame.limit(0), bench).count() == 0
    assert dc.find_leaks(frame, bench.limit(0)).count() == 0


def test_short_items_and_items_without_an_id_are_found_verbatim(spark):
    items = [(1, "Red fox?"), (2, "敏捷的棕色狐狸跳过懒狗"), (None, "an item of six words without id"), (3, "狐狸")]
    docs = [(1, "the red, FOX runs"), (2, "bored foxes"), (3, "他说敏捷的棕色狐狸跳过懒狗了"), (4, "Here an item of six words without ID"), (5, "clean")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["short"]) for r in dc.find_leaks(frame, bench).collect()}
    assert got == {(1, 1, True), (3, 2, False), (3, 3, True), (4, None, False)}
    assert {r["doc_id"] for r in dc.drop_leaks(frame, bench).collect()} == {2, 5}
    assert {r["doc_id"] for r in dc.drop_leaks(frame, bench, short=False).collect()} == {1, 2, 5}
