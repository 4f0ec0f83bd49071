"""Suffix-array dedup against a dictionary of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundlens.llm import suffix_dedup as sd

SHAPE = "doc_id long, text string, part string, no int, key string, sizes int"  # extra columns with clashing names


def _brute(rows, length=sd.LENGTH):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(t), int(gone.sum()), len(sd.runs(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "clash", 2) for i, t in rows], SHAPE)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["é", "漢字", "\n", "\x00"]

    def text(n):
        return " ".join(rnd.choices(words, k=n))

    base = [text(rnd.randint(1, 500)) for _ in range(25)]
    passage, other = text(170), text(150)
    rows = [(i % 31, t) for i, t in enumerate(base)]
    rows += [(100 + i, text(rnd.randint(0, 80)) + passage + text(rnd.randint(0, 80))) for i in range(30)]
    rows += [(200 + i, text(30) + passage[i:i + 405 + i % 7] + "|" + text(30) + other) for i in range(30)]
    rows += [(300, passage + passage), (301, "ab" * 700), (302, "ab" * 300 + "c"), (303, "z" * 2000), (304, "z" * 399), (305, "z" * 400),
             (306, "short"), (307, "short"), (308, ""), (309, None), (None, base[0]), (310, base[1]), (310, base[1]), (311, base[2] + "x"),
             (312, "y" + base[3]), (313, base[4][:399]), (314, base[5][10:410])]
    rows += [(400, " ".join(f"n{i}" for i in range(9000)) + passage + " ".join(f"m{i}" for i in range(9000)))]  # several blocks
    return rows


@pytest.fixture(scope="module")
def want(rows):
    return _brute(rows)


@pytest.mark.parametrize("options", [
    {}, {"slice_bytes": 3000}, {"slice_bytes": 5000, "shard_bytes": 2000, "sample": 8},
    {"shard_rows": 3, "slice_bytes": 2500, "range_windows": 700}, {"shard_rows": 1, "slice_bytes": 1500, "shard_bytes": 1, "range_windows": 400}])
def test_removed_bytes_equal_brute_force(spark, rows, want, options):
    """Whatever is cut into slices, shards (spread keys included) and ranges."""
    got = sd.remove_repeats(_frame(spark, rows).repartition(3), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_repeats_are_found(want):
    assert sum(r[2] > 0 for r in want) > 60 and sum(0 < r[2] < r[1] for r in want) > 30 and max(r[3] for r in want) > 1


def test_suffixes_are_in_order_and_prefixes_right():
    rnd = np.random.default_rng(1)
    for letters in (1, 2, 26):
        strings = [bytes(rnd.integers(97, 97 + letters, rnd.integers(1, 120), dtype=np.uint8)) for _ in range(50)]
        strings += [strings[0], strings[1][3:], b"a" * 90, b"\0\0\0", b"\0", b"\xff" * 60, b"\xff" * 61]
        ends, text = np.cumsum([len(x) for x in strings]), b"".join(strings)
        order, rank, left, word = sd.suffix_array(np.frombuffer(text, np.uint8), ends)
        suffix = [text[i:i + left[i]] for i in range(len(text))]
        assert order.tolist() == sorted(range(len(text)), key=lambda i: (suffix[i], i))
        for limit in (6, 40):
            shared = sd.common_prefixes(order, rank, left, word, ends, np.diff(np.r_[0, ends]), limit)
            for i, (a, b) in enumerate(zip(order[:-1], order[1:], strict=True)):
                k = int(shared[i + 1])
                assert suffix[a][:k] == suffix[b][:k] and (k == limit or suffix[a][:k + 1] != suffix[b][:k + 1] or k == len(suffix[a]))


def test_windows_that_repeat_are_dealt_to_one_key():
    rnd = np.random.default_rng(2)
    passage = rnd.integers(97, 100, 900, dtype=np.uint8)
    found = {}
    for _ in range(5):
        data = np.concatenate([rnd.integers(97, 100, rnd.integers(0, 300), dtype=np.uint8), passage, rnd.integers(97, 100, 50, dtype=np.uint8)])
        keys, first, sizes = sd._dealt(sd.gram_hashes(data), np.ones(len(data) - sd.LENGTH + 1, bool))
        assert sizes.sum() == len(data) - sd.LENGTH + 1 and sizes.max() <= sd.LENGTH - sd.GRAM + 1
        for key, lo, n in zip(keys.tolist(), first.tolist(), sizes.tolist(), strict=True):
            for i in range(lo, lo + n):
                assert found.setdefault(data[i:i + sd.LENGTH].tobytes(), key) == key


def test_one_passage_in_most_documents_is_spread_over_tasks(spark):
    rnd = random.Random(9)
    passage = "".join(rnd.choices("abcdefgh ", k=500))
    rows = [(i, "".join(rnd.choices("ijklm", k=150)) + passage + "".join(rnd.choices("nopq", k=150))) for i in range(120)]
    docs = _frame(spark, rows)
    slices = sd.slice_table(docs, 4000)
    copies = sd._by_part(sd._copies(slices), "copied-texts", "no", "i")
    found = sd.contexts(slices, copies, sd.repeated_grams(slices, copies, 8, 4000), 8, 4000)
    assert found.groupBy("key").count().agg(F.max("count")).first()[0] > 60
    got = sd.remove_repeats(docs, sample=8, slice_bytes=4000, shard_rows=10, range_windows=2000).collect()
    assert sorted(map(tuple, got), key=repr) == _brute(rows)


def test_empty_tables(spark):
    assert sd.remove_repeats(_frame(spark, []).limit(0)).collect() == []
    assert [tuple(r)[:4] for r in sd.remove_repeats(_frame(spark, [(1, None)])).collect()] == [(1, 0, 0, 0)]
