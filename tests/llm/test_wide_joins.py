"""Whole texts stay out of shuffles: the filter before the joins by id."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from fundlens.llm import exact_dedup as ed
from fundlens.llm import ngram_join as nj
from fundlens.llm.common import may_be_listed, without


@pytest.fixture()
def no_broadcast(spark):
    """As on a large table: nothing is small enough to be broadcast unasked."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("words", [1, 4, 2 ** 18])
def test_the_filter_loses_no_listed_row_and_the_rest_is_exact(spark, words):
    rows = [(i, f"t{i}", i % 3) for i in range(300)] + [(None, "none", 0), (7, "again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h0 int")
    listed = spark.createDataFrame([(i,) for i in [*range(0, 300, 7), None, 999]], "id long")
    ids = {*range(0, 300, 7), None}
    got = may_be_listed(docs, F.col("doc_id"), listed, words)
    assert got.columns == docs.columns
    found = {tuple(r) for r in got.collect()}
    assert {r for r in rows if r[0] in ids} <= found <= set(rows)
    assert words < 2 ** 18 or len(found) < 60
    left = without(docs, [F.col("doc_id")], listed, words)
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted((r for r in rows if r[0] not in ids), key=str)
    pairs = spark.createDataFrame([(7, "again"), (None, "none"), (5, "other")], "id long, text string")
    left = without(docs, [F.col("doc_id"), F.col("text")], pairs, words)
    assert sorted(map(tuple, left.collect()), key=str) == sorted((r for r in rows if r[1] not in ("again", "none")), key=str)
    assert without(docs, [F.col("doc_id")], listed.limit(0), words).count() == len(rows)


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def _reaches_join(plan: str) -> list[bool]:
    """For each scan of ``text``: whether all of its rows go to a join that shuffles."""
    lines, out = plan.splitlines(), []
    depth = lambda x: len(re.match(r"[\s:+\-|]*", x)[0])
    for i, line in enumerate(lines):
        if "FileScan" in line and "text#" in line:
            above, d = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < d:
                    above.append(up)
                    d = depth(up)
            joins = [re.search(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)", a) for a in above]
            first = next((j[1] for j in joins if j), "")
            out.append(first in ("SortMergeJoin", "ShuffledHashJoin"))
    return out


@pytest.fixture()
def docs(spark, tmp_dir):
    texts = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(60)]
    texts += [texts[0], texts[1], texts[2] + " end", texts[3] + " end"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/docs")
    return spark.read.parquet(f"{tmp_dir}/docs")


def test_dropping_copies_joins_only_doubtful_texts(docs, no_broadcast):
    for out, gone in ((ed.drop_copies(docs), {0, 1}), (nj.keep_one(docs), {60, 61, 62, 63})):
        scans = _reaches_join(_plan(out))
        assert scans and not any(scans)
        assert {r["doc_id"] for r in out.collect()} == set(range(64)) - gone


@pytest.mark.parametrize("unclear", [False, True])
def test_sets_are_made_of_the_texts_of_candidates_alone(spark, docs, no_broadcast, monkeypatch, unclear):
    seen = []
    whole = nj.class_sets

    def spy(texts, wanted, words, told_apart):
        out = whole(texts, wanted, words, told_apart or unclear)
        seen.append((_reaches_join(_plan(out)), {r["copy_id"] for r in out.collect()}))
        return out

    monkeypatch.setattr(nj, "class_sets", spy)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in nj.ngram_join(docs).collect()}
    near = {60: 0, 61: 1, 62: 2, 63: 3}
    assert got == {i: (near.get(i, i), int(i in near or i in near.values())) for i in range(64)}
    assert [s for s, _ in seen] and not any(seen[0][0]) and seen[0][1] == {2, 3, 62, 63}
