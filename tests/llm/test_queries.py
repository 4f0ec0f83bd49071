"""The registered queries: SQL where there is some, and the pipeline against its invariants."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from fundlens.llm import catalog
from fundlens.llm import decontamination as dc
from fundlens.llm.common import read_table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    names = sorted(columns)
    rows = [[r[columns.index(n)] for n in names] for r in want.fetchall()]
    got = catalog.queries()[name](spark, SF)
    assert sorted(got.columns) == names
    assert sorted(map(repr, map(list, got.select(names).collect()))) == sorted(map(repr, rows))


def test_there_is_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.queries()) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = read_table(spark, SF, "documents")
    bench = read_table(spark, SF, "benchmark")
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = {r["doc_id"]: r["text"] for r in out.collect()}
        assert rows.items() <= left.items(), name
        if name == "exact dedup":
            assert sorted(rows) == sorted({t: max(i for i, x in left.items() if x == t) for t in left.values()}.values())
        left, docs = rows, out
    items = tuple((r["item_id"], r["text"]) for r in bench.collect())
    matcher = dc.Matcher(list(items), dc.ERROR_RATE, dc.MIN_WORDS)
    assert left and not any(list(matcher.find(t)) for t in left.values())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p["doc_id"] for p in pieces} == set(left)


def test_pipeline_of_an_empty_table(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
