"""Fill-in-the-middle against whole-text assembly, and its round trip."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fundlens.llm import fill_middle as fm

SHAPE = "doc_id long, text string, key string, n string, form int, pos int"  # extra columns with clashing names


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _brute(doc_id, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, _sha(text), _sha(text)), text
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return (doc_id, n, form, len(p), len(m), _sha(out), _sha(text)), out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    odd = ["a", "é", "漢字", "😀", "\n", "\n\n", "\r\n", " ", "<", "<P", "S>", "<M", " ", "\x00", "\x0b", "x" * 40]
    rows = [(i % 83, "".join(rnd.choices(odd, k=rnd.randint(0, 60)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "\n"), (903, "no break"), (904, "has <P> in it\nand more"), (905, "<M>"),
             (906, "line of a long text\n" * 30_000), (907, "one unit " * 20_000), (908, "é\n" * 5000 + "end"),
             (None, "no id\nat all\n"), (3, "again\n"), (3, "again\n"), (3, "again\n")]
    return rows


@pytest.mark.parametrize("chunk", [7, fm.CHUNK])
def test_digests_equal_whole_text_assembly(spark, rows, chunk):
    docs = spark.createDataFrame([(*r, "k", "n", 1, 2) for r in rows], SHAPE).repartition(3)
    rows_here = rows if chunk > 100 else [r for r in rows if len(r[1] or "") < 100_000]
    got = fm.fill_in_middle(docs.filter(F.coalesce(F.length("text"), F.lit(0)) < (10 ** 9 if chunk > 100 else 100_000)), chunk=chunk)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((_brute(*r)[0] for r in rows_here), key=repr)


def test_pieces_are_bounded_runs_of_units_and_add_up_to_the_output(spark, rows):
    docs = spark.createDataFrame([(*r, "k", "n", 1, 2) for r in rows], SHAPE)
    texts = {}
    for r in fm.pieces(docs, chunk=64).orderBy("key", "pos").collect():
        assert len(r["text"]) <= 64 + 3
        texts.setdefault(r["key"], []).append(r)
    outputs = ["".join(r["text"] for r in p) for _, p in sorted(texts.items())]
    assert sorted(outputs) == sorted(_brute(*r)[1] for r in rows)
    for p in texts.values():
        out = "".join(r["text"] for r in p)
        assert [r["pos"] for r in p] == list(range(len(p))) and [r["last"] for r in p] == [False] * (len(p) - 1) + [True]
        assert _sha(fm.restore_text(out, p[0]["form"])) in {_brute(*r)[0][-1] for r in rows if r[0] == p[0]["doc_id"]}


def test_rate_leaves_documents_plain(spark, rows):
    docs = spark.createDataFrame([(*r, "k", "n", 1, 2) for r in rows], SHAPE)
    got = sorted(map(tuple, fm.fill_in_middle(docs, rate=40).collect()), key=repr)
    assert got == sorted((_brute(*r, rate=40)[0] for r in rows), key=repr)
    assert 0.2 < sum(r[2] == "plain" for r in got) / len(got) < 0.95


def test_one_id_on_all_rows_spreads_over_tasks(spark):
    docs = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("same\ntext\n"), F.lit("")).alias("text"))
    spread = fm.pieces(docs).repartition(8, "key").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8
    assert fm.fill_in_middle(docs).distinct().count() == 1 and fm.fill_in_middle(docs).count() == 400


def test_a_missing_piece_is_an_error(spark):
    made = fm.pieces(spark.createDataFrame([(1, "a\nb\nc\nd\n" * 50)], "doc_id long, text string"), chunk=16)
    with pytest.raises(Exception, match="missing|not complete"):
        fm.assembled(made.filter("pos <> 2")).collect()


def test_empty_table(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
