"""Token pieces, Huffman files and packing: exact round trips and brute force."""

from __future__ import annotations

import heapq
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fundlens.llm import common, huffman, ngram_join, packing, quality
from fundlens.llm.catalog import tokenizer_file
from fundlens.llm.pieces import PieceEncoder
from fundlens.session import scratch_dir

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["a", "B", "é", "é", " ", "  ", "\n", "\n\n", "\t", "\x1c", " ", "。", "漢字", "'s", "'", "n't", "...", "!?", "-", "_", "1", "½",
       "×", "ß", "İ", "Σ", "ς", "́", "ŉ", "😀", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "word", "The", ";", "\r\n", " ", "***", "\x00"]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(1)
    rows = [(i * 3 % 101, " ".join(rnd.choices(["the", "of", "Straße", "x1", "it's", "end.\nNew"], k=rnd.randint(0, 300)))) for i in range(100)]
    rows += [(5000, "long " * 9000), (5001, None), (5002, ""), (5003, "a <|endoftext|> b<|endoftext|><|endoftext|>\n"), (0, "again"), (0, "again"), (None, "no id")]
    return spark.createDataFrame([(*r, 7, "u") for r in rows], "doc_id long, text string, start long, n_tokens string")


def whole(name, texts):
    t = Tokenizer.from_file(tokenizer_file(name))
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_pieces_give_the_ids_of_whole_texts(spark, name):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(ODD, k=rnd.randint(0, 25))) for _ in range(8000)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    enc = PieceEncoder(tokenizer_file(name), max_pieces=500)  # forgets often
    want = whole(name, texts)
    got = []
    for at in range(0, len(texts), 900):
        ids, n = enc.ids_of(texts[at:at + 900], 1)
        cuts = np.concatenate([[0], np.cumsum(n)])
        got += [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert got == want


def test_piece_table_is_bounded_by_characters():
    rnd = random.Random(5)
    enc = PieceEncoder(tokenizer_file(BYTE))
    enc.max_chars = 50_000
    for _ in range(30):
        texts = ["the end " + "".join(rnd.choices("abcdefghij", k=5000)) + " the end" for _ in range(2)]
        assert enc.ids_of(texts, 1)[0].tolist() == [i for w in whole(BYTE, texts) for i in w]
        assert sum(map(len, enc)) <= 50_000 + sum(map(len, texts))
    assert "the" in enc  # what is used again stays


def test_what_a_worker_keeps_is_bounded_and_let_go():
    words = ngram_join._WordHashes()
    text = "x" * 10_000
    assert words[text] == words[text] and text not in words
    for i in range(200_000):
        words[str(i)]
    assert len(words) <= 150_000 and words["7"] == ngram_join._WordHashes()["7"]
    for run in (lambda: list(quality._keep(iter([]), None, 0.3)),
                lambda: list(packing._emit(iter([]), packing.plan_windows(np.zeros(4, np.int64)), 2048, False))):
        common._kept["pieces", "made up"] = {"a": 1}
        run()
        assert ("pieces", "made up") not in common._kept


def test_pieces_are_cut_from_few_ids_at_once():
    n, docs = 1500, 2500
    ids = np.random.default_rng(6).integers(0, 50_000, (docs, n)).astype("<u2")
    plan = packing.plan_windows(np.bincount([n], minlength=2048) * docs)
    column = lambda x: pa.array(np.zeros(docs, np.int64) + x)
    batch = pa.RecordBatch.from_arrays(
        [column(0), column(n), column(np.arange(docs)), column(0), column(np.arange(docs)), column(n),
         pa.array([x.tobytes() for x in ids], pa.binary()), column(0), column(0)],
        names=["part", "rest", "rank", "whole_before", "doc_id", "n_tokens", "ids", "rank_from", "whole_from"])
    for with_ids in (True, False):
        found = list(packing._emit([batch], plan, 2048, with_ids))
        assert max(sum(b.column("length").to_pylist()) for b in found) <= 1_000_000
        rows = sorted((r for b in found for r in b.to_pylist()), key=lambda r: (r["doc_id"], r["start"]))
        own = [ids[r["doc_id"], r["start"]:r["start"] + r["length"]].astype("<u4").tobytes() for r in rows]
        assert [r["ids_crc32"] for r in rows] == [zlib.crc32(x) for x in own]
        assert sum(r["length"] for r in rows) == docs * n and [r["ids"] for r in rows] == (own if with_ids else [None] * len(own))


def test_code_lengths_are_optimal_and_limited():
    rnd = np.random.default_rng(3)
    for size in (1, 2, 3, 40, 700):
        counts = rnd.integers(0, 1000, size) ** 2
        counts[rnd.integers(size)] += 1
        lengths = huffman.code_lengths(counts, 40)
        heap = [int(c) for c in counts if c]
        heapq.heapify(heap)
        cost = heap[0] if len(heap) == 1 else 0
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert int((lengths * counts).sum()) == cost
        if size == 700:
            short = huffman.code_lengths(counts, 10)
            assert short.max() <= 10 and sum(2.0 ** -int(x) for x in short if x) <= 1
            assert (short > 0).tolist() == (counts > 0).tolist()


def test_blocks_decode_alone():
    rnd = np.random.default_rng(4)
    n = np.array([5000, 1, 1024, 3, 2500])
    ids = rnd.zipf(1.3, int(n.sum())) % 900
    lengths = huffman.code_lengths(np.bincount(ids, minlength=900))
    bits, starts, marks, blocks = huffman.pack(ids, n, lengths, huffman.canonical_codes(lengths))
    symbols, sizes = huffman.decode_table(lengths)
    doc, place = np.repeat(np.arange(5), blocks), np.concatenate([np.arange(b) for b in blocks])
    held = np.minimum(huffman.BLOCK, n[doc] - place * huffman.BLOCK)
    at = marks + 8 * starts[doc]
    assert (huffman.decode_blocks(bits, at, held, symbols, sizes) == ids).all()
    begins = np.cumsum(held) - held
    for b in (0, 3, len(at) - 1):
        alone = huffman.decode_blocks(bits, at[b:b + 1], held[b:b + 1], symbols, sizes)
        assert (alone == ids[begins[b]:begins[b] + held[b]]).all()


def test_files_return_every_id_in_order(docs, spark):
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0]))
    want = whole(WORD, [t for _, t in rows])
    folder = scratch_dir(spark, "test-huffman")
    index = huffman.write_files(huffman.token_table(docs, tokenizer_file(WORD)), folder)
    got = sorted(huffman.read_files(spark, index, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [d for d, _ in rows]
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([len(w) for w in want])])[:-1].tolist()
    flat = lambda lists: sorted(np.asarray(x, "<u4").tobytes() for x in lists)  # noqa: E731  rows of one id in any order
    assert sorted(bytes(r["ids"]) for r in got) == flat(want)
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["n_tokens"] == len(r["ids"]) // 4 for r in got)
    assert huffman.token_round_trip(docs.limit(0), tokenizer_file(WORD)).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id_are_spread_over_files(spark, doc_id):
    rows = [(doc_id, f"text {i} " * (i % 40)) for i in range(400)] + [(i, "other") for i in range(100, 120)]
    folder = scratch_dir(spark, "test-huffman")
    index = huffman.write_files(huffman.token_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), tokenizer_file(WORD)), folder)
    assert index.filter("docs > 0").count() > 1 and index.agg({"docs": "max"}).first()[0] < 300
    got = sorted(huffman.read_files(spark, index, folder).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(ids) == 420
    plain = Tokenizer.from_file(tokenizer_file(WORD))
    want = [zlib.crc32(np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()) for _, t in rows]
    assert sorted(r["ids_crc32"] for r in got) == sorted(want)


def test_best_fill_equals_brute_force():
    rnd = random.Random(6)
    for _ in range(150):
        lengths = sorted(rnd.sample(range(1, 30), 5), reverse=True)
        counts = np.zeros(64, np.int64)
        for x in lengths:
            counts[x] = rnd.randint(1, 3)
        room = rnd.randint(1, 63)
        sums = {0}
        for x in lengths:
            sums = {s + k * x for s in sums for k in range(int(counts[x]) + 1) if s + k * x <= room}
        got = packing._best_fill(lengths, counts, room)
        assert sum(k * v for k, v in got.items()) == max(sums) and all(v <= counts[k] for k, v in got.items())


@pytest.mark.parametrize("hot", [0, 100_000])
def test_plan_fills_every_window_but_the_last(hot):
    rnd = np.random.default_rng(7)
    capacity = 256
    histogram = np.concatenate([[0], rnd.integers(0, 40, capacity - 1)])
    histogram[190] += hot  # one length holds most pieces
    plan = packing.plan_windows(histogram, capacity)
    length = np.repeat(np.arange(capacity), histogram)
    n = np.concatenate([np.arange(h) for h in histogram])
    window, start, end = [], [], []
    total = np.zeros(len(length), np.int64)
    for which, done, gap, win, off in packing.place(plan, length, n):
        assert (total[which] == done).all()
        np.add.at(total, which, gap)
        window.append(win), start.append(off), end.append(off + gap)
    assert (total == length).all()
    window, start, end = map(np.concatenate, (window, start, end))
    by = np.lexsort((start, window))
    window, start, end = window[by], start[by], end[by]
    same = window[1:] == window[:-1]
    assert (start[1:][same] == end[:-1][same]).all() and (start[np.concatenate([[True], ~same])] == 0).all()
    filled = np.bincount(window, end - start)
    assert (np.sort(filled)[1:] == capacity).all() and len(filled) == plan["windows"] == -(-length.sum() // capacity)


def test_packing_covers_each_document(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted((np.asarray(w, "<u4").tobytes() for w in whole(BYTE, [t for _, t in rows])))
    frame = packing.pack_documents(docs, tokenizer_file(BYTE))
    got = frame.collect()
    assert all(r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] == len(r["ids"]) // 4 for r in got)
    windows = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == windows.get(r["sequence_id"], 0)
        windows[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(windows) == list(range(len(windows))) and max(windows.values()) <= 2048
    assert sum(v < 2048 for v in windows.values()) <= 1
    plain = {}
    for r in sorted(got, key=lambda r: r["start"]):
        if r["doc_id"] not in (0, None):
            plain[r["doc_id"]] = plain.get(r["doc_id"], b"") + r["ids"]
            assert len(plain[r["doc_id"]]) == 4 * (r["start"] + r["length"]) <= 4 * r["doc_tokens"]
    assert all(x in want for x in plain.values())
    assert sum(r["length"] for r in got) * 4 == sum(map(len, want))
    seqs = packing.sequences(frame).collect()
    assert {r["sequence_id"]: r["length"] for r in seqs} == windows and all(len(r["ids"]) == 4 * r["length"] for r in seqs)
    assert packing.pack_documents(docs.limit(0), tokenizer_file(BYTE)).count() == 0
