"""Quality, toxicity and language model: held-out figures, brute force, odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlens.llm import lbl, quality, toxicity
from fundlens.llm.common import read_table

SF = "/root/testdata/sf0.01"
EMPTY_LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return read_table(spark, SF, "labels")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "some words here"), (3, "x" * 300_000), (4, "\n\n \t"), (5, "idiot trash moron scum")]
    return spark.createDataFrame([(*r, 9, 0.5) for r in rows], "doc_id long, text string, held_out int, score double")


def _auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    good = y == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_quality_tells_held_out_rows_apart(docs, labels, odd):
    model = quality.train(docs, labels)
    got = quality.score_quality(docs, model).join(labels, "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in held["doc_id"]]).all()
    assert _auc(held["quality"].to_numpy(), held["score"].to_numpy()) > 0.97
    assert (held[held["quality"] == 1]["predicted"] == 1).mean() > 0.97
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_pair_tables_learn_an_interaction():
    rnd = np.random.default_rng(0)
    x = rnd.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y, rounds=20, n_pairs=2)
    assert {0, 1} in [{a, b} for a, b, _ in model.pairs]
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_quality_without_labels_or_with_one_class(spark, docs, labels):
    none = quality.train(docs, spark.createDataFrame([], EMPTY_LABELS))
    assert {r["score"] for r in quality.score_quality(docs.limit(20), none).collect()} == {0.5}
    one = quality.train(docs, labels.filter("quality = 1"))
    assert all(r["score"] > 0.9 for r in quality.score_quality(docs.limit(20), one).collect())
    assert quality.score_quality(docs.limit(0), one).count() == 0


def test_chain_feeds_earlier_categories_to_later_ones():
    rnd = np.random.default_rng(1)
    x = (rnd.random((4000, 6)) < 0.3).astype(float)
    first = (x[:, 0] + x[:, 1] > 0).astype(float)
    second = first * x[:, 2]
    chain = toxicity.fit_chain(x, np.stack([first, second], 1), np.arange(4000) % 5, list("abcdef"), ["one", "two"])
    assert [len(w) for w in chain.weights] == [7, 8]  # the second has a weight for the first's probability
    p = chain.predict(x)
    assert ((p[:, 1] > 0.5) == (second == 1)).mean() > 0.97
    assert abs(chain.weights[1][6]) > 0.5


def test_sparse_logistic_equals_dense_newton_steps():
    rnd = np.random.default_rng(4)
    x = (rnd.random((600, 40)) < 0.1).astype(float)
    y = (x[:, 0] + x[:, 1] + (rnd.random(600) < 0.1) > 0).astype(float)
    w = toxicity.logistic(x, y, ridge=0.3)
    z, penalty, want = np.hstack([x, np.ones((600, 1))]), np.full(41, 0.3), np.zeros(41)
    penalty[-1] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ want))
        want += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * want)
    assert np.allclose(w, want, atol=1e-6) and np.allclose(toxicity.logistic(x, y, start=want + 0.5), want, atol=1e-6)


def test_toxicity_scores_equal_the_chain_applied_by_hand(spark, docs, labels, odd):
    chain = toxicity.train(docs, labels)
    texts = docs.select("doc_id", "text").limit(40).unionByName(odd.select("doc_id", "text"))
    got = {}
    for r in toxicity.score_toxicity(texts, chain).collect():
        got.setdefault(r["doc_id"], []).append([r[f"p_{n}"] for n in chain.names])
    for r in texts.collect():
        words = set(re.findall(r"[^\W_]+", (r["text"] or "").lower()))
        own = words | {w[:n] + "*" for w in words for n in toxicity.STEMS if len(w) > n}
        has, earlier = [bool(own & set(f.split(" "))) for f in chain.words], []
        for w in chain.weights:
            z = sum(a for a, h in zip(w, has, strict=False) if h) + sum(a * p for a, p in zip(w[len(has):], earlier, strict=False)) + w[-1]
            earlier.append(1 / (1 + math.exp(-z)))
        assert any(np.allclose(p, earlier, atol=1e-9) for p in got[r["doc_id"]])


def test_folds_as_tasks_equal_folds_in_turn(spark):
    rnd = np.random.default_rng(6)
    x = (rnd.random((300, 8)) < 0.3).astype(float)
    y = np.stack([x[:, 0], x[:, 0] * x[:, 1]], 1)
    a, b = (toxicity.fit_chain(x, y, np.arange(300) % 5, list("abcdefgh"), ["one", "two"], s) for s in (None, spark))
    assert all(np.allclose(u, v, atol=1e-8) for u, v in zip(a.weights, b.weights, strict=True))


def test_toxic_rows_are_caught_and_clean_ones_left(spark, docs, labels, odd):
    chain = toxicity.train(docs, labels)
    got = toxicity.score_toxicity(docs, chain).join(labels, "doc_id").toPandas()
    held = got[[zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]]
    assert (held[held["toxic"] == 0]["predicted"] == 0).mean() > 0.97
    assert (held[held["toxic"] == 1]["predicted"] == 1).mean() >= 0.5
    assert {"p_abusive", "p_repeated", "p_toxic", "score", "predicted"} < set(got.columns)
    rows = {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(odd, chain).collect()}
    assert rows == {1: 0, 2: 0, None: 0, 3: 0, 4: 0, 5: 1}
    none = toxicity.train(docs, spark.createDataFrame([], EMPTY_LABELS))
    assert toxicity.score_toxicity(docs.limit(5), none).count() == 5
    assert toxicity.score_toxicity(docs.limit(0), chain).count() == 0


def test_language_model_counts_and_held_out_gain(docs):
    got = lbl.score_texts(docs).toPandas()
    counts, found = Counter(), {}
    for r in docs.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
        found[r["doc_id"]] = [*re.findall(r"[^\x20\x09-\x0D]+", low), None]
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1:
            counts.update(found[r["doc_id"]])
    total, distinct = sum(counts.values()), len(counts)
    for r in got.itertuples():
        own = found[r.doc_id]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert abs(r.base_score - base) < 1e-9 * abs(base)
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def _chances(model, before):
    """P(unit) of every unit behind the given units, oldest first, by the definition."""
    h = [sum(model.seen[u][d] * model.place[i][d] for i, u in enumerate(before[::-1])) for d in range(lbl.WIDTH)]

    def shares(vectors):
        e = np.exp(np.array([np.dot(v[:-1].astype(float), h) + v[-1] for v in vectors]))
        return e / e.sum()

    ends = [*model.starts, model.units]
    return np.concatenate([top * shares(model.next[a:b]) for top, a, b in zip(shares(model.group), ends[:-1], ends[1:], strict=True)])


def _random_model(words, seed):
    rows = np.random.default_rng(seed).normal(0, 0.3, lbl.Model.start(words).shape).astype(np.float32)
    model = lbl.Model(rows, words.starts)
    model.seen[:, -1] = model.place[:, -1] = 0
    return model


def test_probabilities_add_up_to_one():
    words = lbl.Vocabulary([(f"w{i}".encode(), 1000 - i) for i in range(600)], {k: 500.0 + (400_000 if k == 48 else 9000) for k in range(lbl.TAIL)}, 10, 5)
    model, k = _random_model(words, 2), 600 + lbl.TAIL
    assert model.units == k and len(model.rows) == 2 * k + 1 + lbl.CONTEXT + len(words.starts)
    for before in ([k, k, k, k], [k, k, 5, 0], [601, 1, 2, 599]):
        h = model.context(model.seen[[*before, 0]])[lbl.CONTEXT:]
        p = np.exp(model.log_probabilities(np.repeat(h, k, axis=0), np.arange(k)))
        assert abs(p.sum() - 1) < 1e-5 and np.allclose(p, _chances(model, before), rtol=1e-3)
    far = model.log_probabilities(np.full((k, lbl.WIDTH + 1), 60, np.float32), np.arange(k))  # scores beyond what exp holds
    assert np.isfinite(far).all() and abs(np.exp(far).sum() - 1) < 1e-3


def test_scores_are_those_of_the_definition(spark):
    texts = ["alpha beta  Gamma alpha\nbeta", "", "delta alpha unknown1 unknown2", " gamma\tbeta\x0bBETA \u00c4x", "alpha"] * 3
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = lbl.vocabulary(lbl.token_counts(frame.filter("doc_id < 10")))
    model = _random_model(words, 4)
    file = lbl.shared_file(spark, "test-model", (words.shares(), model.rows))
    got = lbl.encoded(frame, words).mapInArrow(lambda b: lbl._score(b, file), lbl._SCORED_DDL).collect()
    assert len(got) == len(texts)
    for r in got:
        units = [words.index.index(t) if t in words.index else words.own + lbl.tail_class(t) for t in lbl.tokens(texts[r["doc_id"]])]
        run, want = [model.units] * lbl.CONTEXT + units, 0.0
        for i, u in enumerate(units):
            want += math.log10(_chances(model, run[i:i + lbl.CONTEXT])[u]) - (math.log10(words.mass[u - words.own]) if u >= words.own else 0)
        assert abs(r["model"] - want) < 1e-3 * abs(want) and r["n_tokens"] == len(units)


def test_tokens_in_arrow_are_those_of_the_definition():
    texts = ["", None, " A\tb\x0b\x0cC\r\n\u00c4 x y ", "x", "  ", "\u0130 q\x85r\u00a0s\x1ft", "long " * 5000]
    found, lengths = lbl.token_runs(pa.array(texts))
    assert found.to_pylist() == [t for x in texts for t in lbl.tokens(x or "")]
    assert lengths.tolist() == [len(lbl.tokens(x or "")) for x in texts]


def test_units_of_texts_and_counts_of_rarer_tokens(docs):
    words = lbl.vocabulary(lbl.token_counts(docs))
    unit = {t: i for i, t in enumerate(words.index)}
    texts = {r["doc_id"]: lbl.tokens(r["text"] or "") for r in docs.collect()}
    for r in lbl.encoded(docs.select("doc_id", "text"), words).limit(200).collect():
        own = texts[r["doc_id"]]
        assert np.frombuffer(r["units"], np.int32).tolist() == [unit.get(t, words.own + lbl.tail_class(t)) for t in own]
        assert {(bytes(x["token"]), x["tf"]) for x in r["rare"]} == set(Counter(t for t in own if t not in unit).items())
        assert r["n_own"] == sum(t in unit for t in own)


def test_language_model_on_odd_rows(odd, spark):
    got = lbl.score_texts(odd, rounds=1).collect()
    assert len(got) == 7 and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert lbl.score_texts(odd.limit(0)).count() == 0
    held = odd.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1)
    assert all(r["train_tokens"] == 0 for r in lbl.score_texts(held).collect())


def test_frequent_tokens_have_vectors_of_their_own_and_units_add_up_to_one(docs):
    words = lbl.vocabulary(lbl.token_counts(docs))
    counts = Counter(t for r in docs.collect() for t in lbl.tokens(r["text"] or ""))
    often = [t for t, c in counts.items() if c >= 8]
    assert len(often) > lbl.TOP + lbl.TAIL
    assert len(set(words.numbers(pa.array(often)).tolist())) == len(often)
    model, k = _random_model(words, 3), len(words.noise)
    h = model.context(model.seen[[k - 1, 5, k, 0, 0]])[lbl.CONTEXT:]
    p = np.exp(model.log_probabilities(np.repeat(h, k, axis=0), np.arange(k)))
    assert model.units == k and abs(p.sum() - 1) < 1e-4


def test_what_one_task_learned_of_a_token_is_not_averaged_away(spark):
    rows = [(i, "alpha beta" if i < 10 else "gamma delta") for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(4, "doc_id")
    words = lbl.vocabulary(lbl.token_counts(texts))
    flat, start = lbl.train(lbl.encoded(texts, words), words, 1), lbl.Model.start(words)
    moved = np.abs(lbl.Model(flat, words.starts).next - lbl.Model(start, words.starts).next).max(axis=1)
    unit = {t: words.index.index(t.encode()) for t in ("beta", "delta")}
    assert np.isfinite(flat).all() and moved[unit["beta"]] > 0.1 * moved[unit["delta"]] > 0


def test_every_telling_word_is_a_mark_and_words_with_the_same_rows_are_one_feature(spark):
    rude = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}rude" for i in range(60)]
    rows = [(i, f"{rude[i % 60]}ness plain words", 1) for i in range(900)] + [(900 + i, "plain words only", 0) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), hold_out=None)
    marks = {w for own in chain.words for w in own.split(" ")}
    assert {f"{r}ness" for r in rude} <= marks and len(marks) > 192
    assert len(chain.words) == len(rude) + 1  # "only" speaks for the other label
    new = spark.createDataFrame([(i, f"some {r}nessy text") for i, r in enumerate(rude)], "doc_id long, text string")
    assert {r["predicted"] for r in toxicity.score_toxicity(new, chain).collect()} == {1}


def test_rounds_build_on_what_other_tasks_learned(docs):
    many = docs.repartition(12)

    def held_out(**rounds):
        return lbl.score_texts(many, **rounds).filter("held_out").agg(F.sum("score").alias("s")).first()["s"]

    assert lbl.ROUNDS > 1 and held_out() > held_out(rounds=1)


def test_sums_of_runs_and_weighted_sums_are_the_plain_ones():
    rng = np.random.default_rng(4)
    values, first = rng.normal(size=(300, 5)).astype(np.float32), np.array([0, 1, 3, 6, 10, 15, 100, 299])
    assert np.allclose(lbl._sums(values, first), [values[a:b].sum(axis=0) for a, b in zip(first, [*first[1:], 300], strict=True)], atol=1e-4)
    own, by = lbl._sorted(np.array([3, 1, 3, 0, 1], np.int32))
    assert own.tolist() == [0, 1, 1, 3, 3] and by.tolist() == [3, 1, 4, 0, 2]
    rows, weights = rng.normal(size=(3 * lbl.FLAT + 9, 5)).astype(np.float32), rng.normal(size=(3, 5)).astype(np.float32)
    for n in (0, 1, lbl.FLAT, 3 * lbl.FLAT + 5):
        out = np.empty((n, 5), np.float32)
        lbl._weighted(rows, weights, range(3, 0, -1), out)
        assert np.allclose(out, sum(rows[s:s + n] * weights[i] for i, s in enumerate((3, 2, 1))), atol=1e-5)


def _plain_gradients(trainer, run, fake, noise):
    """What a step adds up for every vector, token by token: ``fake`` are its noise groups, ``noise`` the noise units by group."""
    m = trainer.model
    grad = {name: np.zeros(getattr(m, name).shape) for name in ("seen", "place", "next", "group")}

    def chance(score):
        return 1 / (1 + np.exp(-score))

    for t in range(lbl.CONTEXT, len(run)):
        u = run[t]
        if u >= m.units:
            continue
        before = [run[t - i - 1] for i in range(lbl.CONTEXT)]
        h, g = sum(m.seen[b].astype(float) * m.place[i] for i, b in enumerate(before)), m.of[u]
        h[-1] = 1
        back = np.zeros(lbl.WIDTH + 1)
        pairs = [("group", g, 1, trainer.log_groups[g]), ("next", u, 1, trainer.log_noise[u])]
        pairs += [("group", f, 0, trainer.log_groups[f]) for f in fake] + [("next", f, 0, trainer.log_noise[f]) for f in noise[g]]
        for name, row, real, log_share in pairs:
            vector = getattr(m, name)[row].astype(float)
            off = real - chance(h @ vector - log_share)
            grad[name][row] += off * h
            back += off * vector
        back[-1] = 0
        for i, b in enumerate(before):
            grad["seen"][b] += back * m.place[i]
            grad["place"][i] += back * m.seen[b] / lbl.CONTEXT
    return grad


def test_a_step_adds_up_what_every_token_adds(monkeypatch):
    words = lbl.Vocabulary([(f"w{i}".encode(), 1000 // (i + 1) + 1) for i in range(600)], {k: 9.0 for k in range(lbl.TAIL)}, 10, 5)
    rng = np.random.default_rng(6)
    start = lbl.Model.start(words)
    start[:, :-1] += rng.normal(0, 0.3, (len(start), lbl.WIDTH))
    trainer = lbl.Trainer(start, words, 0.1, 0)
    k = trainer.model.units
    texts = [rng.choice(k, n, p=words.noise).astype(np.int32) for n in (700, 1, 40, 300)]
    run = lbl.padded(texts, k)
    fake = rng.choice(len(words.starts), lbl.NOISE)
    noise = {g: rng.integers(a, b, lbl.NEAR_NOISE) for g, (a, b) in enumerate(zip(words.starts, [*words.starts[1:], k], strict=True))}
    monkeypatch.setattr(trainer, "rng", type("Rng", (), {"choice": staticmethod(lambda *_, **__: fake)}))
    monkeypatch.setattr(trainer, "_noise_units", lambda of: np.array([noise[g] for g in of]))
    want = _plain_gradients(trainer, run, fake, noise)
    got = {name: np.zeros(x.shape) for name, x in want.items()}

    def move(name, rows, grad):
        assert len(set(rows.tolist())) == len(rows)
        got[name][rows] = grad

    monkeypatch.setattr(trainer, "_move", move)
    trainer.step(run)
    for name, own in want.items():
        if name in ("next", "group"):  # context units and positions have no bias
            assert np.allclose(got[name], own, atol=2e-3), name
        else:
            assert np.allclose(got[name][:, :-1], own[:, :-1], atol=2e-3), name


def test_rare_tokens_meet_their_counts_without_a_sort(spark, docs):
    plan = lbl.score_texts(docs.limit(200), rounds=1)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [token" in plan and "SortMergeJoin [token" not in plan
