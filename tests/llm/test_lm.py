import collections
import math

import numpy as np
from pyspark.sql import functions as F

from clausemill.llm import lm
from clausemill.llm.bytebpe import Encoder, vocabulary

SMALL = lm.Training(steps=40, batch=8)


def statistics(texts):
    stream = np.concatenate([np.append(t, lm.END_ID) for t in texts]).astype(np.int64)
    pairs, n = np.unique(np.concatenate([[lm.END_ID], stream[:-1]]) * lm.VOCABULARY + stream, return_counts=True)
    return lm.Vocabulary(np.bincount(stream, minlength=lm.VOCABULARY).astype(float), pairs, n.astype(float))


def sample(n, seed):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, 3000, rng.integers(0, 90)).astype(np.int32) for _ in range(n)]


def test_gradients():
    words = statistics(sample(30, 1))
    model = lm.Attention(4, 5, words.prior, 3)
    rng = np.random.default_rng(2)
    for k in model.p:
        model.p[k] = (model.p[k] + 0.1 * rng.normal(size=model.p[k].shape)).astype(np.float64)
    model.mask = model.mask.astype(np.float64)
    rows, klass, weight = rng.integers(0, 50, (3, lm.WINDOW)), rng.integers(0, lm.CLASSES, (3, lm.WINDOW)), (rng.random((3, lm.WINDOW)) < 0.8).astype(float)
    _, grads = model.step(rows, klass, weight)
    for k, g in grads.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in g.shape) if k != "emb" else (int(rows[0, 0]), int(rng.integers(0, g.shape[1])))
            held = model.p[k][at]
            model.p[k][at] = held + 1e-5
            up = model.step(rows, klass, weight)[0]
            model.p[k][at] = held - 1e-5
            down = model.step(rows, klass, weight)[0]
            model.p[k][at] = held
            assert math.isclose((up - down) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-6), k


def test_probabilities_sum_to_one():
    words = statistics(sample(50, 4))
    every = np.arange(lm.VOCABULARY)
    for before in (lm.END_ID, 5, 2999, 40_000):
        share = np.exp(words.shares(np.full(lm.VOCABULARY, before), every).astype(float))
        assert np.allclose(np.bincount(words.klass, share, lm.CLASSES), 1, atol=2e-3)


def test_windows_score_each_token_once():
    n = np.arange(1, 200)
    text, start, first = lm.windows(n)
    for k, m in enumerate(n):
        scored = [p for s, f in zip(start[text == k], first[text == k], strict=True) for p in range(s + f, min(s + lm.WINDOW, m))]
        assert scored == list(range(m))


def test_windows_overlap_by_half():
    _, start, first = lm.windows(np.arange(1, 200))
    assert all(f >= lm.WINDOW // 2 for s, f in zip(start, first, strict=True) if s > 0)
    assert lm.CLASSES >= 93 and lm.Training().width >= 16 and lm.Training().inner >= 32


def test_texts_are_coded_once(docs, monkeypatch):
    coded = lm._coded
    calls = []
    monkeypatch.setattr(lm, "_coded", lambda *a: calls.append(a) or coded(*a))
    lm.score(docs, F.lit(True), training=SMALL).collect()
    assert len(calls) == 1


def test_scorer_against_a_plain_one():
    texts = sample(40, 6)
    words = statistics(texts)
    model = lm.train(texts, words, SMALL)
    got = lm.Scorer(model, words, 7)(texts)
    for ids, score in zip(texts, got, strict=True):
        stream = [lm.END_ID, *ids.tolist(), lm.END_ID]
        total = 0.0
        for s, f in zip(*lm.windows(np.array([len(ids) + 1]))[1:], strict=True):
            part = stream[s : s + lm.WINDOW]
            for p in range(f, min(lm.WINDOW, len(ids) + 1 - s)):
                rows = np.full((1, lm.WINDOW), 0)  # later inputs must not matter
                rows[0, : p + 1] = words.row[part[: p + 1]]
                logits = model.forward(rows)[p].astype(float)
                total += logits[words.klass[stream[s + p + 1]]] - np.log(np.exp(logits).sum()) + float(words.shares(np.array([stream[s + p]]), np.array([stream[s + p + 1]]))[0])
        assert math.isclose(score, total / math.log(10), rel_tol=1e-4, abs_tol=1e-3)


def test_windows_to_learn_from_are_all_of_a_text():
    texts = [np.arange(n, dtype=np.int32) for n in (0, 1, 23, 24, 25, 31, 32, 33, 47, 5000)]
    for k, t in enumerate(texts):
        got, _ = lm.pieces([t], np.array([k * 77], np.uint64), 1.0)
        pairs = {(int(a), int(b)) for w in got for a, b in zip(w[:-1], w[1:], strict=True) if b != lm.PAD}
        stream = [lm.END_ID, *t.tolist(), lm.END_ID]
        assert pairs == set(zip(stream[:-1], stream[1:], strict=True))


def test_windows_to_learn_from_grow_with_the_table(spark, monkeypatch):
    drawn = []
    real = lm._improved
    start = lm.start
    monkeypatch.setattr(lm, "start", lambda pool, *a: drawn.append(len(pool)) or start(pool, *a))
    seen = spark.sparkContext.accumulator(0)

    def counted(held, how):
        work = real(held, how)

        def with_count(table):
            out = work(table)
            seen.add(out.column("n")[0].as_py())
            return out

        return with_count

    monkeypatch.setattr(lm, "_improved", counted)
    how, got = lm.Training(steps=2, batch=8, first=20, share=0.25, part=100), []
    for n in (40, 160):
        df = spark.range(n).selectExpr("id AS doc_id", "repeat(concat('some words ', id, ' '), 200) AS text")
        before = seen.value
        lm.score(df, F.lit(True), training=how).collect()
        got.append(seen.value - before)
    assert 3 < got[1] / got[0] < 5 and all(n < 60 for n in drawn)


def test_every_token_of_all_training_texts_is_learned_from(spark, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), lm._improved

    def counted(held, how):
        work = real(held, how)

        def with_count(table):
            data = np.concatenate([np.frombuffer(d, np.uint16) for d in table.column("data").to_pylist()])
            seen.add(int((data.reshape(-1, lm.WINDOW + 1)[:, 1:] != lm.PAD).sum()))
            return work(table)

        return with_count

    monkeypatch.setattr(lm, "_improved", counted)
    df = spark.range(120).selectExpr("id AS doc_id", "repeat(concat('some words ', id, ' '), 100) AS text").repartition(3)
    lm.score(df, F.col("doc_id") % 4 > 0, training=lm.Training(steps=2, batch=8, first=20, part=100)).collect()
    coder = Encoder(vocabulary())
    texts = [coder.ids(r["text"]) for r in df.collect() if r["doc_id"] % 4 > 0]
    assert 0 <= seen.value - sum(len(t) + 1 for t in texts) < lm.WINDOW * len(texts)  # a text's second window may overlap its first


def test_classes_probabilities_in_groups():
    assert [int(k) for k in np.bincount(lm.FIRST_OF)] == [1] * lm.OWN + list(lm.SIZES) + [1]
    words = statistics(sample(30, 1))
    model = lm.Attention(4, 5, words.prior, 3)
    rng = np.random.default_rng(2)
    rows, klass = rng.integers(0, 50, (3, lm.WINDOW)), rng.integers(0, lm.CLASSES, 3 * lm.WINDOW)
    logs = model.forward(rows)
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
    assert np.allclose(model.told(model._top(rows), klass), logs[np.arange(len(klass)), klass], atol=1e-5)


def test_adam_moves_all_weights_at_once_as_by_each():
    texts = sample(30, 1)
    words = statistics(texts)
    windows = lm.pieces(texts, np.arange(30, dtype=np.uint64), 1.0)[0]
    model, plain = (lm.Attention(16, 32, words.prior, 3) for _ in range(2))
    adam, m, v = lm.Adam(model), *({k: np.zeros_like(x) for k, x in plain.p.items()} for _ in range(2))
    for i in range(1, 6):
        part = windows[i * 8 : i * 8 + 8]
        adam(part, words.row, words.klass, 0.01)
        there = part != lm.PAD
        ids = np.where(there, part, lm.END_ID)
        rows = words.row[ids[:, :-1]]
        _, grads = plain.step(rows, words.klass[ids[:, 1:]], there[:, 1:].astype(np.float32))
        for k, g in grads.items():
            on = np.unique(rows) if k == "emb" else slice(None)
            m[k][on] = 0.9 * m[k][on] + 0.1 * g[on]
            v[k][on] = 0.99 * v[k][on] + 0.01 * g[on] ** 2
            plain.p[k][on] -= 0.01 * (m[k][on] / (1 - 0.9**i)) / (np.sqrt(v[k][on] / (1 - 0.99**i)) + 1e-6)
    for k, x in model.p.items():
        assert np.allclose(x, plain.p[k], atol=2e-4), k
        assert k == "emb" or np.shares_memory(x, adam.flat), k


def test_a_task_makes_products_of_weights_once(monkeypatch):
    texts = sample(12, 6)
    words = statistics(texts)
    ready, calls = lm.Attention.ready, []
    monkeypatch.setattr(lm.Attention, "ready", lambda self: calls.append(1) or ready(self))
    score = lm.Scorer(lm.Attention(16, 32, words.prior, 3), words)
    parts = [score(texts[k : k + 4]) for k in range(0, 12, 4)]
    assert len(calls) == 1 and np.allclose(np.concatenate(parts), score(texts), rtol=1e-6)


def test_training_helps():
    rng = np.random.default_rng(8)
    texts = [np.tile(rng.permutation(6) + 100, 12).astype(np.int32) for _ in range(60)]
    words = statistics(texts)
    before = lm.Scorer(lm.train(texts, words, lm.Training(steps=0)), words)(texts[:10]).sum()
    after = lm.Scorer(lm.train(texts[10:], words, lm.Training(steps=300, batch=16)), words)(texts[:10]).sum()
    assert after > 0.8 * before


def test_score(docs, no_docs):
    learn = F.col("doc_id").isNull() | (F.col("doc_id") != 9)
    got = lm.score(docs, learn, training=SMALL, carry=("doc_id", "text", "size")).collect()
    words = lambda t: [*(t or "").encode().lower().split(), "END"]
    counts = collections.Counter(w for r in docs.collect() if r["doc_id"] != 9 for w in words(r["text"]))
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == docs.count()
    for r in got:
        w = words(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0 and np.isfinite(r["score"])
    nothing = lm.score(docs, F.lit(False), training=SMALL).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in nothing)
    assert lm.score(no_docs, F.lit(True), training=SMALL).count() == 0


def test_classes_are_never_empty_and_put_like_ids_together():
    rng = np.random.default_rng(5)
    texts = [rng.permutation(np.arange(400) + 1000 * (k % 3)).astype(np.int32) for k in range(60)]  # three languages
    for words in (statistics(texts), statistics(sample(3, 1)), statistics([np.zeros(0, np.int32)])):
        assert (np.bincount(words.klass, minlength=lm.CLASSES) > 0).all()
    klass = statistics(texts).klass
    of = [set(klass[1000 * k : 1000 * k + 400].tolist()) - set(range(lm.OWN)) for k in range(3)]
    assert not of[0] & of[1] and not of[0] & of[2] and not of[1] & of[2]


def learned(sf):
    import zlib

    import pyarrow.parquet as pq

    rows = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    coder = Encoder(vocabulary())
    held = [r["text"] or "" for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    train = [r["text"] or "" for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2]
    return train, held, [coder.array(t) for t in train], [coder.array(t) for t in held]


def test_held_out_bits():
    """Of the fixed training texts, the held-out ones: below the word model's, and more than half a bit a subword from attention."""
    train, held, coded, asked = learned("/root/testdata/sf0.1")
    held, asked = held[::4], asked[::4]
    vocabulary_ = statistics(coded)
    model = lm.train(coded, vocabulary_, lm.Training())
    n = sum(len(t) + 1 for t in asked)
    bits = lambda: -lm.Scorer(model, vocabulary_)(asked).sum() / math.log10(2) / n
    words = lambda t: [*t.encode().lower().split(), "END"]
    counts = collections.Counter(w for t in train for w in words(t))
    total = sum(counts.values()) + len(counts) + 1
    base = -sum(math.log10((counts[w] + 1) / total) for t in held for w in words(t)) / math.log10(2) / n
    full = bits()
    model.p["out"] = np.zeros_like(model.p["out"])  # what attention reads reaches nothing
    without = bits()
    assert full < base and without - full > 0.5, (full, base, without)


def test_rare_pairs_meet_their_counts_in_bins(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(f"w{a} x{a * 7 % 40}" for a in rng.integers(0, 40, 30))) for k in range(50)] + [(50, None), (51, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = []
    for size in (4, lm.PAIRED):  # which pairs are in the table makes no difference
        monkeypatch.setattr(lm, "PAIRED", size)
        got.append({r["doc_id"]: r["score"] for r in lm.score(df, F.col("doc_id") % 5 > 0, training=SMALL).collect()})
    assert len(got[0]) == 52 and all(math.isclose(got[0][k], got[1][k], rel_tol=1e-5) for k in got[0])


def test_bins_follow_the_words(spark, monkeypatch):
    rows = [(k, " ".join(f"w{k * j % 50}" for j in range(30))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for size in (lm.BIN, 64):
        monkeypatch.setattr(lm, "BIN", size)
        got.append({r["doc_id"]: (r["n_known"], round(r["base_score"], 6), round(r["score"], 3)) for r in lm.score(df, F.col("doc_id") % 2 > 0, training=SMALL).collect()})
    assert got[0] == got[1]
    h = np.sort(np.random.default_rng(3).integers(0, 2**64, 3000, dtype=np.uint64))
    for bins in (1, 7, 70_000):
        assert (np.searchsorted(lm._bin_edges(bins), h, "right") - 1 == lm._bin_of(h, bins)).all()


def test_every_id_has_an_input_row():
    assert len(np.unique(statistics(sample(30, 1)).row)) == lm.VOCABULARY


def test_rare_words_meet_their_counts_in_bins(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAVY", 4)
    rows = [(k, " ".join(f"w{k * j % 50}" for j in range(30))) for k in range(60)]
    df = spark.createDataFrame([*rows, (0, rows[0][1])], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["base_score"] for r in lm.score(df, F.lit(True), training=SMALL).collect()}
    counts = collections.Counter(w for _, t in [*rows, rows[0]] for w in [*t.split(), "END"])
    total, distinct = sum(counts.values()), len(counts)
    for k, t in rows:
        assert math.isclose(got[k], sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*t.split(), "END"]), rel_tol=1e-9)
    assert Encoder(vocabulary()).ids("")  == []
