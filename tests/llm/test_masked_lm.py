import numpy as np
import pyarrow as pa

from eventide.llm import masked_lm as M
from eventide.llm.words import Hasher, texts_of

from .conftest import as_set


def test_probabilities_of_all_entries_sum_to_one():
    p = M.start()
    ids = np.concatenate([[M.SIZE] * 2, np.arange(5), [M.SIZE] * 2]).astype(np.int32)
    total = 0.0
    for entry in range(M.SIZE):
        ids[4] = entry
        total += np.exp(M.log_probabilities(p, ids, np.array([4]))[0])
    assert abs(total - 1) < 1e-3


def test_a_token_is_never_its_own_evidence():
    p, ids = M.start(), np.arange(9, dtype=np.int32)
    a = M.forward(p, ids, np.array([4]))[5]
    ids[4] = 700
    assert np.allclose(a, M.forward(p, ids, np.array([4]))[5])


def test_learning_predicts_from_both_sides():
    rng = np.random.default_rng(1)
    seq = np.tile([3, 40, 77], 4000).astype(np.int32)
    seq[rng.integers(0, len(seq), 300)] = 5
    ids = np.concatenate([[M.SIZE] * 2, seq, [M.SIZE] * 2]).astype(np.int32)
    at = np.arange(2, len(seq) + 2)
    t = M.Trainer(M.start())
    before = M.log_probabilities(t.p, ids, at).mean()
    for _ in range(8):
        for lo in range(0, len(at), 2000):
            t.learn(ids, at[lo : lo + 2000])
    assert before < -6 and M.log_probabilities(t.p, ids, at).mean() > -0.6


def test_models_are_averaged_by_tokens(spark):
    size = len(M.flat(M.start())) // 4
    rows = [(i, 1 + i % 2, np.full(size, float(i), np.float32).tobytes()) for i in range(70)]
    models = spark.createDataFrame(rows, "id long, n long, model binary")
    expected = sum(i * (1 + i % 2) for i in range(70)) / sum(1 + i % 2 for i in range(70))
    assert np.allclose(M.averaged(models)["E"], expected, rtol=1e-4)


def test_scores_equal_a_plain_loop(spark, odd, odd_rows):
    model = M.train(odd)
    for r in M.scored(odd, model).where("doc_id in (1, 6, 9)").collect():
        text = next(t for i, t, *_ in odd_rows if i == r.doc_id)
        words = texts_of(pa.array([text]))
        ids, place, _ = M.laid_out(words, model["entry"], Hasher(lower=True))
        p, total = model["params"], 0.0
        for i in place:
            x = np.concatenate([p["E"][ids[i + d]] for d in (-2, -1, 1, 2)])
            h = np.tanh(x @ p["W"] + p["b"])
            k, j = divmod(int(ids[i]), M.SIZE // M.CLASSES)
            total += np.log(M.softmax((h @ p["C"] + p["c"])[None])[0, k]) + np.log(M.softmax((h @ p["T"][k] + p["t"][k])[None])[0, j])
        assert r.n_tokens == len(place) and abs(r.log_likelihood - total) < 1e-3 * len(place)


def test_training_helps_on_real_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = M.train(docs)
    plain = {"entry": model["entry"], "params": M.start()}
    mean = lambda m: M.scored(docs, m).selectExpr("sum(log_likelihood) / sum(n_tokens) AS m").first().m
    assert mean(model) > mean(plain) + 0.2


def test_every_token_is_trained_on(monkeypatch, odd):
    seen, averaged = [], M.averaged

    def counted(models, *rest):
        seen.append(models.agg({"n": "sum"}).first()[0])
        return averaged(models, *rest)

    monkeypatch.setattr(M, "averaged", counted)
    model = M.train(odd)
    assert len(seen) == M.ROUNDS
    assert sum(seen) == M.scored(odd, model).agg({"n_tokens": "sum"}).first()[0]


def test_probabilities_of_all_words_sum_to_one(spark, monkeypatch):
    """More words than entries, and more than the tasks know."""
    monkeypatch.setattr(M, "KNOWN", 2)
    rows = [(i, f"w{i}") for i in range(6000) for _ in range(1 + i % 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = M.train(docs)
    chance = {r.doc_id: np.exp(r.log_likelihood) for r in M.scored(docs, model).collect()}
    assert len(chance) == 6000 and abs(sum(chance.values()) - 1) < 1e-3
    counts = {r.word: r.n for r in model["counts"].collect()}
    assert len(counts) == 6000 and sum(counts.values()) == len(rows)
    # A text that the corpus never had, beside its most frequent words and a word seen once.
    others = spark.createDataFrame([(1, "w2 zzqx w0"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in M.scored(others, model).collect()) == [(1, 3), (2, 0)]


def test_entries_grow_with_the_corpus():
    assert M.size_of(0) == M.size_of(10**6) == M.SIZE < M.size_of(10**8) < M.size_of(10**12)
    p = M.start(size=4 * M.SIZE)
    assert len(p["E"]) == 4 * M.SIZE + 1 and p["t"].shape == (2 * M.CLASSES, 2 * M.SIZE // M.CLASSES)
    assert all(np.array_equal(v, p[k]) for k, v in M.unflat(M.flat(p), 4 * M.SIZE).items())


def test_rows(odd, clashing, empty):
    model = {"entry": np.zeros(M.CELLS, np.int32), "params": M.start()}
    rows = M.scored(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == 0 and r.log_likelihood == 0 and r.mean_log_probability == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert as_set(M.scored(clashing, model)) == as_set(M.scored(odd, model))
    assert M.scored(empty, model).collect() == []
    assert M.scored(empty, M.train(empty)).collect() == []
