import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import attention_mil as M
from eventide.llm.words import BASE, byte_values

from .conftest import as_set, sentence


def loss(p, x, at, y, weight):
    s = M.forward(p, x, at)["score"]
    return float(-(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum())


def test_training_lowers_the_loss_and_finds_the_telling_passage():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 6, 200)
    at = np.concatenate([[0], np.cumsum(n)])
    x = rng.standard_normal((at[-1], 10)).astype(np.float32)
    y = rng.integers(0, 2, 200).astype(np.float32)
    telling = at[:-1] + [rng.integers(k) for k in n]
    x[telling, 0], x[telling, 1] = 4, 6 * y - 3
    p = M.fit(x, at, y, np.full(200, 1 / 200, np.float32))
    f = M.forward(p, x, at)
    assert ((f["score"] > 0.5) == y).mean() > 0.97
    assert np.allclose(np.add.reduceat(f["a"], at[:-1]), 1, atol=1e-4)
    several = n > 1
    assert (f["a"][telling] * n)[several].mean() > 1.2  # more than an even share


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = M.train(docs, labels.where(~M.held_out()))
    rows = M.scored(docs, model).join(labels.where(M.held_out()), "doc_id").collect()
    right = [(r.score >= 0.7) == (r.quality == 1) for r in rows]
    assert len(rows) > 60 and np.mean(right) > 0.93


def test_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 120)] + [(None, 1), (1, None), (3, 1), (3, 0)], "doc_id long, quality int")
    model = M.train(odd, labels)
    rows = M.scored(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1  # all are empty
    assert as_set(M.scored(clashing, model)) == as_set(M.scored(odd, model))
    assert M.scored(empty, model).collect() == []
    none = M.train(empty, labels.limit(0))
    assert none["params"] is None and {r.score for r in M.scored(odd, none).collect()} == {0.5}
    assert M.train(odd, labels.where("quality = 1"))["params"] is None
    assert M.train(empty, labels)["params"] is None


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % 2**64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def plain_passages(text):
    """Features of each passage, word by word and byte by byte."""
    body, values = text.encode(), [int(v) for v in byte_values(True)]
    words = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", body)]
    starts = [words[i][0] for i in range(0, len(words), M.PASSAGE_WORDS)] or [0]
    starts[0] = 0
    out = []
    for i, lo in enumerate(starts):
        classes, lengths, buckets = [0] * M.CLASSES, [0] * M.LENGTHS, [0] * M.WORD_BUCKETS
        for b in body[lo : starts[i + 1] if i + 1 < len(starts) else len(body)]:
            classes[M.BYTE_CLASS[b]] += 1
        held = words[i * M.PASSAGE_WORDS : (i + 1) * M.PASSAGE_WORDS]
        for s, e in held:
            lengths[min(e - s, M.LENGTHS) - 1] += 1
            buckets[mixed((sum(values[b] * pow(BASE, k, 2**64) for k, b in enumerate(body[s:e])) + e - s) % 2**64) % M.WORD_BUCKETS] += 1
        shares = [math.sqrt(n / max(sum(part), 1)) for part in (classes, lengths, buckets) for n in part]
        out.append((shares, len(held) / (len(held) + M.TRUST_WORDS)))
    return out


def plain_score(model, text):
    """Attention weights and score of one document, by loops."""
    p = {k: v.astype(float) for k, v in model["params"].items()}
    hidden, energy = [], []
    for shares, trust in plain_passages(text):
        x = [max(-6, min(6, (v - m) / s)) * trust for v, m, s in zip(shares, model["mean"], model["std"], strict=True)]
        h = [math.tanh(sum(a * w for a, w in zip(x, p["W"][:, j], strict=True)) + p["b"][j]) for j in range(M.HIDDEN)]
        gate = lambda w, k: sum(a * b for a, b in zip(h, p[w][:, k], strict=True))  # noqa: B023, E731
        energy.append(sum(math.tanh(gate("V", k)) / (1 + math.exp(-gate("U", k))) * p["w"][k] for k in range(M.ATTENTION)))
        hidden.append(h)
    weights = [math.exp(e - max(energy)) for e in energy]
    weights = [w / sum(weights) for w in weights]
    z = [sum(w * h[j] for w, h in zip(weights, hidden, strict=True)) for j in range(M.HIDDEN)]
    return weights, 1 / (1 + math.exp(-sum(a * b for a, b in zip(z, p["c"], strict=True)) - p["d"][0]))


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return M.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where(~M.held_out()))


def test_scores_equal_plain_python(spark, model):
    rng = random.Random(8)
    texts = ["", " \n", "one", "\t Two words!", "É é 中文 😀 " * 40, "x" * 3000, sentence(rng, 64), " " + sentence(rng, 65) + "\n", sentence(rng, 700), "### $$ " * 90]
    rows = M.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        weights, score = plain_score(model, texts[r.doc_id])
        assert r.n_passages == len(weights) and abs(r.score - score) < 1e-3, r
        assert weights[r.top_passage] >= max(weights) - 1e-4


def test_the_sample_is_bounded(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    whole = M.train(docs, labels)["params"]
    again = M.train(docs.union(docs).union(docs.select("doc_id", F.concat(F.lit("\U0010ffff"), "text").alias("text"), *docs.columns[2:])), labels)["params"]
    assert all(np.array_equal(whole[k], again[k]) for k in whole)  # a doc_id trains once, with its least text
    huge = docs.select("doc_id", F.repeat(F.concat("text", F.lit(" ")), 40).alias("text"))
    few = M.train(huge, labels, most_passages=400)
    assert few["params"] is not None and any(not np.array_equal(whole[k], few["params"][k]) for k in whole)
    assert M.train(docs, labels, most_passages=0)["params"] is None
