"""Quality classifier: gated-attention multiple-instance learning (operator 1).

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is
encoded (shares of byte classes, of word lengths and of hashed words, then a
learned tanh layer); gated attention (tanh and sigmoid branches) weighs the
passages; the weighted sum is scored by a logistic layer. Only documents have
labels; the weights of the passages are learned from them. Everything is
trained here, in numpy.

Training takes a bounded sample: at most ``PER_CLASS`` labelled documents of
each class, chosen by hash among the rows offered, encoded by the executors
from their whole texts, and of these, in the same order, whole documents up to
``PASSAGES`` passages a class. So what the driver fits on is bounded in documents
and in passages, however long texts are; a document that does not fit is left
to those that do. Classes are weighted by their share of all labels
offered, so scores are meant for the labels' own mix. Scoring encodes every
passage of every whole text.

Definitions: null and empty texts are one empty passage and get its score. With
no labels, or labels of one class, every score is the smoothed share of label
1. A doc_id with several labels counts by its least one; labels with a null id
or value are not used; of several texts it trains on the least one. Repeated
rows are scored one by one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept
from .words import SEPARATOR, Hasher, Texts, blocks, row_of, words_of

PASSAGE_WORDS = 64
PER_CLASS = 2500
PASSAGES = 200_000
WORD_BUCKETS = 64
TRUST_WORDS = 64
LENGTHS = 16
HIDDEN, ATTENTION = 24, 12
STEPS, RATE, DECAY = 200, 0.02, 1e-4


def byte_classes() -> np.ndarray:
    """Lower case, upper case, digits, separators, beyond ASCII; every other ASCII mark is its own class."""
    out = np.zeros(256, np.int64)
    out[65:91], out[48:58], out[SEPARATOR], out[128:] = 1, 2, 3, 4
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    out[marks] = 5 + np.arange(len(marks))
    return out


BYTE_CLASS = byte_classes()
CLASSES = int(BYTE_CLASS.max()) + 1
FEATURES = CLASSES + LENGTHS + WORD_BUCKETS


def passages(texts: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (the last column: trust in the others), and the passages' offsets by text (one at least)."""
    words = words_of(texts)
    n_words = np.diff(words.doc)
    n = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    at = np.concatenate([[0], np.cumsum(n)])
    total = int(at[-1])
    row = row_of(words.doc)
    passage = at[:-1][row] + (np.arange(len(row)) - words.doc[:-1][row]) // PASSAGE_WORDS
    # A byte belongs to the passage of the last word that began, a text's first bytes to its first.
    begun = np.zeros(len(texts.data), np.int64)
    begun[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = at[:-1][np.diff(texts.offsets) > 0]
    begun[words.start] = passage
    place = np.maximum.accumulate(begun) if len(begun) else begun

    def shares(cell: np.ndarray, where: np.ndarray, width: int) -> np.ndarray:
        counts = np.bincount(where * width + cell, minlength=total * width).reshape(total, width)
        return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    size = np.minimum(words.end - words.start, LENGTHS) - 1
    bucket = (hasher.ranges(texts.data, words.start, words.end) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    parts = [shares(BYTE_CLASS[texts.data], place, CLASSES), shares(size, passage, LENGTHS), shares(bucket, passage, WORD_BUCKETS)]
    held = np.bincount(passage, minlength=total)
    trust = held / (held + TRUST_WORDS)
    return np.column_stack([np.sqrt(np.concatenate(parts, axis=1)), trust]).astype(np.float32), at


def normal(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Deviations from the training mean, less for passages of few words: their shares are mostly chance."""
    return np.clip((x[:, :-1] - mean) / std, -6, 6) * x[:, -1:]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(p: dict[str, np.ndarray], x: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Attention weights and scores of the bags x[at[i]:at[i + 1]]."""
    h = np.tanh(x @ p["W"] + p["b"])
    v, u = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    e = (v * u) @ p["w"]
    bag, starts = row_of(at), at[:-1]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(h * a[:, None], starts)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "bag": bag, "score": sigmoid(z @ p["c"] + p["d"][0])}


def fit(x: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Full-batch Adam on the weighted log-loss; gradients written out."""
    rng = np.random.default_rng(seed)
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"W": draw(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, ATTENTION), "U": draw(HIDDEN, ATTENTION),
         "w": draw(ATTENTION), "c": draw(HIDDEN), "d": np.zeros(1, np.float32)}
    first, second = ({k: np.zeros_like(q) for k, q in p.items()} for _ in range(2))
    starts = at[:-1]
    for step in range(1, STEPS + 1):
        f = forward(p, x, at)
        d_score = (weight * (f["score"] - y)).astype(np.float32)
        d_z = d_score[:, None] * p["c"]
        d_a = (d_z[f["bag"]] * f["h"]).sum(axis=1)
        d_e = f["a"] * (d_a - np.add.reduceat(f["a"] * d_a, starts)[f["bag"]])
        d_g = d_e[:, None] * p["w"]
        d_v, d_u = d_g * f["u"] * (1 - f["v"] ** 2), d_g * f["v"] * f["u"] * (1 - f["u"])
        d_h = d_z[f["bag"]] * f["a"][:, None] + d_v @ p["V"].T + d_u @ p["U"].T
        d_x = d_h * (1 - f["h"] ** 2)
        grads = {"W": x.T @ d_x, "b": d_x.sum(axis=0), "V": f["h"].T @ d_v, "U": f["h"].T @ d_u, "w": (f["v"] * f["u"]).T @ d_e,
                 "c": f["z"].T @ d_score, "d": d_score.sum(keepdims=True)}
        for k, g in grads.items():
            g = g + DECAY * p[k] * (k not in "bd")
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            p[k] = (p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS,
          most_passages: int = PASSAGES) -> dict:
    """The model, from at most ``per_class`` labelled documents of each class with
    at most ``most_passages`` passages."""
    given = labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_y")).dropna()
    given = given.groupBy("_id").agg(F.min("_y").alias("_y")).where("_y in (0, 1)")
    counts = {r["_y"]: r["count"] for r in given.groupBy("_y").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    none = {"share": share, "params": None}
    if len(counts) < 2:
        return none
    sample = None
    for y in counts:  # a top-k by hash, at most per_class rows
        part = given.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        sample = part if sample is None else sample.union(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                x, at = passages(texts, hasher)
                cells = [x[at[i] : at[i + 1]].astype(np.float16).tobytes() for i in range(texts.n)]
                n = pa.array(np.diff(at).astype(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), n, pa.array(cells, pa.binary())], names=["_id", "_y", "n", "x"])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text"))
    picked = rows.join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
    coded = kept(picked.mapInArrow(run, "_id long, _y int, n long, x binary"))
    # Two classes of at most per_class narrow rows.
    so_far = F.sum("n").over(Window.partitionBy("_y").orderBy(F.xxhash64("_id"), "_id"))
    used = coded.select("_id", "_y", "n").where(F.col("n") <= most_passages).withColumn("so_far", so_far).where(F.col("so_far") <= most_passages)
    held = sorted((r["_id"], r["_y"], r["x"]) for r in coded.join(F.broadcast(used.select("_id")), "_id").collect())
    y = np.array([r[1] for r in held], np.float32)
    if not (0 < y.sum() < len(y)):
        return none
    bags = [np.frombuffer(r[2], np.float16).reshape(-1, FEATURES + 1) for r in held]
    at = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    x = np.concatenate(bags).astype(np.float32)
    mean, std = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-3
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()).astype(np.float32)
    return {"share": share, "mean": mean, "std": std, "params": fit(normal(x, mean, std), at, y, weight)}


def scored(docs: DataFrame, model: dict, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, n_passages, top_passage (the one that weighs most): one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = sent.value, Hasher(lower=True)
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                x, at = passages(texts, hasher)
                if model["params"] is None:
                    score, top = np.full(texts.n, model["share"]), np.zeros(texts.n, np.int64)
                else:
                    f = forward(model["params"], normal(x, model["mean"], model["std"]), at)
                    score = f["score"].astype(np.float64)
                    best = np.flatnonzero(f["a"] == np.maximum.reduceat(f["a"], at[:-1])[f["bag"]])
                    top = (best - at[:-1][f["bag"][best]])[np.searchsorted(f["bag"][best], np.arange(texts.n))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(score), pa.array(np.diff(at).astype(np.int64)), pa.array(top.astype(np.int64))],
                    names=["_id", "score", "n_passages", "top_passage"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, score double, n_passages long, top_passage long").withColumnRenamed("_id", id_column)


def held_out(id_column: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2: such rows never train."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
