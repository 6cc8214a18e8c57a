"""Masked pseudo-likelihood of documents (operator 6).

A bidirectional window network, written and trained in numpy, predicts every
token from the ``WINDOW`` tokens on either side of it (never from itself): one
embedding table, a tanh layer, and a softmax in two steps, first the token's
class and then the token within it. A document's score is the sum of the
conditional log-probabilities of all its tokens.

* Tokens are words in ASCII lower case, known by their 64-bit hash. Their counts
  over the whole corpus are a distributed table. The number of entries grows
  with the cube root of the tokens: three quarters are the most frequent words,
  the other words share the last quarter by hash.
* A word in a shared entry is worth log P(entry) + log(its count / the entry's
  count), so that the score is a probability of the token. Every task has the
  counts of the ``KNOWN`` most frequent words an entry; a text's other words meet
  theirs in a join on the hash. A word that the corpus never had counts as
  seen once.
* Training is data-parallel over all documents: in each round every partition
  starts from the common parameters, trains on a slice of its positions, and
  the results are averaged, weighted by tokens, in groups of ``FAN_IN`` models
  until few are left. There are as many slices as rounds, so that every token
  is predicted once. The driver holds the parameters, never text.
* Scoring runs the network over every position of every whole text.

Null and empty texts have no tokens, a sum of 0 and a mean of 0. An empty corpus
leaves the network untrained and yields no rows. Repeated rows are scored one
by one; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept as stored
from .shared import one_thread
from .words import U64, Hasher, Texts, blocks, mix, words_of

CLASSES = 32
SIZE = CLASSES * 32  # entries of the smallest network; a multiple of CLASSES
GROWTH = 4  # entries per cube root of the tokens
KNOWN = 32
CELL_BITS = 16
CELLS = 1 << CELL_BITS  # of a plain table of entries
WINDOW = 2
EMBEDDING, HIDDEN = 16, 32
ROUNDS = 2
MINIBATCH = 4096
RATE = 0.1
FAN_IN = 64
GATHER_BYTES = 64 << 20  # of models in one average
HELD_WORDS = 1 << 20
LEVELS = 16  # of counts, per doubling


def hashes_of(texts: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts)
    return hasher.ranges(texts.data, words.start, words.end), words.doc


def found_in(entry: dict | np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry and log share of each word, and whether the share still lacks the
    word's log count. ``entry`` comes from ``vocabulary``, or is a plain table
    with the entry of each cell of hashes, and no shares."""
    if not isinstance(entry, dict):
        return entry[(hashes >> U64(64 - CELL_BITS)).astype(np.int64)], np.zeros(len(hashes)), np.zeros(len(hashes), bool)
    keys, totals = entry["keys"], entry["totals"]
    at = entry["first"][(hashes >> U64(65 - len(entry["first"]).bit_length())).astype(np.int64)]
    left = np.flatnonzero(keys[at] < hashes)
    while len(left):
        at[left] += 1
        left = left[keys[at[left]] < hashes[left]]
    entries, shares, rare = entry["entries"][at], entry["shares"][at], keys[at] != hashes
    shared = (hashes[rare] % U64(len(totals))).astype(np.int64)
    entries[rare] = entry["size"] - len(totals) + shared
    shares[rare] = -totals[shared]
    return entries, shares, rare


def text_rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """word (its hash), n: over all texts. Tasks count up to ``HELD_WORDS`` words at a time."""

    def merged(held: list) -> tuple[np.ndarray, np.ndarray]:
        words, at = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(at, np.concatenate([n for _, n in held]), len(words)).astype(np.int64)

    def counted(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(lower=True), []
        for batch in batches:
            for _, texts in blocks(batch, "_text"):
                held.append(np.unique(hashes_of(texts, hasher)[0], return_counts=True))
                if sum(len(w) for w, _ in held) > HELD_WORDS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_WORDS // 2:
                        yield counted(*held.pop())
        if held:
            yield counted(*merged(held))

    return stored(rows.select("_text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def size_of(tokens: int) -> int:
    size = SIZE
    while size < GROWTH * tokens ** (1 / 3):
        size *= 2
    return size


def vocabulary(rows: DataFrame) -> tuple[dict, DataFrame | None]:
    """The known words, and the counts of all words unless all are known.

    Known words: ``keys`` (hashes, rising, a sentinel last), their ``entries``
    and ``shares`` (log of the word's count / its entry's count); ``first`` key of
    each range of hashes; ``totals`` (log count) of the shared entries. The driver receives the counts of the known words and of the shared entries."""
    counts = word_counts(rows)
    level = F.floor(F.log2("n") * LEVELS)
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()
    size = size_of(sum(r["n"] for r in levels))
    shared, room, least = size // 4, KNOWN * size, None
    own = size - shared
    known = F.lit(True)
    for r in sorted(levels, key=lambda r: -r["level"]):
        if r["words"] > room:  # of the last level a part by hash
            part = F.pmod(F.shiftright("word", 20), F.lit(4096)) < 4096 * room // r["words"]
            known = (level > r["level"]) | ((level == r["level"]) & part)
            least = r["level"]
            break
        room -= r["words"]
    table = counts.where(known).toArrow()
    words, n = (table.column(c).to_numpy().astype(np.int64) for c in ("word", "n"))
    words = words.view(U64)
    bucket = (words % U64(shared)).astype(np.int64)
    order = np.lexsort((words, -n))
    entries = own + bucket
    entries[order[:own]] = np.arange(len(order[:own]))
    totals = np.zeros(shared, np.int64)
    for r in counts.groupBy(F.pmod("word", F.lit(shared)).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    np.subtract.at(totals, bucket[order[:own]], n[order[:own]])
    totals = np.log(np.maximum(totals, 1))
    shares = np.where(entries < own, 0.0, np.log(n) - totals[bucket])
    by = np.argsort(words)
    keys = np.append(words[by], U64(2**64 - 1))
    bits = max(1, (2 * len(keys)).bit_length())
    first = np.searchsorted(keys, np.arange(1 << bits, dtype=U64) << U64(64 - bits))
    found = {
        "keys": keys, "first": first, "entries": np.append(entries[by], own).astype(np.int32), "shares": np.append(shares[by], 0.0),
        "totals": totals, "size": size,
    }
    return found, None if least is None else counts


def classes_of(size: int) -> int:
    return CLASSES << ((size // SIZE).bit_length() - 1) // 2


def start(seed: int = 11, size: int = SIZE) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    wide, classes = 2 * WINDOW * EMBEDDING, classes_of(size)
    return {
        "E": draw(size + 1, EMBEDDING, scale=0.3),  # the last entry stands beyond a text's ends
        "W": draw(wide, HIDDEN, scale=wide**-0.5), "b": np.zeros(HIDDEN, np.float32),
        "C": draw(HIDDEN, classes, scale=0.1), "c": np.zeros(classes, np.float32),
        "T": draw(classes, HIDDEN, size // classes, scale=0.1), "t": np.zeros((classes, size // classes), np.float32),
    }


def flat(p: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([v.ravel() for v in p.values()]).astype(np.float32).tobytes()


def unflat(x: bytes | np.ndarray, size: int = SIZE) -> dict[str, np.ndarray]:
    x = np.frombuffer(x, np.float32) if isinstance(x, bytes | bytearray | memoryview) else x
    out, at = {}, 0
    for k, v in start(size=size).items():
        out[k] = x[at : at + v.size].reshape(v.shape).astype(np.float32)
        at += v.size
    return out


def blank_of(entry: dict | np.ndarray) -> int:
    return entry["size"] if isinstance(entry, dict) else SIZE


def in_a_row(entries: np.ndarray, doc: np.ndarray, blank: int) -> tuple[np.ndarray, np.ndarray]:
    """All tokens in a row with WINDOW blanks around each text; the places of the tokens."""
    n = len(doc) - 1
    place = np.arange(len(entries)) + WINDOW * (np.repeat(np.arange(n), np.diff(doc)) + 1)
    ids = np.full(len(entries) + WINDOW * (n + 1), blank, np.int32)
    ids[place] = entries
    return ids, place


def laid_out(texts: Texts, entry: dict | np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``in_a_row`` and the tokens' offsets by text."""
    hashes, doc = hashes_of(texts, hasher)
    return *in_a_row(found_in(entry, hashes)[0], doc, blank_of(entry)), doc


def softmax(x: np.ndarray) -> np.ndarray:
    """Of each row."""
    return column_softmax(x.T.copy()).T


def column_softmax(x: np.ndarray, scale: np.float32 = np.float32(1)) -> np.ndarray:
    """``scale`` times that of each column, in place: sums then run along whole rows."""
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x *= scale / x.sum(axis=0)
    return x


AROUND = [d for d in range(-WINDOW, WINDOW + 1) if d]


def forward(p: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray) -> tuple:
    """Context entries, their embeddings, the hidden layer (a column a position); positions come sorted by class with each class's run."""
    target, (classes, inner) = ids[at], p["t"].shape
    kind = (target // inner).astype(np.uint16)
    order = np.argsort(kind, kind="stable")
    at, target, kind = at[order], target[order], kind[order]
    around = np.stack([ids[at + d] for d in AROUND], axis=1)
    x = p["E"].take(around.ravel(), axis=0).reshape(len(at), -1)
    h = p["W"].T @ x.T
    h += p["b"][:, None]
    np.tanh(h, out=h)
    runs = np.searchsorted(kind, np.arange(classes + 1))
    return order, target % inner, kind, around, x, h, runs


def log_probabilities(p: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P(token | both sides) at each of the places ``at``."""
    out = np.empty(len(at), np.float64)
    for lo in range(0, len(at), 4 * MINIBATCH):
        part = at[lo : lo + 4 * MINIBATCH]
        order, inner, kind, _, _, h, runs = forward(p, ids, part)
        rows = np.arange(len(part))
        chance = column_softmax(p["C"].T @ h + p["c"][:, None])[kind, rows]
        for k in range(len(p["c"])):
            i, j = runs[k], runs[k + 1]
            if i < j:
                q = p["T"][k].T @ h[:, i:j]
                q += p["t"][k][:, None]
                chance[i:j] *= column_softmax(q)[inner[i:j], rows[: j - i]]
        log = np.log(np.maximum(chance, 1e-30))
        out[lo + order] = log
    return out


class Trainer:
    """Adagrad on the mean negative log-probability of minibatches."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in p.items()}
        self.seen = {k: np.full_like(v, 1e-4) for k, v in p.items()}

    def move(self, k: str, g: np.ndarray) -> None:
        """A gradient of zero moves nothing."""
        seen = self.seen[k]
        seen += g * g
        self.p[k] -= RATE * g / np.sqrt(seen)

    def learn(self, ids: np.ndarray, at: np.ndarray) -> None:
        p, share, ones = self.p, np.float32(1 / len(at)), np.ones(len(at), np.float32)
        _, inner, kind, around, x, h, runs = forward(p, ids, at)
        rows = np.arange(len(at))
        g = column_softmax(p["C"].T @ h + p["c"][:, None], share)
        g[kind, rows] -= share
        d_h = p["C"] @ g
        d_c = (h @ g.T, g @ ones)
        d_t = (np.zeros_like(p["T"]), np.zeros_like(p["t"]))
        for k in range(len(p["c"])):
            i, j = runs[k], runs[k + 1]
            if i < j:
                q = p["T"][k].T @ h[:, i:j]
                q += p["t"][k][:, None]
                column_softmax(q, share)[inner[i:j], rows[: j - i]] -= share
                d_h[:, i:j] += p["T"][k] @ q
                np.matmul(h[:, i:j], q.T, out=d_t[0][k])
                np.matmul(q, ones[: j - i], out=d_t[1][k])
        h *= h
        d = d_h * (1 - h)
        d_x = (d.T @ p["W"].T).reshape(-1, EMBEDDING)
        d_e = np.zeros_like(p["E"])
        met = around.ravel()
        # Numbers of 16 bits are sorted by radix.
        by = np.argsort(met.astype(np.uint16) if len(p["E"]) <= 1 << 16 else met, kind="stable")
        first = np.flatnonzero(np.diff(met[by], prepend=-1))
        d_e[met[by[first]]] = np.add.reduceat(d_x.take(by, axis=0), first, axis=0)
        self.move("T", d_t[0])
        self.move("t", d_t[1])
        self.move("C", d_c[0])
        self.move("c", d_c[1])
        self.move("W", (d @ x).T)
        self.move("b", d @ ones)
        self.move("E", d_e)


def averaged(models: DataFrame, size: int = SIZE) -> dict[str, np.ndarray] | None:
    """The mean of (id, n, model) rows weighted by n, in groups of FAN_IN, or of fewer large models."""
    fan = max(2, min(FAN_IN, GATHER_BYTES // len(flat(start(size=size)))))

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        n = group["n"].sum()
        total = sum(np.frombuffer(m, np.float32).astype(np.float64) * (w / n) for m, w in zip(group["model"], group["n"], strict=True))
        return pd.DataFrame({"id": [group["id"].iloc[0] // fan], "n": [n], "model": [total.astype(np.float32).tobytes()]})

    models = stored(models)
    while models.count() > fan:
        models = stored(models.groupBy(F.floor(F.col("id") / fan)).applyInPandas(mean, models.schema))
    left = models.orderBy("id").collect()  # ``fan`` networks at most
    n = sum(r["n"] for r in left)
    if not n:
        return None
    return unflat(sum(np.frombuffer(r["model"], np.float32) * np.float32(r["n"] / n) for r in left), size)


def train(docs: DataFrame, id_column: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> dict:
    """The network and its vocabulary, from all documents: round ``turn`` trains on slice ``turn`` of ``rounds``."""
    rows = text_rows(docs, id_column, text)
    entry, counts = vocabulary(rows)
    params = start(size=entry["size"])
    sc = docs.sparkSession.sparkContext
    for turn in range(rounds):
        sent = sc.broadcast((entry, params, turn))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            one_thread()
            entry, params, turn = sent.value
            hasher, trainer, seen = Hasher(lower=True), Trainer(params), 0
            for batch in batches:
                for _, texts in blocks(batch, "_text"):
                    ids, place, _ = laid_out(texts, entry, hasher)
                    place = place[mix(np.arange(len(place), dtype=U64)) % U64(rounds) == U64(turn)]
                    for lo in range(0, len(place), MINIBATCH):
                        trainer.learn(ids, place[lo : lo + MINIBATCH])
                    seen += len(place)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([flat(trainer.p)], pa.binary())], names=["n", "model"])

        models = rows.select("_text").mapInArrow(run, "n long, model binary")
        params = averaged(models.select(F.spark_partition_id().cast("long").alias("id"), "n", "model"), entry["size"]) or params
    return {"entry": entry, "params": params, "counts": counts}


def scored(docs: DataFrame, model: dict, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum), mean_log_probability: one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast((model["entry"], model["params"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        (entry, params), hasher = sent.value, Hasher(lower=True)
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                hashes, doc = hashes_of(texts, hasher)
                entries, shares, rare = found_in(entry, hashes)
                ids, place = in_a_row(entries, doc, blank_of(entry))
                log = np.concatenate([[0.0], np.cumsum(log_probabilities(params, ids, place) + shares)])
                offsets = np.concatenate([[0], np.cumsum(rare)])[doc]
                words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(doc).astype(np.int64)), pa.array(log[doc[1:]] - log[doc[:-1]]), words],
                    names=["_id", "n_tokens", "log_likelihood", "_rare"],
                )

    rows = text_rows(docs, id_column, text)
    found = rows.mapInArrow(run, "_id long, n_tokens long, log_likelihood double, _rare array<long>")
    total = F.col("log_likelihood")
    if model.get("counts") is not None:
        found = stored(found.withColumn("_row", F.monotonically_increasing_id()))
        words = found.select("_row", F.explode("_rare").alias("word")).join(model["counts"], "word", "left")
        gained = words.groupBy("_row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)))).alias("_gained"))
        found = found.drop("_rare").join(gained, "_row", "left")
        total = total + F.coalesce("_gained", F.lit(0.0))
    mean = total / F.greatest("n_tokens", F.lit(1))
    return found.select(F.col("_id").alias(id_column), "n_tokens", total.alias("log_likelihood"), mean.alias("mean_log_probability"))
