"""Importance resampling towards a target distribution (operator 11).

Features are runs of consecutive words; each falls into a bucket by the crc32 of
its bytes. A bucket's gain is the log ratio of its smoothed shares in the target
and in the documents, and a text's weight the sum of its features' gains, looked
up in one array. Gumbel noise from the document's id turns "draw without
replacement, in proportion to exp(weight)" into "take the highest scores".

The highest scores come from a distributed radix sort, least significant digit
first. The composite key is (score falling, doc_id rising with nulls last,
n_features); bits that all rows share are left out of it. Every pass is a stable
counting sort on one digit: rows are counted by digit and block of places, the
counts' prefix sums say where each (digit, block) begins, and a row's place
inside it is its number among the block's rows of that digit. So every row
computes its own destination; after the last pass that is its rank. A task
holds the rows of one digit in one block, ``BLOCK_ROWS`` at most, whatever keys are
frequent. Between passes the narrow rows are stored.

Words are runs of ASCII letters, digits and non-ASCII characters, in ASCII lower
case. Null and empty texts have no features and weight 0. A null doc_id is drawn
with the noise of the text "null". Repeated rows are rows of their own, one
rank each; ties that the key leaves are between equal rows. Texts with fewer
words than ``least_words`` are never drawn. Memory does not grow with a text but
for four bytes a feature. Empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, kept

BUCKETS = 10_000
SEED = 2024
DIGIT_BITS = 12
BLOCK_BITS = 17
BLOCK_ROWS = 1 << BLOCK_BITS
PIECE_BYTES = 1 << 20
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data, at = text.encode().lower(), 0  # bytes.lower: A-Z only
    while at < len(data):
        to = at + PIECE_BYTES
        inside = WORD.match(data, to)
        to = inside.end() if inside else to
        yield WORD.findall(data, at, to)
        at = to


def features(found: list[bytes], before: deque[bytes]) -> Iterator[bytes]:
    """All runs of words that end in ``found``, as long as ``before`` holds; it keeps the words before."""
    for word in found:
        before.append(word)
        run = b""
        for part in reversed(before):
            run = part + b" " + run if run else part
            yield run


def buckets_of(text: str | None, longest: int, buckets: int) -> np.ndarray:
    """The bucket of each feature: a run of 1 to ``longest`` words."""
    before: deque[bytes] = deque(maxlen=longest)
    runs = (found if longest == 1 else list(features(found, before)) for found in words(text or ""))
    crcs = [np.fromiter(map(crc32, found), np.uint32, len(found)) for found in runs]
    return (np.concatenate(crcs) if crcs else np.empty(0, np.uint32)) % np.uint32(buckets)


def words_in(n_features: int, longest: int) -> int:
    """Words of a text with so many runs of up to ``longest`` words."""
    short = (math.isqrt(8 * n_features + 1) - 1) // 2
    return short if short < longest else (n_features + longest * (longest - 1) // 2) // longest


def bucket_counts(rows: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket. Each task sends one count a bucket; the driver gets ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = buckets_of(value.as_py(), longest, buckets)
                if len(found) < buckets // 8:
                    np.add.at(total, found, 1)
                else:
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = rows.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / source share)) of each bucket, counts plus one."""
    buckets = len(source)
    s_all, t_all = float(source.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int, id_column: str, text: str) -> DataFrame:
    """_id, n_features, n_words, weight: one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            rows = [buckets_of(v.as_py(), longest, len(gain)) for v in batch.column(1)]
            n = [len(r) for r in rows]
            words = pa.array([words_in(k, longest) for k in n], pa.int64())
            weight = pa.array([int(gain[r].sum()) for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), words, weight], names=["_id", "n_features", "n_words", "weight"])

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, n_features long, n_words long, weight long")


def noise(key: Column, seed: int) -> Column:
    """floor(1000 times Gumbel noise) from the sha256 of "seed:key"."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def digits(rows: DataFrame, key: list[Column]) -> list[Column]:
    """The digits of a composite key, least significant first.

    ``key`` lists the fields from the most significant one on, each a long read as
    unsigned. Of a field, only the bits from its lowest to its highest varying
    one count; the fields' bits in a row are cut into DIGIT_BITS each."""
    seen = rows.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(key) for n, f in (("any", F.bit_or), ("all", F.bit_and))]).first()
    parts: list[Column] = []
    fields, offset = [], 0
    for i in reversed(range(len(key))):
        varying = ((seen[f"any{i}"] or 0) & ~(seen[f"all{i}"] or 0)) & (2**64 - 1)
        if varying:
            low = (varying & -varying).bit_length() - 1
            width = varying.bit_length() - low
            fields.append((key[i], low, offset, width))
            offset += width
    for begin in range(0, offset, DIGIT_BITS):
        digit = F.lit(0).cast("long")
        for column, low, at, width in fields:
            lo, hi = max(begin, at), min(begin + DIGIT_BITS, at + width)
            if lo < hi:
                bits = F.shiftrightunsigned(column, low + lo - at).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
                digit = digit.bitwiseOR(F.shiftleft(bits, lo - begin))
        parts.append(digit)
    return parts


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with ``_at``, their places, moved to a stable order by ``digit``."""
    dealt = rows.withColumn("_digit", digit).withColumn("_block", F.shiftright("_at", BLOCK_BITS))
    cell = ["_digit", "_block"]
    counts = dealt.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = lambda w: F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counts.select(*cell, earlier(Window.partitionBy("_digit").orderBy("_block")).alias("_before"))
    # One row a digit: 2**DIGIT_BITS at most in one window.
    begins = counts.groupBy("_digit").agg(F.sum("_rows").alias("_rows")).select("_digit", earlier(Window.orderBy("_digit")).alias("_begin"))
    starts = blocks.join(F.broadcast(begins), "_digit").select(*cell, (F.col("_begin") + F.col("_before")).alias("_start"))
    inside = dealt.withColumn("_inside", F.row_number().over(Window.partitionBy(*cell).orderBy("_at")) - 1)
    moved = inside.join(starts, cell)
    return moved.select(*[c for c in rows.columns if c != "_at"], (F.col("_start") + F.col("_inside")).cast("long").alias("_at"))


def radix_sorted(rows: DataFrame, key: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with ``_at``: 0, 1, 2, ... in the order of ``key`` (see ``digits``)."""
    rows = scratch.written(rows.withColumn("_at", F.monotonically_increasing_id()))
    passes = digits(rows, key)
    # A key that is the same in all rows needs one pass to close the gaps.
    for digit in passes or [F.lit(0).cast("long")]:
        rows = scratch.written(counting_pass(rows, digit))
    return rows


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row per row of ``docs``; the
    rows drawn, ``percent`` of those with ``least_words``, have ranks 1, 2, 3, ..."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    weights = weighted(docs, gain, longest, id_column, text)
    with Scratch(docs.sparkSession) as scratch:
        scored = scratch.written(weights.withColumn("score", F.col("weight") + noise(F.col("_id"), seed)))
        short = F.col("n_words") < least_words
        facts = scored.agg(F.count_if(~short).alias("n"), F.max("score").alias("best")).first()
        key = [
            short.cast("long"),
            F.lit(facts["best"] or 0).cast("long") - F.col("score"),
            F.col("_id").isNull().cast("long"),
            F.coalesce("_id", F.lit(0)).bitwiseXOR(F.lit(-(2**63))),
            F.col("n_features"),
        ]
        ranked = kept(radix_sorted(scored, key, scratch))
    take = percent * facts["n"] // 100
    rank = F.when(F.col("_at") < take, F.col("_at") + 1).cast("long").alias("rank")
    return ranked.select(F.col("_id").alias(id_column), "n_features", "weight", "score", rank)
