"""Quality rules with adaptive thresholds (operator 9).

Whole texts are measured in one pass (numpy over Arrow buffers). The cutoffs
are not fixed: per language and source, KLL quantile sketches of each ratio
are built map-side and merged, and a text is rejected where a ratio lies
beyond a robust upper fence of its own group. The group's thresholds are then
joined back and filter the rows.

Fence of a ratio: ``q25 + slack + 2 * SPREAD * (q25 - q05)``: junk lies above
and can't widen it, up to three quarters of a group. ``slack`` is the distance a
ratio may have from its group's lower quartile whatever the group's spread (a
group whose texts all have no symbols has spread 0). Groups with fewer than
``min_group`` texts take the thresholds of their language, and those of a
small language the thresholds of all texts: sketches merge, so the wider
levels come from the sketches of the groups and not from the rows again.
No fence is beyond the loose one of its language, the median over the language's
sources (groups of ``min_group`` texts at least) of each one's own
``median + LOOSE * slack + SPREAD * (q75 - q25)``. A source that is nothing but
junk is one source there, however many texts it has. A language with fewer
than ``LEAST_SOURCES`` such sources takes that formula over its texts, a small
one over all texts.

Nulls: a null text counts as empty (0 words, fails the base rule); null lang
or source form groups of their own. Repeated rows are measured one by one.
Extra columns never reach the operator: it reads only the four it names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import kept as stored
from .shared import small
from .words import SEPARATOR, U64, Hasher, Texts, blocks, mix, row_of, sums, windows, words_of

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?;:=\\/{}[]()_^~+\"'@`"
MIN_WORDS = 50

#: Ratio of two counts, and the slack that a text always has above its group's lower quartile.
RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words", 0.10),
    "mark_ratio": ("n_marks", "n_words", 0.15),
    "upper_ratio": ("n_upper", "word_chars", 0.10),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 0.50),
    "repeat_ratio": ("n_repeat_words", "n_words", 0.40),
    "word_length": ("word_chars", "n_words", 3.0),
}
SPREAD = 4.0
LOOSE = 6.0
QUANTILES = (0.05, 0.25, 0.5, 0.75)
MIN_GROUP = 50
LEAST_SOURCES = 3
#: Size parameter of the sketches: rank errors near 0.2 %, some 10 KB each at most.
SKETCH_K = 1024

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper")


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


IS_SYMBOL, IS_MARK = byte_set(SYMBOLS), byte_set(MARKS)
IS_UPPER = byte_set(bytes(range(65, 91)))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def by_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that are equal for equal hashes of one row only."""
    return mix(hashes ^ (row.astype(U64) * U64(0xC2B2AE3D27D4EB4F)))


def measure(texts: Texts, hasher: Hasher) -> dict[str, np.ndarray]:
    """All counts of each text. Lines are split at ``\\n``."""
    data, offsets = texts
    words = words_of(texts)
    n_words = np.diff(words.doc)
    in_word = ~SEPARATOR[data]
    out = {
        "n_words": n_words,
        "word_chars": sums(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": sums(IS_SYMBOL[data], offsets),
        "n_marks": sums(IS_MARK[data], offsets),
        "n_upper": sums(IS_UPPER[data], offsets),
    }

    full = offsets[:-1][np.diff(offsets) > 0]
    start = np.union1d(full, np.flatnonzero(data == 10) + 1)
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    end = end - (data[end - 1] == 10) if len(start) else end
    has_word = sums(in_word, np.append(start, len(data))) > 0 if len(start) else np.empty(0, bool)
    start, end = start[has_word], end[has_word]
    row = np.searchsorted(offsets, start, "right") - 1
    lines = np.bincount(row, minlength=texts.n)
    distinct = np.unique(by_row(hasher.ranges(data, start, end), row), return_index=True)[1]
    out["n_lines"] = lines
    out["n_dup_lines"] = lines - np.bincount(row[distinct], minlength=texts.n)

    rolled, at = windows(hasher.ranges(data, words.start, words.end), words.doc, 3)
    row = row_of(at)
    twice = np.flatnonzero(repeated(by_row(rolled, row)))
    first = twice + (words.doc[:-1] - at[:-1])[row[twice]]
    marked = np.zeros(len(words.start) + 2, bool)
    for j in range(3):
        marked[first + j] = True
    out["n_repeat_words"] = sums(marked[: len(words.start)], words.doc)
    return {k: v.astype(np.int64) for k, v in out.items()}


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the counts of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                counts = measure(texts, hasher)
                arrays = [rows.column(i) for i in range(len(keep))] + [pa.array(counts[c]) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *COUNTS])

    rows = docs.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return rows.mapInArrow(run, schema)


def ratio(name: str) -> Column:
    top, bottom, _ = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0)).cast("double")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def thresholds(counts: DataFrame, spread: float = SPREAD, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source, one upper fence per ratio. Only texts that pass the base
    rule are sketched; a group without any takes the wider levels' fences."""
    sketches = counts.groupBy("lang", "source").agg(
        F.count(F.when(~base_failed(), 1)).alias("n"),
        *[F.kll_sketch_agg_double(F.when(~base_failed(), ratio(r)), SKETCH_K).alias(r) for r in RATIOS],
    )
    sketches = stored(sketches)  # three levels read it; a few KB a group

    def level(keys: list[str], suffix: str) -> DataFrame:
        merged = sketches.groupBy(*keys).agg(F.sum("n").alias(f"n{suffix}"), *[F.kll_merge_agg_double(r, SKETCH_K).alias(r) for r in RATIOS])
        fences = []
        for r, (_, _, slack) in RATIOS.items():
            least, low, mid, high = (F.kll_sketch_get_quantile_double(r, F.lit(q)) for q in QUANTILES)
            some = F.col(f"n{suffix}") > 0
            fences.append(F.when(some, low + slack + 2 * spread * (low - least)).alias(f"{r}{suffix}"))
            fences.append(F.when(some, mid + LOOSE * slack + spread * (high - low)).alias(f"{r}_loose{suffix}"))
        return merged.select(*[F.col(k).alias(f"{k}{suffix}") for k in keys], f"n{suffix}", *fences)

    own, lang, every = level(["lang", "source"], ""), level(["lang"], "_1"), level([], "_2").first()
    middle = [F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {r}_loose)").alias(f"{r}_middle") for r in RATIOS]
    sources = own.where(F.col("n") >= min_group).groupBy(F.col("lang").alias("lang_3")).agg(F.count(F.lit(1)).alias("sources"), *middle)
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_1")), "left").join(sources, F.col("lang").eqNullSafe(F.col("lang_3")), "left")

    def chosen(r: str) -> Column:
        def wide(x: str) -> Column:
            return F.when(F.col("n_1") >= min_group, F.col(f"{x}_1")).otherwise(F.lit(every[f"{x}_2"]).cast("double"))

        fence = F.when(F.col("n") >= min_group, F.col(r)).otherwise(wide(r))
        loose = F.when(F.col("sources") >= LEAST_SOURCES, F.col(f"{r}_middle")).otherwise(wide(f"{r}_loose"))
        return F.coalesce(F.least(fence, loose), F.lit(float("inf"))).alias(f"max_{r}")

    return joined.select("lang", "source", *[chosen(r) for r in RATIOS])


def judged(counts: DataFrame, fences: DataFrame) -> DataFrame:
    """``counts`` with base_failed, kept and reason (the first rule that failed)."""
    fences = small(fences.withColumnsRenamed({"lang": "_lang", "source": "_source"}))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    reason = F.when(base_failed(), F.lit("base"))
    for r in RATIOS:
        reason = reason.when(ratio(r) > F.col(f"max_{r}"), F.lit(r))
    rows = counts.join(fences, same, "left").withColumn("reason", reason)
    return rows.select(*counts.columns, base_failed().alias("base_failed"), F.col("reason").isNull().alias("kept"), "reason")


def quality_rules(docs: DataFrame, text: str = "text", spread: float = SPREAD, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, kept, reason: one row per row of ``docs``."""
    counts = stored(measured(docs, text))
    return judged(counts, thresholds(counts, spread, min_group))


def passing_rows(docs: DataFrame, text: str = "text", spread: float = SPREAD, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. Thresholds come from a
    first pass; the second measures the texts again beside their rows: only
    texts go to Python, and no text is shuffled to meet its verdict."""
    fences = thresholds(stored(measured(docs, text)), spread, min_group)
    result = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    @F.arrow_udf(result)
    def counted(column: pa.Array) -> pa.Array:
        hasher = Hasher()
        parts = [measure(texts, hasher) for _, texts in blocks(pa.RecordBatch.from_arrays([column], names=["_text"]), "_text")]
        arrays = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.empty(0, np.int64)) for c in COUNTS]
        return pa.StructArray.from_arrays(arrays, names=list(COUNTS))

    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    rows = docs.select(row, counted(F.col(text).cast("string")).alias("_counts"))
    rows = rows.select("_row", F.col("_row.lang").alias("lang"), F.col("_row.source").alias("source"), "_counts.*")
    return judged(rows, fences).where("kept").select("_row.*")
