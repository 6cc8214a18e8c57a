"""Benchmark decontamination by greedy string tiling (operator 4).

Both sides become tokens: words without ASCII punctuation at either end, in
lower case. A document meets an item through the seeds they share, runs of
``MIN_TILE`` tokens compared by rolling (Karp-Rabin) hashes. Seeds that follow
each other on both sides make maximal matches; the longest is marked as a
tile, what the others still have unmarked is tried again, and so on until no
unmarked match of ``MIN_TILE`` tokens is left. An item is found in a document
when the tiles cover at least ``COVERAGE`` of its tokens, in whatever order
its passages stand there. Items shorter than a tile must stand there whole.

The benchmark is the query set. Its rows are dealt into blocks of about
``BLOCK_TOKENS`` tokens, repeated items too; each block is broadcast, and all
documents run against it in one pass over whole texts. Of several blocks one
is held at a time. So a broadcast is bounded whatever the benchmark's size,
and nothing of a document is ever shuffled.

Memory of a task: a text's distinct seeds meet the block, so that it never
holds more hits than the block has seeds, however often a common seed stands
in the text. An item that these hits can't cover is out. Places in the text
are spread out for the others only, a pair at a time, and a pair with more
than ``PLACES`` of them is swept along the item.

Null or empty texts and items have no tokens and match nothing. Documents or
items that repeat are judged row by row. Extra columns are not read.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, small, worker_cache
from .words import U64, Hasher, Texts, blocks, texts_of, windows, words_of

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_TOKENS = 1_000_000
FILTER_BITS = 22
HITS = 1 << 19  # of distinct seeds looked at together, of one text at least
PLACES = 1 << 18
#: Texts that may be broadcast to leave them out; else they are joined by shuffle.
DROPPED_ROWS = 500_000

PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def tokens(texts: Texts, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and their offsets by text."""
    start, end, doc = words_of(texts)
    start, end = start.copy(), end.copy()
    live = np.arange(len(start))
    while len(live := live[PUNCTUATION[texts.data[start[live]]]]):
        start[live] += 1
        live = live[start[live] < end[live]]
    live = np.flatnonzero(start < end)
    while len(live := live[PUNCTUATION[texts.data[end[live] - 1]]]):
        end[live] -= 1
    there = start < end
    at = np.concatenate([[0], np.cumsum(there)])[doc]
    return hasher.ranges(texts.data, start[there], end[there]), at


class Seeds:
    """The seeds of the items with one tile width: sorted hashes with their places."""

    def __init__(self, width: int, hashes: np.ndarray, item: np.ndarray, place: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.width, self.hash, self.item, self.place = width, hashes[order], item[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.hash >> U64(64 - FILTER_BITS)] = True


class Items:
    """A block of items, ready to be met by documents."""

    def __init__(self, ids: list, texts: list[str | None], min_tile: int):
        self.ids = ids
        hashes, at = tokens(texts_of(pa.array(texts, pa.string())), Hasher())
        self.sizes = np.diff(at)
        self.seeds = []
        for width in range(1, min_tile + 1):
            mine = np.flatnonzero(self.sizes >= width if width == min_tile else self.sizes == width)
            if len(mine):
                rolled, to = windows(hashes, at, width)
                n = np.diff(to)
                item = np.repeat(np.arange(len(ids)), n)
                place = np.arange(len(rolled)) - np.repeat(to[:-1], n)
                own = np.isin(item, mine)
                self.seeds.append(Seeds(width, rolled[own], item[own], place[own]))


Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # document token, item token, tokens


def first_of_each(d: np.ndarray, t: np.ndarray, n: np.ndarray, size: int, width: int) -> Runs:
    """The runs that greedy tiling can use. Tiles lie apart in the item, so there
    are at most size / width of them, ``size`` tokens in all. They touch less
    than size + n * (size / width) runs of n tokens from one item token: of so
    many one is untouched in the document, and serves in place of any later one."""
    order = np.lexsort((d, n, t))
    d, t, n = d[order], t[order], n[order]
    new = np.ones(len(d), bool)
    new[1:] = (t[1:] != t[:-1]) | (n[1:] != n[:-1])
    first = np.flatnonzero(new)
    rank = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
    use = rank <= size + n * (size // width)
    return d[use], t[use], n[use]


def runs_of(doc_place: np.ndarray, item_place: np.ndarray, width: int) -> Runs:
    """Maximal matches from the places of shared seeds."""
    order = np.lexsort((doc_place, doc_place - item_place))
    d, t = doc_place[order], item_place[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1] + 1) | (t[1:] != t[:-1] + 1)
    first = np.flatnonzero(new)
    return d[first], t[first], np.diff(np.append(first, len(d))) + width - 1


def swept(item_places: np.ndarray, doc_places: list[np.ndarray], width: int) -> Runs:
    """``runs_of`` from each rising item place's rising places in the document,
    in memory for the places of one seed and the runs that may be used."""
    size, out = int(item_places[-1]) + width, []
    diagonal = since = np.empty(0, np.int64)
    last = -2
    for t, places in zip(item_places.tolist(), doc_places, strict=True):
        if t != last + 1:
            out.append(first_of_each(diagonal + since, since, last - since + width, size, width))
            diagonal = since = diagonal[:0]
        now = places - t
        at = np.searchsorted(diagonal, now)
        goes_on = np.zeros(len(now), bool)
        inside = at < len(diagonal)
        goes_on[inside] = diagonal[at[inside]] == now[inside]
        ended = np.ones(len(diagonal), bool)
        ended[at[goes_on]] = False
        out.append(first_of_each((diagonal + since)[ended], since[ended], last - since[ended] + width, size, width))
        begun = np.full(len(now), t)
        begun[goes_on] = since[at[goes_on]]
        diagonal, since, last = now, begun, t
    out.append(first_of_each(diagonal + since, since, last - since + width, size, width))
    d, t, n = (np.concatenate(c) for c in zip(*out, strict=True))
    return d, t, n


def tiles(doc_place: np.ndarray, item_place: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the places of shared seeds: (document token, item
    token, tokens), longest first; ties by place in the item, then document."""
    return tiled(*runs_of(doc_place, item_place, width), width)


def tiled(d: np.ndarray, t: np.ndarray, runs: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from maximal matches."""
    if len(d) > 1:
        d, t, runs = first_of_each(d, t, runs, int((t + runs).max()), width)
    heap = list(zip((-runs).tolist(), t.tolist(), d.tolist(), strict=True))
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    out = []
    while heap:
        n, t0, d0 = heapq.heappop(heap)
        n = -n
        free = [t0 + k not in in_item and d0 + k not in in_doc for k in range(n)]
        if all(free):
            out.append((d0, t0, n))
            in_item.update(range(t0, t0 + n))
            in_doc.update(range(d0, d0 + n))
            continue
        k = 0
        while k < n:  # what is left of this match on both sides
            j = k
            while j < n and free[j]:
                j += 1
            if j - k >= width:
                heapq.heappush(heap, (k - j, t0 + k, d0 + k))
            k = j + 1
    return out


def spread(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ..., n[0] of them, then those of the next."""
    return np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def together(text: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``HITS`` hits: of one text at least."""
    starts = np.append(np.flatnonzero(np.diff(text, prepend=-1)), len(text))
    before = np.concatenate([[0], np.cumsum(n)])[starts]
    i = 0
    while i < len(starts) - 1:
        j = max(i + 1, int(np.searchsorted(before, before[i] + HITS, "right")) - 1)
        yield int(starts[i]), int(starts[j])
        i = j


def meet(texts: Texts, items: Items, hasher: Hasher, coverage: float) -> Iterator[tuple[int, int, int, list]]:
    """(text, item, covered tokens, tiles) of the pairs that are found."""
    hashes, at = tokens(texts, hasher)
    for seeds in items.seeds:
        rolled, to = windows(hashes, at, seeds.width)
        maybe = np.flatnonzero(seeds.filter[rolled >> U64(64 - FILTER_BITS)])
        low = np.searchsorted(seeds.hash, rolled[maybe], "left")
        n = np.searchsorted(seeds.hash, rolled[maybe], "right") - low
        hit, low, n = maybe[n > 0], low[n > 0], n[n > 0]
        if not len(hit):
            continue
        text = np.searchsorted(to, hit, "right") - 1
        order = np.lexsort((low, text))  # stable: a seed's places rise
        hit, text, low, n = hit[order], text[order], low[order], n[order]
        first = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(low, prepend=-1) != 0))  # a text's distinct seeds
        ends = np.append(first[1:], len(hit))
        place = hit - to[text]
        for lo, hi in together(text[first], n[first]):
            mine = first[lo:hi]
            entry, seed = spread(low[mine], n[mine]), np.repeat(np.arange(lo, hi), n[mine])
            item, of = seeds.item[entry], text[first[seed]]
            order = np.lexsort((seeds.place[entry], item, of))
            entry, seed, item, of = entry[order], seed[order], item[order], of[order]
            cut = np.append(np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0)), len(of))
            size = items.sizes[item[cut[:-1]]]
            # Tokens of the item that any seed touches bound what tiles can cover.
            able = np.minimum(size, np.diff(cut) * seeds.width) >= coverage * size
            for k in np.flatnonzero(able):
                e, s = entry[cut[k] : cut[k + 1]], seed[cut[k] : cut[k + 1]]
                times = ends[s] - first[s]
                if times.sum() <= PLACES:
                    runs = runs_of(place[spread(first[s], times)], np.repeat(seeds.place[e], times), seeds.width)
                else:
                    runs = swept(seeds.place[e], [place[i:j] for i, j in zip(first[s], ends[s], strict=True)], seeds.width)
                found = tiled(*runs, seeds.width)
                covered = sum(n for _, _, n in found)
                if covered >= coverage * size[k]:
                    yield int(of[cut[k]]), int(item[cut[k]]), covered, found


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, coverage: float = COVERAGE, block_tokens: int = BLOCK_TOKENS,
                 id_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, item_tokens, covered_tokens, coverage, tiles: one row for
    each document (row) in which an item was found."""
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.lower(F.col(text).cast("string")).alias("_text"))
    return met(rows, benchmark, min_tile, coverage, block_tokens, item_column, item_text).withColumnsRenamed({"_id": id_column, "_item": item_column})


def met(rows: DataFrame, benchmark: DataFrame, min_tile: int = MIN_TILE, coverage: float = COVERAGE, block_tokens: int = BLOCK_TOKENS,
        item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """``contaminated`` for rows of _id, of any type, and _text in lower case."""
    spark = rows.sparkSession
    items = benchmark.select(F.col(item_column).cast("long").alias("_item"), F.lower(F.col(item_text).cast("string")).alias("_text"))
    letters = items.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-letters // (4 * block_tokens)))  # a token and its space take 4 bytes or more in most texts
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _item long, item_tokens long, covered_tokens long, coverage double, tiles array<struct<doc_token: long, item_token: long, tokens: long>>"
    tile = pa.list_(pa.struct([("doc_token", pa.int64()), ("item_token", pa.int64()), ("tokens", pa.int64())]))
    types = [pa.int64()] * 3 + [pa.float64(), tile]
    names = ["_id", "_item", "item_tokens", "covered_tokens", "coverage", "tiles"]

    def against(block: DataFrame) -> DataFrame:
        held = [(r[0], r[1]) for r in block.collect()]
        sent = spark.sparkContext.broadcast(([i for i, _ in held], [t for _, t in held]))
        key = ("items", uuid.uuid4().hex)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cache = worker_cache()
            if key not in cache:  # of one block only
                for old in [k for k in cache if k[0] == "items"]:
                    del cache[old]
                cache[key] = Items(*sent.value, min_tile)
            items, hasher = cache[key], Hasher()
            for batch in batches:
                for part, texts in blocks(batch, "_text"):
                    found = [
                        (d, items.ids[i], int(items.sizes[i]), covered, covered / int(items.sizes[i]),
                         [{"doc_token": a, "item_token": b, "tokens": n} for a, b, n in marked])
                        for d, i, covered, marked in meet(texts, items, hasher, coverage)
                    ]
                    if found:
                        at, *columns = zip(*found, strict=True)
                        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), *arrays], names=names)

        found = rows.mapInArrow(run, schema)
        if n_blocks == 1:
            return found
        found = kept(found)  # before the next block is sent
        sent.unpersist()
        return found

    if n_blocks == 1:
        return against(items)
    items = kept(items.withColumn("_row", F.monotonically_increasing_id()))
    parts = [against(items.where(F.pmod(F.xxhash64("_row"), F.lit(n_blocks)) == b).drop("_row")) for b in range(n_blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clean_rows(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item was found. A row is judged by its
    text alone, whatever its id: rows with equal texts go or stay together."""
    body = F.col(text).cast("string")
    key = F.md5(body.cast("binary"))
    found = met(docs.select(key.alias("_id"), F.lower(body).alias("_text")), benchmark, **options)
    drop = kept(found.select(F.col("_id").alias("_drop")).distinct())
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    rest = docs.select(row, key.alias("_drop")).join(small(drop, DROPPED_ROWS), "_drop", "left_anti")
    return rest.select("_row.*")
