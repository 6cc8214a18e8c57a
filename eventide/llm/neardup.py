"""MinHash near-duplicates by a signature-coordinate inverted join (operator 5).

1. Every whole text becomes its set of distinct word shingles (64-bit hashes);
   equal sets are merged at once, one representative each.
2. A representative's signature has ``COORDINATES`` min-hashes (16 bits kept
   of each). It is posted under each (coordinate, value) of a prefix of
   ``PREFIX`` coordinates, with the full value. A pair at the similarity bound
   misses all postings with probability (1 - bound)**PREFIX: 6e-8.
3. Skip merging: postings that stand alone are dropped, and within a list a
   pair is looked at only in the first coordinate it shares (of the posted
   coordinates, the signature has all 32 bits). Collisions over
   the whole signature are counted, and pairs below ``MATCHES`` go: a pair at
   the bound expects 96 of 128 with deviation 4.9; fewer than 72 has a chance
   of 1.2e-6.
4. The rest is confirmed on full shingle sets, so no false link survives. Only
   rows that take part in a surviving pair have their sets built and shuffled.
   A list answers with links to the roots of its confirmed groups, never with
   all pairs: a list of m texts gives m - 1 links at most.
5. Links meet in a distributed component search (large-star, small-star).

Lists over ``LIST_ROWS`` texts are dealt in blocks: each block, and each pair
of blocks, is a group of its own, so that no list is one task's work and no
pair is lost. In a group of two blocks only pairs across them are looked at.

Definitions: null and empty texts have an empty set and link with nothing;
they are their own component. Texts with fewer words than a shingle have one
shingle, their whole sequence. A null doc_id is returned with its shingle
count, a null component, kept = true, and links with nothing. Rows that repeat
a doc_id are one document: their sets are links of the same id. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept as stored
from .shared import small
from .words import U64, Hasher, Texts, blocks, mix, row_of, windows, words_of

SHINGLE_WORDS = 5
SIMILARITY = (75, 100)  # 100 * |A and B| >= 75 * |A or B|
COORDINATES = 128
MATCHES = 72
PREFIX = 12
LIST_ROWS = 1024
#: A quick look at the first coordinates of the signature: 32 of them, 24 expected at the bound.
QUICK, QUICK_MATCHES = 32, 10
#: Ids that may be broadcast to pick the rows whose sets are needed; else they are joined by shuffle.
PICKED_ROWS = 500_000
#: Ids of ``without_copies`` for rows that have none of their own; others are taken to be less.
OTHER_IDS = 1 << 62


def shingles(texts: Texts, hasher: Hasher, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes by text, rising, and their offsets."""
    words = words_of(texts)
    hashes = hasher.ranges(texts.data, words.start, words.end)
    rolled, at = windows(hashes, words.doc, width)
    n = np.diff(words.doc)
    row = row_of(at)
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        whole = np.zeros(len(short), U64)
        for j in range(width - 1):
            there = n[short] > j
            whole[there] = whole[there] * U64(0x9E3779B97F4A7C15) + hashes[words.doc[:-1][short[there]] + j]
        rolled, row = np.append(rolled, mix(whole + n[short].astype(U64))), np.append(row, short)
    order = np.lexsort((rolled, row))
    rolled, row = rolled[order], row[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (row[1:] != row[:-1])
    rolled, row = rolled[new], row[new]
    return rolled, np.searchsorted(row, np.arange(texts.n + 1))


def seeds() -> tuple[np.ndarray, np.ndarray]:
    a = mix(np.arange(1, COORDINATES + 1, dtype=U64))
    return (a >> U64(32)).astype(np.uint32) | np.uint32(1), a.astype(np.uint32)


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """[texts, COORDINATES] min-hashes (32 bits) of non-empty sets."""
    a, b = seeds()
    low = (sets ^ (sets >> U64(32))).astype(np.uint32)
    starts = at[:-1]
    out = np.empty((len(starts), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        x = (low ^ b[k]) * a[k]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def sketched(docs: DataFrame, text: str, width: int) -> DataFrame:
    """_id, n_shingles, same_a, same_b (a 128-bit key of the set), posts, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                sets, at = shingles(texts, hasher, width)
                n = np.diff(at)
                full = np.flatnonzero(n)
                key_a, key_b = np.zeros(texts.n, U64), np.zeros(texts.n, U64)
                posts, sigs = [None] * texts.n, [None] * texts.n
                if len(full):
                    starts = at[:-1][full]
                    key_a[full], key_b[full] = set_keys(sets, starts)
                    sig = signatures(sets, np.append(starts, len(sets)))
                    place = np.arange(PREFIX, dtype=U64) << U64(32)
                    post = mix(sig[:, :PREFIX].astype(U64) | place).view(np.int64)
                    high = (sig[:, :PREFIX] >> np.uint32(16)).astype(np.uint16)
                    cut = np.concatenate([sig.astype(np.uint16), high], axis=1)
                    for i, r in enumerate(full):
                        posts[r], sigs[r] = post[i], cut[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(n.astype(np.int64)),
                        pa.array(key_a.view(np.int64)),
                        pa.array(key_b.view(np.int64)),
                        pa.array(posts, pa.list_(pa.int64())),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["_id", "n_shingles", "same_a", "same_b", "posts", "sig"],
                )

    rows = docs.select(F.col("_id").cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, n_shingles long, same_a long, same_b long, posts array<long>, sig binary")


def set_keys(sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set, none of them empty."""
    return np.add.reduceat(mix(sets), starts), np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D)), starts)


def set_table(docs: DataFrame, text: str, width: int) -> DataFrame:
    """same_a, same_b, hashes (the set as little-endian 64-bit numbers, rising) of the texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            for _, texts in blocks(batch, "_text"):
                sets, at = shingles(texts, hasher, width)
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    cells = pa.array([sets[at[i] : at[i + 1]].tobytes() for i in full], pa.binary())
                    keys = [pa.array(k.view(np.int64)) for k in set_keys(sets, at[:-1][full])]
                    yield pa.RecordBatch.from_arrays([*keys, cells], names=["same_a", "same_b", "hashes"])

    return docs.select(F.col(text).cast("string").alias("_text")).mapInArrow(run, "same_a long, same_b long, hashes binary")


def partners(sig: np.ndarray, i: int, place: int, first: int) -> np.ndarray:
    """Rows from ``first`` on whose signature has enough collisions with row i's, and none before coordinate ``place``."""
    near = np.flatnonzero((sig[first:, :QUICK] == sig[i, :QUICK]).sum(axis=1) >= QUICK_MATCHES) + first
    same = sig[near] == sig[i]
    fit = same[:, :COORDINATES].sum(axis=1) >= MATCHES
    if place:  # in full, as they were posted
        fit &= ~(same[:, :place] & same[:, COORDINATES : COORDINATES + place]).any(axis=1)
    return near[fit]


def laid_out(group: pa.Table) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Order of a group's rows by block, then id; their signatures in that
    order; the coordinate; the rows of the first block if there are two, else 0."""
    block, *key = (group.column(c).to_numpy() for c in ("block", "same_b", "same_a", "_id"))
    order = np.lexsort((*key, block))
    sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(-1, COORDINATES + PREFIX)[order]
    mine = int((block == block[order[0]]).sum())
    return order, sig, group.column("place")[0].as_py(), mine if mine < len(order) else 0


def groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The runs of equal ``column`` in batches sorted by it, each whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(lo, hi - lo)
            if held and held[-1].column(held[-1].schema.get_field_index(column))[-1].as_py() != key[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list: the rows that are in a pair with enough collisions."""
    for group in groups(batches, "list"):
        if group.num_rows < 2:
            continue
        order, sig, place, mine = laid_out(group)
        hit = np.zeros(len(sig), bool)
        for i in range(mine or len(sig) - 1):
            js = partners(sig, i, place, mine or i + 1)
            if len(js):
                hit[order[i]] = hit[order[js]] = True
        if hit.any():
            yield from group.filter(pa.array(hit)).combine_chunks().to_batches()


def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list: links (member, root) of the groups that full sets confirm."""
    top, bottom = SIMILARITY
    for group in groups(batches, "list"):
        order, sig, place, mine = laid_out(group)
        ids = group.column("_id").to_numpy()[order]
        cells = group.column("hashes").to_pylist()
        sets = [np.frombuffer(cells[o], U64) for o in order]
        sizes = np.array([len(s) for s in sets])
        at = np.concatenate([[0], np.cumsum(sizes)])
        local = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
        seen = np.zeros(int(local.max()) + 1 if len(local) else 1, bool)
        root = np.arange(len(ids))
        for i in range(mine or len(ids) - 1):
            js = partners(sig, i, place, mine or i + 1)
            js = js[root[js] != root[i]]
            # The sizes alone rule out some: the smaller set bounds the intersection.
            few, many = np.minimum(sizes[js], sizes[i]), np.maximum(sizes[js], sizes[i])
            js = js[bottom * few >= top * many]
            if not len(js):
                continue
            seen[local[at[i] : at[i + 1]]] = True
            n = np.diff(at)[js]
            places = np.repeat(at[js] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            shared = np.add.reduceat(seen[local[places]].astype(np.int64), np.concatenate([[0], np.cumsum(n)[:-1]]))
            seen[local[at[i] : at[i + 1]]] = False
            linked = js[bottom * shared >= top * (sizes[i] + sizes[js] - shared)]
            if len(linked):
                merged = np.unique(np.append(root[linked], root[i]))
                root[np.isin(root, merged)] = merged[0]
        far = np.flatnonzero(root != np.arange(len(ids)))
        if len(far):
            yield pa.RecordBatch.from_arrays([pa.array(ids[far]), pa.array(ids[root[far]])], names=["a", "b"])


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(_id, root): the smallest id that each id of ``links`` (a, b) reaches.

    Alternates large-star and small-star until nothing changes; each round is
    a shuffle by id and is checkpointed. Rounds grow with the logarithm of the
    longest chain. A node's neighbours never meet as a list: only their
    minimum is aggregated, and joined back."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges)
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = large.join(lower, "u")
        stars = (
            small_star.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lower.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = stored(stars)
        # Both are sets of rows: equal if neither has a row that the other lacks.
        changed = edges.unionByName(after).groupBy("u", "v").count().where("count < 2").limit(1).count()
        edges = after
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("_id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("_id"), F.col("v").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links: one row per row of ``docs``.

    ``n_links`` counts the links that were recorded for the row's set (to the
    roots of its lists and to an equal set), not all pairs."""
    docs = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).alias("_text"))
    sketches = stored(sketched(docs, "_text", width))
    full = sketches.where("n_shingles > 0 and _id is not null")
    same = full.groupBy("same_a", "same_b", "n_shingles").agg(F.min("_id").alias("rep"))
    # Equal sets, and rows that repeat an id, are links to their representative.
    equal = full.join(same, ["same_a", "same_b", "n_shingles"]).select(F.col("_id").alias("a"), F.col("rep").alias("b"), "same_a", "same_b", "posts", "sig")
    equal = stored(equal)
    # A set is known by its key and not by its id, which may have other sets too.
    key = ["same_a", "same_b"]
    reps = equal.where("a = b").dropDuplicates(key).select(F.col("a").alias("_id"), *key, "posts", "sig")

    posts = reps.select("_id", *key, F.posexplode("posts").alias("place", "list"))
    lists = posts.groupBy("list").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = posts.join(lists, "list").select("_id", *key, "place", "list", F.ceil(F.col("rows") / LIST_ROWS).cast("int").alias("n"))
    block = F.pmod(F.xxhash64(*key), F.col("n")).cast("int")
    pairs = shared.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    parts = pairs.select("_id", *key, "place", "block", F.when(F.col("n") > 1, F.xxhash64("list", lo, hi)).otherwise(F.col("list")).alias("list"))

    schema = "list long, _id long, same_a long, same_b long, place int, block int, sig binary"
    width_ = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = parts.join(reps.select(*key, "sig"), key).select("list", "_id", *key, "place", "block", "sig")
    members = members.repartition(width_, "list").sortWithinPartitions("list")
    hits = stored(members.mapInArrow(involved, schema))

    picked = small(hits.select("_id").distinct(), PICKED_ROWS)
    sets = set_table(docs.join(picked, "_id", "left_semi"), "_text", width).dropDuplicates(key)
    whole = hits.join(sets, key).select("list", "_id", *key, "place", "block", "sig", "hashes")
    whole = whole.repartition(width_, "list").sortWithinPartitions("list")
    links = stored(whole.mapInArrow(confirmed, "a long, b long"))

    every = links.select("a", "b").union(equal.where("a <> b").select("a", "b"))
    found = components(every)
    degree = every.groupBy(F.col("a").alias("_id")).agg(F.count(F.lit(1)).alias("n_links"))
    rows = sketches.select("_id", "n_shingles").join(found, "_id", "left").join(degree, "_id", "left")
    root = F.coalesce("root", "_id")
    return rows.select(
        F.col("_id").alias(id_column),
        "n_shingles",
        root.alias("component_id"),
        F.coalesce(F.col("_id") == root, F.lit(True)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` with one document of each group, the one with the
    least id; of equal rows one. Rows without an id, and ids with different texts,
    are documents by id and text, after all others: they stay unless they are
    copies. Empty texts without an id stay."""
    body = F.xxhash64(F.col(text).cast("string"))
    again = docs.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_again"))
    again = stored(again.agg(F.count(F.lit(1)).alias("_n"), (F.min(body) != F.max(body)).alias("_differ")).where("_n > 1").select("_again", "_differ"))
    own = F.col(id_column).cast("long")
    by_text = F.lit(OTHER_IDS) + F.pmod(F.xxhash64(own, F.col(text).cast("string")), F.lit(OTHER_IDS // 2))
    repeated, differ = F.lit(False), F.lit(False)
    marked = docs
    if not again.isEmpty():
        marked = docs.join(small(again, PICKED_ROWS), F.col(id_column) == F.col("_again"), "left")
        repeated, differ = F.col("_again").isNotNull(), F.coalesce("_differ", F.lit(False))
    alone = F.col(id_column).isNotNull() & ~differ
    worded = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    twice = repeated | (F.col(id_column).isNull() & worded)
    marked = marked.select(*docs.columns, F.when(alone, own).otherwise(by_text).alias("_own"), twice.alias("_twice"))
    found = near_duplicates(marked, "_own", text, width)
    drop = found.where("not kept").select("_own").distinct()
    rest = marked.join(small(drop, PICKED_ROWS), "_own", "left_anti")
    one = rest.where("_twice").dropDuplicates(["_own"])
    return rest.where("not _twice").select(*docs.columns).unionByName(one.select(*docs.columns))
