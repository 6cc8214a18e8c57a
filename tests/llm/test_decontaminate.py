import random
import resource

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import decontaminate as D
from eventide.llm.words import Hasher, texts_of

from .conftest import DOCUMENTS, as_set, sentence

ITEMS = "item_id long, text string"


def brute_tiles(doc, item, width):
    """Greedy string tiling by definition: the longest unmarked match again and again."""
    used_d, used_t, out = set(), set(), []
    while True:
        best = None
        for t in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while t + n < len(item) and d + n < len(doc) and item[t + n] == doc[d + n] and t + n not in used_t and d + n not in used_d:
                    n += 1
                if n >= width and (best is None or (-n, t, d) < best):
                    best = (-n, t, d)
        if best is None:
            return out
        n, t, d = -best[0], best[1], best[2]
        out.append((d, t, n))
        used_t.update(range(t, t + n))
        used_d.update(range(d, d + n))


def test_tiles_equal_the_definition():
    rng = random.Random(4)
    for _ in range(150):
        doc = [rng.randrange(3) for _ in range(rng.randrange(40))]
        item = [rng.randrange(3) for _ in range(rng.randrange(3, 20))]
        pairs = [(d, t) for d in range(len(doc) - 2) for t in range(len(item) - 2) if doc[d : d + 3] == item[t : t + 3]]
        if not pairs:
            continue
        got = D.tiles(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), 3)
        assert got == brute_tiles(doc, item, 3)


def places(rng, doc_tokens, item_tokens, letters):
    doc = [rng.randrange(letters) for _ in range(doc_tokens)]
    item = [rng.randrange(letters) for _ in range(item_tokens)]
    pairs = [(d, t) for d in range(len(doc) - 2) for t in range(len(item) - 2) if doc[d : d + 3] == item[t : t + 3]]
    return doc, item, np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


def test_sweeping_an_item_finds_the_same_tiles():
    rng = random.Random(9)
    for _ in range(200):
        doc, item, d, t = places(rng, rng.randrange(60), rng.randrange(3, 16), rng.randrange(1, 4))
        if not len(d):
            continue
        rising = np.unique(t)
        runs = D.swept(rising, [np.sort(d[t == x]) for x in rising], 3)
        every = {*zip(*(x.tolist() for x in D.runs_of(d, t, 3)), strict=True)}
        assert {*zip(*(x.tolist() for x in runs), strict=True)} <= every
        assert D.tiled(*runs, 3) == brute_tiles(doc, item, 3)


def met(texts, items, coverage=D.COVERAGE):
    block = D.Items(list(range(len(items))), items, D.MIN_TILE)
    return list(D.meet(texts_of(pa.array(texts)), block, Hasher(), coverage))


@pytest.mark.parametrize("hits", [1, 50, 1 << 19])
def test_slices_change_nothing(monkeypatch, hits):
    rng = random.Random(3)
    words = ["a", "b", "c"]
    items = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(25)]
    whole = met(texts, items)
    monkeypatch.setattr(D, "HITS", hits)
    monkeypatch.setattr(D, "PLACES", 0 if hits == 50 else D.PLACES)
    assert whole and sorted(met(texts, items)) == sorted(whole)
    expected = {}
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            doc, words_ = text.split(), item.split()
            found = brute_tiles(doc, words_, min(len(words_), D.MIN_TILE))
            covered = sum(n for _, _, n in found)
            if covered >= 0.5 * len(words_):
                expected[i, j] = (covered, found)
    assert {(i, j): (n, t) for i, j, n, t in whole} == expected


def test_common_seeds_and_repetition_stay_in_memory():
    def peak():
        return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024

    start = "of all the many things"
    items = [f"{start} " + " ".join(f"i{i}w{j}" for j in range(40)) for i in range(10_000)]
    block = D.Items(list(range(len(items))), items, D.MIN_TILE)
    text = " ".join(f"{start} x{i}" for i in range(2000)) + " " + items[77]
    before = peak()
    found = list(D.meet(texts_of(pa.array([text])), block, Hasher(), D.COVERAGE))
    assert [(i, n) for _, i, n, _ in found] == [(77, 45)]
    # One word again and again: the places in the text are as many as its words times the item's.
    found = met(["so " * 200_000], ["so " * 60, "so " * 30 + "well"])
    assert [(i, n, t[0]) for _, i, n, t in found] == [(0, 60, (0, 0, 60)), (1, 30, (0, 0, 30))]
    assert peak() - before < 300


def test_rows_are_judged_by_their_texts(spark):
    item = " ".join(f"w{j}" for j in range(30))
    rows = [(1, "x " + item), (1, "clean words only here"), (None, item + " y"), (None, "more clean words"), (2, "z " + item), (2, "z " + item), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(0, item), (1, item), (2, item.upper())], ITEMS)
    for tokens in (D.BLOCK_TOKENS, 20):
        clean = [tuple(r) for r in D.clean_rows(frame, bench, block_tokens=tokens).collect()]
        assert sorted(clean, key=repr) == sorted([rows[1], rows[3], rows[6]], key=repr)
        found = D.contaminated(frame, bench, block_tokens=tokens)
        assert sorted((str(r.doc_id), r.item_id) for r in found.collect()) == sorted((i, j) for i in ("1", "2", "2", "None") for j in range(3))


def test_planted_passages(spark):
    rng = random.Random(6)
    items = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(12)]
    filler = [sentence(rng, 150) for _ in range(12)]
    words = items[3].split()
    docs = [
        (0, filler[0] + " " + items[0] + " " + filler[1]),
        (1, filler[2] + " " + items[1].upper().replace(" ", ", ") + "!"),  # case and punctuation differ
        (2, " ".join(words[20:] + ["x"] + words[10:20] + ["y"] + words[:10])),  # reordered
        (3, filler[3] + " " + " ".join(items[4].split()[:10])),  # a third only
        (4, filler[4]),
        (5, filler[5] + " tiny item " + filler[6]),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (50, "tiny item"), (51, ""), (52, None)], ITEMS)
    found = {(r.doc_id, r.item_id): r for r in D.contaminated(frame, bench).collect()}
    assert set(found) == {(0, 0), (1, 1), (2, 3), (5, 50)}
    assert found[2, 3].covered_tokens == 30 and len(found[2, 3].tiles) == 3
    blocks = D.contaminated(frame, bench, block_tokens=20)  # many small blocks
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(found)
    clean = D.clean_rows(frame, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4]


def test_rows(spark, odd, clashing, empty, odd_rows):
    bench = spark.createDataFrame([(1, " ".join(odd_rows[0][1].split()[20:60])), (None, None)], ITEMS)
    found = D.contaminated(odd, bench)
    assert sorted(repr(r.doc_id) for r in found.collect()) == ["1", "1", "2", "None"]
    assert as_set(D.contaminated(clashing, bench)) == as_set(found)
    assert D.contaminated(empty, bench).collect() == []
    assert D.contaminated(odd, spark.createDataFrame([], ITEMS)).collect() == []
    kept = D.clean_rows(clashing, bench)
    assert kept.columns == clashing.columns
    assert kept.count() == len(odd_rows) - 4  # the row without an id is judged like any other
    assert spark.createDataFrame([], DOCUMENTS).columns == empty.columns
