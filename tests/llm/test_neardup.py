import random

import numpy as np
import re

import pytest

from eventide.llm import neardup

from .conftest import as_set, sentence


def brute(rows):
    sets, inverted = {}, {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[doc_id] = s
        for x in s:
            inverted.setdefault(x, []).append(doc_id)
    root = {k: k for k in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, s in sets.items():
        for b in {b for x in s for b in inverted[x] if b < a}:
            n = len(s & sets[b])
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((a, len(s), find(a), find(a) == a) for a, s in sets.items())


def variants(n, seed=8):
    """Copies of a few bases with ever more words changed, and loners."""
    rng = random.Random(seed)
    bases, rows = [sentence(rng, 150).split() for _ in range(4)], []
    for i in range(n):
        w = list(bases[i % 4])
        for _ in range(rng.randrange(14)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(w).upper() if i % 7 == 0 else "  ".join(w)))
    return rows + [(2000 + i, sentence(rng, 60)) for i in range(20)] + [(3000, "a b"), (3001, "A\tb"), (3002, ""), (3003, None)]


@pytest.mark.parametrize("list_rows", [2048, 16])
def test_equals_brute_force(spark, monkeypatch, list_rows):
    monkeypatch.setattr(neardup, "LIST_ROWS", list_rows)  # 16: lists are dealt in blocks
    rows = variants(160)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert as_set(got) == sorted(brute(rows), key=repr)


def test_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = neardup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert as_set(got) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]), key=repr)


def test_long_chains_settle(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(1, 60)] + [(100, 200), (200, 150)], "a long, b long")
    assert {r._id: r.root for r in neardup.components(links).collect()} == {**dict.fromkeys(range(1, 61), 1), 100: 100, 150: 100, 200: 100}


def test_rows(odd, clashing, empty, odd_rows):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows)
    by = {r.doc_id: r for r in rows}
    assert by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert by[3].n_shingles == 0 and by[3].kept and by[6].n_shingles == 1
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert as_set(neardup.near_duplicates(clashing)) == as_set(neardup.near_duplicates(odd))
    assert neardup.near_duplicates(empty).collect() == []
    left = neardup.without_copies(clashing)
    assert left.columns == clashing.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 1  # the other is a copy of 1
    assert neardup.without_copies(empty).collect() == []


def test_ids_with_several_texts(spark):
    """Each of an id's texts is judged, whatever the order of rows."""
    from itertools import permutations

    rng = random.Random(12)
    a, b = ([f"w{rng.randrange(10**6)}" for _ in range(300)] for _ in range(2))
    near = lambda w: " ".join([*w[:150], "changed", *w[151:]])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b))]
    for order in [rows, rows[::-1], list(permutations(rows))[9]]:
        df = spark.createDataFrame(order, "doc_id long, text string")
        assert sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()) == [(1, 1), (1, 1), (2, 1), (3, 1)]
        left = sorted(r.text for r in neardup.without_copies(df).collect())
        # Alone in its id, 2 is kept of its group, and so is 3; both texts of id 1 are copies of theirs.
        assert left == sorted([near(a), near(b)])


def test_rows_without_an_id_of_their_own(spark):
    rng = random.Random(13)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(3))
    rows = [(1, a), (1, b), (1, a), (None, a + " tail"), (None, c), (None, c), (None, ""), (None, None), (None, ""), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in neardup.without_copies(df).collect()]
    assert sorted(x for _, x in left if x and x not in (a, a + " tail")) == sorted([b, c])
    assert sum(x in (a, a + " tail") for _, x in left) == 1
    assert sorted((i is None, x is None) for i, x in left if not x) == [(False, False), (True, False), (True, False), (True, True)]


def test_a_chance_match_of_cut_values_loses_no_pair():
    """16 bits may agree where the posted 32 differ: that is no shared coordinate."""
    sig = np.zeros((2, neardup.COORDINATES + neardup.PREFIX), np.uint16)
    sig[1, neardup.COORDINATES] = 1  # coordinate 0 agrees in its low half only
    assert neardup.partners(sig, 0, 1, 1).tolist() == [1]
    assert neardup.partners(sig, 0, 2, 1).tolist() == []
