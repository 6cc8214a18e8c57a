import random
import re
from collections import Counter

import pytest

from eventide.llm import rules

from .conftest import as_set


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, marked, lines, dup = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)), set(), set(), 0
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            marked |= {i, i + 1, i + 2}
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)


def counts(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()), key=repr)


def test_counts_equal_brute_force(spark, odd, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert counts(rules.measured(docs)) == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert counts(rules.measured(odd)) == sorted(((r[0], *brute(r[1])) for r in odd_rows), key=repr)
    texts = [(1, "a\n\na\n b\n b\nb\r\na"), (2, "\n"), (3, "a\na"), (4, "a"), (5, "\n\n x")]
    lines = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], "doc_id long, text string, lang string, source string")
    assert counts(rules.measured(lines)) == [(i, *brute(t)) for i, t in texts]


def test_junk_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = rules.quality_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.02 * len(junk)


def test_thresholds_follow_their_group(spark):
    """The same share of symbols passes where it is usual and fails where it is not."""
    base = " ".join(f"w{i}" for i in range(100))
    code = " ".join(f"w{i}#" if i % 2 else f"w{i}" for i in range(100))
    rows = [(i, base, "en", "prose") for i in range(60)] + [(100 + i, code, "en", "code") for i in range(60)] + [(200, code, "en", "prose")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r.doc_id: r.reason for r in rules.quality_rules(docs).where("not kept").collect()}
    assert gone == {200: "symbol_ratio"}


@pytest.mark.parametrize("junk", [30, 45, 60, 100])
def test_junk_does_not_widen_its_own_fence(spark, junk):
    """A source that is partly junk, alone in its language; one that is nothing else, beside clean ones."""
    base = [" ".join(f"w{i}x{j}" + "#" * (j % 40 == i % 40) for j in range(100)) for i in range(100)]
    noise = [" ".join(f"w{i}x{j}##" + "*" * (i % 2) for j in range(100)) for i in range(100)]
    rows = [(i, noise[i] if i < junk else base[i], "xx", "hot") for i in range(100)]
    if junk == 100:
        rows += [(1000 + i, base[i % 100], "xx", f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r.doc_id for r in rules.quality_rules(docs).where("not kept").collect()}
    assert gone == set(range(junk))


def test_rows(odd, clashing, empty):
    found = rules.quality_rules(odd)
    assert found.count() == odd.count()
    assert all(r.base_failed and not r.kept for r in found.collect() if r.doc_id in (3, 4, 5, 6))
    assert as_set(rules.quality_rules(clashing)) == as_set(found)
    assert rules.quality_rules(empty).collect() == []
    left = rules.passing_rows(clashing)
    assert left.columns == clashing.columns
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(r.doc_id) for r in found.where("kept").collect())
    assert rules.passing_rows(empty).collect() == []


@pytest.mark.parametrize("share", [40, 60])
def test_a_source_of_nothing_but_junk_goes(spark, share):
    rng = random.Random(share)
    clean = lambda: " ".join(rng.choice(["river", "stone", "light", "under", "walks"]) + str(i % 83) for i in range(90))
    junk = lambda: " ".join("###" if i % 2 else f"x{rng.randrange(10**6)}" for i in range(90))
    n = 10 * share
    rows = [(i, junk(), "en", "junk", 1) for i in range(n)] + [(n + i, clean(), "en", f"src{i % 6}", 1) for i in range(1000 - n)]
    found = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()
    assert not any(r.kept for r in found if r.doc_id < n) and all(r.kept for r in found if r.doc_id >= n)


def test_sql_restates_the_fences(spark):
    """Rows between other fences: many sources, few sources, a small group, texts of growing ratios."""
    import duckdb
    import pandas as pd

    from eventide.llm.oracle import ORACLE_SQL

    rng = random.Random(31)

    def text(symbols, upper, length):
        words = [("#" * (rng.random() < symbols)) + ("ABC" if rng.random() < upper else "abc") + "x" * rng.randrange(length) + str(i) for i in range(70)]
        return " ".join(words)

    plan = [("en", f"s{i}", 60) for i in range(4)] + [("de", "s0", 70), ("de", "s1", 55), ("fr", "s0", 20), (None, None, 9)]
    rows = []
    for k, (lang, source, n) in enumerate(plan):
        for j in range(n):
            bad = j % 7 == 0
            rows.append((len(rows), text(0.05 + 0.02 * k + bad * rng.random(), 0.1 + bad * rng.random(), 3 + k + 12 * bad), lang, source, 1))
    found = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    right = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, kept, reason FROM ({ORACLE_SQL['op9_quality_rules']}) q").fetchall()}
    ours = {r.doc_id: (r.kept, r.reason) for r in found.collect()}
    assert ours == right
    assert 20 < sum(not k for k, _ in ours.values()) < len(rows) / 2
