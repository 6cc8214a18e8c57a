import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from eventide.llm import repair
from eventide.llm.oracle import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string"
LETTERS = {0: "t", 1: "s", 2: "u", 3: "a"}


def cheapest(kinds):
    """(cost, audit) by trying all edits with up to two inserts in each gap."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    own = []
    for kind in kinds:
        initial, fault = LETTERS[kind // 4], repair.FAULTS[kind % 4]
        ways = [("D", "", 2)]
        if fault in ("none", "truncated"):
            more = 5 * (fault == "truncated")
            ways += [("K", initial, more), ("R", "u", 1 + more), ("R", "a", 1 + more)]
        own.append([("I" * len(g) + letter, g + role, 5 * len(g) + cost) for g in gaps for letter, role, cost in ways])
    own.append([("I" * len(g), g, 5 * len(g)) for g in gaps])
    for way in itertools.product(*own):
        if re.fullmatch("(s?(ua)+)?", "".join(w[1] for w in way)):
            found = sum(w[2] for w in way), "".join(w[0] for w in way)
            best = found if best is None or found < best else best
    return best


def plain(kinds):
    """The same over one table of all rows and states."""
    best = {0: (0, "")}
    for kind in kinds:
        new = {}
        for state, (cost, audit) in best.items():
            for after, (more, letters) in repair.EDITS[kind][state].items():
                way = cost + more, audit + letters
                new[after] = min(new.get(after, way), way)
        best = new
    return min((c + repair.ENDS[s][3][0], a + repair.ENDS[s][3][1]) for s, (c, a) in best.items())


def divided(kinds, cuts=()):
    """The operator's way: pieces, crossings between them, crossings inside."""
    steps, edges = repair.row_steps(), [0, *sorted(cuts), len(kinds)]
    parts = [kinds[a:b] for a, b in itertools.pairwise(edges) if a < b]
    whole = [repair.Step(repair.run_of([steps[k] for k in p])) for p in parts] + [repair.Step(repair.ranked(repair.ENDS))]
    at = repair.crossings(whole, 0, 3)
    audit = ""
    for part, a, b in zip(parts, at, at[1:], strict=False):
        states = repair.crossings([steps[k] for k in part], a, b)
        audit += "".join(repair.EDITS[k][x][y][1] for k, x, y in zip(part, states, states[1:], strict=False))
    return audit + repair.ENDS[at[-2]][3][1]


def test_short_conversations_equal_all_edits():
    rng = random.Random(4)
    cases = [[], *[[k] for k in range(16)], *itertools.product(range(0, 16, 3), repeat=2)]
    cases += [[rng.choice([4, 8, 12, 8, 12, rng.randrange(16)]) for _ in range(3)] for _ in range(12)]
    for kinds in cases:
        cost, audit = cheapest(kinds)
        assert plain(kinds) == (cost, audit), kinds
        assert divided(list(kinds)) == audit, kinds


def test_long_conversations_and_any_pieces():
    rng = random.Random(5)
    for _ in range(200):
        kinds = [rng.choice([8, 12, 8, 12, 4, rng.randrange(16)]) for _ in range(rng.randrange(1, 90))]
        cuts = rng.sample(range(len(kinds)), min(len(kinds), rng.randrange(5)))
        assert divided(kinds, cuts) == plain(kinds)[1]


def expected(rows):
    """conv_id -> report, in plain Python, for damaged rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        def order(r):
            role, text = r[2], r[3]
            size = lambda x: "null" if x is None else f"{len(str(x).encode())}:{x}"
            same = hashlib.md5((size(role) + size(text)).encode()).hexdigest().upper()
            return r[1] is not None, r[1] or 0, hashlib.md5((size(r[0]) + size(r[1]) + "32:" + same).encode()).digest()

        mine = sorted((r for r in rows if r[0] == conv), key=order)
        seen, kinds = set(), []
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in mine:
            bare = text.rstrip(repair.BLANKS)
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            kinds.append(4 * repair.INITIALS.get(role[:1], 0) + fault)
            if fault:
                counts[repair.FAULTS[fault]] += 1
        cost, audit = plain(kinds)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        lines, state, row = [], "", 0
        for letter in audit:
            role = "assistant" if state == "u" else "user"
            if letter == "I":
                lines.append(role + ":")
                state = role[0]
                continue
            _, _, own, text = mine[row]
            row += 1
            if letter != "D":
                role = own if letter == "K" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def odd_conversations():
    rng = random.Random(8)
    say = lambda: rng.choice(["yes.", "no!", "why?", "cut off", " \t ", "", "é 中文 😀.", None])
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    rows = [(c, t, rng.choice(roles), say()) for c in range(60) for t in range(rng.randrange(9))]
    rows += [(None, t, rng.choice(roles), say()) for t in range(30)] + [(7, None, "user", f"t{i}.") for i in range(4)]
    rows += [(8, 3, "user", "tie b."), (8, 3, "user", "tie a."), (8, 3, "assistant", "tie c."), (8, 3, "user", "tie b.")]
    rows += [(9, 2**62, "user", "far."), (9, -(2**61), "system", "x" * 70_000)] + [(50, None, None, None)] * 3
    return rows


def result(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r[0]: tuple(r)[1:] for r in repair.audited(repair.damaged(df), df).collect()}


def test_query_equals_plain_python(spark):
    rows = odd_conversations()
    found, right = result(spark, rows), expected(damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert found == {c: right.get(c, nothing) for c in {r[0] for r in rows}}


def test_query_equals_sql_on_odd_rows(spark):
    import duckdb
    import pandas as pd

    rows = odd_conversations()
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    found = result(spark, rows)
    assert {r[0]: tuple(r[1:]) for r in con.execute(ORACLE_SQL["op12_hirschberg_repair"]).fetchall()} == found


def test_a_conversation_over_many_pieces(spark):
    rng = random.Random(2)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["ok.", f"{t} cut", f"{t}."])) for t in range(4000)]
    rows += [(None, 1, "user", "the same.")] * 3000
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        assert result(spark, rows) == expected(damage(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_turns_and_extra_columns(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "again."), (2, 0, "assistant", "so.")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("extra").alias(c) for c in ("part", "piece", "at", "audit", "_key", "_same", "edit")])
    turns, reports = repair.repaired(df)
    out = [tuple(r) for r in turns.orderBy("conv_id", "part", "piece", "at").select("conv_id", "role", "text", "edit").collect()]
    assert out == [(1, "user", "hi.", "K"), (1, "assistant", "again.", "R")]
    assert {r.conv_id: (r.cost, r.audit) for r in reports.collect()} == {1: (1, "KR"), 2: (2, "D")}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair.audited(repair.damaged(df), df).collect() == []


@pytest.mark.parametrize("kinds", [[], [4], [12, 12, 12], [9, 9]])
def test_audit_gives_the_pattern(kinds):
    audit, state, roles = divided(kinds), 0, ""
    assert len(audit.replace("I", "")) == len(kinds)
    rows = iter(kinds)
    for letter in audit:
        kind = 0 if letter == "I" else next(rows)
        if letter != "D":
            state = kind // 4 if letter == "K" else repair.FOLLOWS[state][-1]
            roles += LETTERS[state]
    assert re.fullmatch("(s?(ua)+)?", roles)
