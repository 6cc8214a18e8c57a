"""Structure repair of conversations at least cost (operator 12).

A conversation's rows come in the order of their turns (nulls first; ties by a hash
of role and text). Edits turn them into one whose roles begin with
``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert an
empty user or assistant turn 5; a truncated row that is not deleted costs 5
more, blank and duplicate rows must be deleted. The audit is the string of the
edits' initials; of several cheapest ones, the least.

The roles so far are one of four states: nothing, system, user, assistant. A row
(the inserts before it and its own edit) is a step from state to state, and so
is any run of rows. Divide and conquer after Hirschberg, in linear space: costs
from the front and costs from the back meet in the middle of a run, the state
with the least sum is where the best edits cross, and both halves are solved
alone. For ties, the vector from the front also ranks the states by their least
audits. Two of them are never prefixes of one another, since each ends with the
edit of the same row, so ranks are all it takes to compare longer ones.

Nothing holds a conversation: the rows are sorted by range, so that a long one
lies in many tasks, and cut into pieces of at most one Arrow batch. Tasks turn
pieces into steps; the steps of a conversation (a few numbers a piece) meet in
one task that finds the crossings at the pieces' borders; tasks then solve the
pieces. Texts stay out of it: they are joined to the edits in the end.

Nulls in role and text read as one space, rows without conversation id are one
conversation, repeated rows are duplicates. Empty texts are blank. Extra columns are
not read, an empty table gives no rows. Long texts are read in the JVM only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import kept

#: The states, and which initials may follow in each.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAULTS = ("none", "blank", "duplicate", "truncated")
BLANKS = " \t\n\x0b\f\r"
SALTS = 32

Cell = tuple[int, int]  # cost; rank of the least audit among the cells it is compared with
Vector = tuple["Cell | None", ...]  # by state


def start_at(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


class Step:
    """From state to state: ``table[before][after]`` is a cell or None, ranked along ``after``."""

    def __init__(self, table: tuple[Vector, ...]):
        self.table = table
        self.ahead: dict[Vector, tuple[Vector, int]] = {}
        self.behind: dict[tuple, tuple] = {}

    def forward(self, before: Vector) -> tuple[Vector, int]:
        """The vector after the step, its least cost taken off, and that cost."""
        known = self.ahead.get(before)
        if known is None:
            best = {}
            for after in range(4):
                ways = [
                    (cell[0] + own[after][0], cell[1], own[after][1]) for cell, own in zip(before, self.table, strict=True) if cell and own[after]
                ]
                if ways:
                    best[after] = min(ways)
            order = sorted(best, key=lambda s: best[s][1:])
            least = min(c for c, *_ in best.values()) if best else 0
            known = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4)), least
            self.ahead[before] = known
        return known

    def backward(self, after: tuple) -> tuple:
        """Costs from each state before the step to the end, the least taken off."""
        known = self.behind.get(after)
        if known is None:
            costs = []
            for own in self.table:
                ways = [cell[0] + cost for cell, cost in zip(own, after, strict=True) if cell and cost is not None]
                costs.append(min(ways) if ways else None)
            least = min((c for c in costs if c is not None), default=0)
            known = self.behind[after] = tuple(None if c is None else c - least for c in costs)
        return known


def run_of(steps: list[Step]) -> tuple[Vector, ...]:
    """The table of some steps in a row."""
    out = []
    for state in range(4):
        vector, total = start_at(state), 0
        for step in steps:
            vector, cost = step.forward(vector)
            total += cost
        out.append(tuple(cell and (cell[0] + total, cell[1]) for cell in vector))
    return tuple(out)


def crossings(steps: list[Step], first: int, last: int) -> list[int]:
    """The state before each step and after the last of the cheapest way from
    ``first`` to ``last`` with the least audit."""
    states = [first] * len(steps) + [last]
    runs = [(0, len(steps))]
    while runs:
        lo, hi = runs.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        front, back = start_at(states[lo]), tuple(0 if s == states[hi] else None for s in range(4))
        for step in steps[lo:mid]:
            front = step.forward(front)[0]
        for at in range(hi - 1, mid - 1, -1):
            back = steps[at].backward(back)
        states[mid] = min((front[s][0] + back[s], front[s][1], s) for s in range(4) if front[s] and back[s] is not None)[2]
        runs += [(lo, mid), (mid, hi)]
    return states


def ranked(rows: list[dict[int, tuple[int, str]]]) -> tuple[Vector, ...]:
    """Cells of (cost, audit) by state."""
    out = []
    for row in rows:
        order = sorted(row, key=lambda s: row[s][1])
        out.append(tuple((row[s][0], order.index(s)) if s in row else None for s in range(4)))
    return tuple(out)


def edits_of(initial: int, fault: int) -> list[dict[int, tuple[int, str]]]:
    """Of each state before a row: the states after it, with cost and audit."""
    out = []
    for before in range(4):
        row: dict[int, tuple[int, str]] = {}
        state = before
        for inserts in range(3):  # a third would lead back to where one has led
            ways = [(state, DELETE, "D")]
            if FAULTS[fault] in ("none", "truncated"):
                more = TRUNCATED if FAULTS[fault] == "truncated" else 0
                if initial in FOLLOWS[state]:
                    ways.append((initial, more, "K"))
                ways += [(role, REROLE + more, "R") for role in FOLLOWS[state] if role in ROLES]
            for after, cost, letter in ways:
                way = (cost + INSERT * inserts, "I" * inserts + letter)
                row[after] = min(row.get(after, way), way)
            state = FOLLOWS[state][-1]
        out.append(row)
    return out


#: By kind of row: 4 * initial (0: none of the three) + fault.
EDITS = [edits_of(kind // 4, kind % 4) for kind in range(16)]
#: What is still to insert at a conversation's end; all ends count as ASSISTANT.
ENDS = [{ASSISTANT: (0, "")}, {ASSISTANT: (2 * INSERT, "II")}, {ASSISTANT: (INSERT, "I")}, {ASSISTANT: (0, "")}]


def row_steps() -> list[Step]:
    return [Step(ranked(e)) for e in EDITS]


def turns_of(before: int, after: int, audit: str) -> Iterator[tuple[str, str | None]]:
    """(edit, role that it gives) of the turns that the edits of one row leave."""
    state = before
    for letter in audit:
        if letter == "I":
            state = FOLLOWS[state][-1]
            yield letter, ROLES[state]
        elif letter != "D":
            yield letter, ROLES[after] if letter == "R" else None


def hashed(*parts: Column) -> Column:
    """16 bytes that tell lists of texts and nulls apart."""
    cells = [p.cast("string") for p in parts]
    sized = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("null")) for c in cells]
    return F.unhex(F.md5(F.concat(*sized).cast("binary")))


def keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls in the last two read as one space), _same
    (equal where role and text are) and _key (equal for equal rows)."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *texts)
    rows = rows.withColumn("_same", hashed(F.col("role"), F.col("text")))
    return rows.withColumn("_key", hashed(F.col("conv_id"), F.col("turn"), F.hex("_same")))


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, _key, _kind (see EDITS) of keyed rows, sorted by range.

    The first of equal rows is found in two windows: inside salts, then among the
    first ones of the salts, so that no task holds all copies of a frequent turn."""
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.lit(0)
    for letter, state in INITIALS.items():
        code = F.when(initial == letter, state).otherwise(code)
    narrow = rows.select(
        "conv_id", "turn", "_same", "_key", code.alias("_initial"), (bare == "").alias("_blank"),
        (~F.substring(bare, -1, 1).isin(*".!?")).alias("_cut"), F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("_row")]
    salt = F.pmod(F.hash("_row"), F.lit(SALTS))
    place = F.row_number().over(Window.partitionBy("conv_id", "_same", "_salt").orderBy(*order))
    dealt = narrow.withColumn("_salt", salt).withColumn("_salt", F.when(place == 1, -1).otherwise(F.col("_salt")))
    first = (F.row_number().over(Window.partitionBy("conv_id", "_same", "_salt").orderBy(*order)) == 1) & (F.col("_salt") == -1)
    fault = F.when(F.col("_blank"), 1).when(~first, 2).when(F.col("_cut"), 3).otherwise(0)
    found = dealt.withColumn("_kind", (4 * F.col("_initial") + fault).cast("byte"))
    by = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("_key"), F.col("_row")]
    return found.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "turn", "_key", "_kind")


PIECE = (
    "conv_id long, piece long, kinds array<byte>, keys array<binary>, low long, high long, turns long, "
    "blank long, duplicate long, truncated long, illegal long"
)


def pieces(rows: DataFrame) -> DataFrame:
    """One row for each run of rows of one conversation in one Arrow batch of sorted
    rows: kinds and keys in order, its least and largest turn, how many turns,
    its faults and the neighbours in it that do not follow one another."""
    legal = np.zeros((4, 4), bool)
    for before, after in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
        legal[before, after] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, no_id = batch.column("conv_id").fill_null(0).to_numpy(), batch.column("conv_id").is_null().to_numpy(zero_copy_only=False)
            turns, no_turn = batch.column("turn").fill_null(0).to_numpy(), batch.column("turn").is_null().to_numpy(zero_copy_only=False)
            kinds = batch.column("_kind").to_numpy()
            new = np.append(True, (ids[1:] != ids[:-1]) | (no_id[1:] != no_id[:-1]))
            first = np.flatnonzero(new)
            ends = np.append(first[1:], batch.num_rows)
            offsets = pa.array(np.append(first, batch.num_rows), pa.int32())
            count = lambda flags: pa.array(np.add.reduceat(flags.astype(np.int64), first))
            lows = first + np.add.reduceat(no_turn.astype(np.int64), first)  # nulls come first
            none = lows == ends
            wrong = ~legal[np.append(0, kinds[:-1] // 4), kinds // 4] & ~new
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(pa.array(first)), pa.array(np.arange(at, at + len(first))),
                    pa.ListArray.from_arrays(offsets, batch.column("_kind")), pa.ListArray.from_arrays(offsets, batch.column("_key")),
                    pa.array(turns[np.minimum(lows, ends - 1)], mask=none), pa.array(turns[ends - 1], mask=none),
                    count((new | (turns != np.append(0, turns[:-1])) | np.append(True, no_turn[:-1])) & ~no_turn),
                    *[count(kinds % 4 == f) for f in (1, 2, 3)], count(wrong),
                ],
                names=["conv_id", "piece", "kinds", "keys", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal"],
            )
            at += len(first)

    found = rows.mapInArrow(run, PIECE)
    return kept(found.withColumn("part", F.spark_partition_id().cast("long")))


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each conversation, from rows sorted by conversation."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv_id"] != row["conv_id"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def meetings(found: DataFrame) -> DataFrame:
    """conv_id, part, piece, before, after (the states at a piece's borders), tail
    (inserts after it), and on a conversation's first piece its gaps and cost
    and the illegal neighbours across borders."""
    summary = "conv_id long, part long, piece long, cells array<int>, first int, last int, low long, high long, turns long"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = row_steps()
        for batch in batches:
            cells, ends = [], []
            for kinds in batch.column("kinds").to_pylist():
                table = run_of([steps[k] for k in kinds])
                cells.append([x for row in table for cell in row for x in (cell or (-1, -1))])
                ends.append((kinds[0] // 4, kinds[-1] // 4))
            more = [pa.array(cells, pa.list_(pa.int32())), *[pa.array([e[i] for e in ends], pa.int32()) for i in (0, 1)]]
            names = ["conv_id", "part", "piece"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *more, *[batch.column(c) for c in ("low", "high", "turns")]],
                names=[*names, "cells", "first", "last", "low", "high", "turns"],
            )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = Step(ranked(ENDS))
        for rows in grouped(batches):
            steps = []
            for row in rows:
                pairs = list(zip(row["cells"][::2], row["cells"][1::2], strict=True))
                cells = [None if c < 0 else (c, r) for c, r in pairs]
                steps.append(Step(tuple(tuple(cells[4 * s : 4 * s + 4]) for s in range(4))))
            steps.append(end)
            states = crossings(steps, NOTHING, ASSISTANT)
            vector, cost = start_at(NOTHING), 0
            for step in steps:
                vector, more = step.forward(vector)
                cost += more
            timed = [r for r in rows if r["turns"]]
            again = sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:], strict=False))
            gaps = timed[-1]["high"] - timed[0]["low"] + 1 - (sum(r["turns"] for r in timed) - again) if timed else 0
            wrong = sum(b["first"] not in FOLLOWS[a["last"]] or not a["last"] for a, b in zip(rows, rows[1:], strict=False))
            n, rest = len(rows), [None] * (len(rows) - 1)
            tail = len(ENDS[states[-2]][ASSISTANT][1])
            columns = {
                **{c: [r[c] for r in rows] for c in ("conv_id", "part", "piece")}, "before": states[:n], "after": states[1 : n + 1],
                "tail": [0] * (n - 1) + [tail], "gaps": [min(gaps, 2**63 - 1), *rest], "cost": [cost, *rest], "across": [wrong, *rest],
            }
            yield pa.RecordBatch.from_pydict(columns, schema)

    schema = pa.schema([*[(c, pa.int64()) for c in ("conv_id", "part", "piece")], *[(c, pa.int32()) for c in ("before", "after", "tail")],
                        *[(c, pa.int64()) for c in ("gaps", "cost", "across")]])
    by = ["conv_id", "part", "piece"]
    narrow = found.mapInArrow(summed, summary).repartition("conv_id").sortWithinPartitions(*by)
    return narrow.mapInArrow(met, "conv_id long, part long, piece long, before int, after int, tail int, gaps long, cost long, across long")


def solved(found: DataFrame, met: DataFrame) -> DataFrame:
    """conv_id, part, piece, audit, turns (in order: edit, role where it is not the
    row's own, key of the row) of each piece."""
    turn = pa.struct([("edit", pa.string()), ("role", pa.string()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = row_steps()
        for batch in batches:
            audits, turns = [], []
            for row in batch.select(["kinds", "keys", "before", "after", "tail"]).to_pylist():
                states = crossings([steps[k] for k in row["kinds"]], row["before"], row["after"])
                letters = [EDITS[k][a][b][1] for k, a, b in zip(row["kinds"], states, states[1:], strict=False)]
                out = [
                    {"edit": edit, "role": role, "key": None if edit == "I" else key}
                    for a, b, audit, key in zip(states, states[1:], letters, row["keys"], strict=False)
                    for edit, role in turns_of(a, b, audit)
                ]
                tail = "I" * row["tail"]
                out += [{"edit": edit, "role": role, "key": None} for edit, role in turns_of(states[-1], ASSISTANT, tail)]
                audits.append("".join(letters) + tail)
                turns.append(out)
            names = ["conv_id", "part", "piece"]
            more = [pa.array(audits, pa.string()), pa.array(turns, pa.list_(turn))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more], names=[*names, "audit", "turns"])

    states = met.select("part", "piece", "before", "after", "tail")
    joined = found.select("conv_id", "part", "piece", "kinds", "keys").join(states, ["part", "piece"])
    return kept(joined.mapInArrow(run, "conv_id long, part long, piece long, audit string, turns array<struct<edit: string, role: string, key: binary>>"))


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired turns: conv_id, part, piece, at (their order), role, text, edit;
    and the reports of all conversations with rows: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit."""
    rows = keyed(rows)
    found = pieces(judged(rows))
    met = kept(meetings(found))
    done = solved(found, met)
    turns = done.select("conv_id", "part", "piece", F.posexplode("turns").alias("at", "turn"))
    turns = turns.select("conv_id", "part", "piece", "at", "turn.edit", F.col("turn.role").alias("_role"), F.col("turn.key").alias("_key"))
    # One text a key, merged before the shuffle: a frequent row is no hot key.
    texts = rows.groupBy("_key").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    own = turns.where("_key is not null").join(texts, "_key").select("conv_id", "part", "piece", "at", F.coalesce("_role", "role").alias("role"), "text", "edit")
    new = turns.where("_key is null").select("conv_id", "part", "piece", "at", F.col("_role").alias("role"), F.lit("").alias("text"), "edit")
    counts = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "piece", "audit"))), lambda x: x["audit"]), "")
    parts = found.select("conv_id", "part", "piece", "blank", "duplicate", "truncated", "illegal")
    parts = parts.join(met.drop("conv_id"), ["part", "piece"]).join(done.select("part", "piece", "audit"), ["part", "piece"])
    illegal = (F.sum("illegal") + F.sum("across")).alias("illegal")
    reports = parts.groupBy("conv_id").agg(F.max("gaps").alias("gaps"), *counts, illegal, F.max("cost").alias("cost"), audit.alias("audit"))
    return own.unionByName(new), reports


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 (of "role:text" lines). The turns of a conversation
    stream through one task, for a digest has to; it holds one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([sha.hexdigest()])], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if sha is not None and conv == now:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        yield out()
                    now, sha = conv, hashlib.sha256()
                sha.update(line.encode())
        if sha is not None:
            yield out()

    by = ["conv_id", "part", "piece", "at"]
    lines = turns.select(*by, F.concat("role", F.lit(":"), "text").alias("_line")).repartition("conv_id").sortWithinPartitions(*by)
    return lines.select("conv_id", "_line").mapInArrow(run, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults of known kinds, chosen by the crc32 of "conv_id:turn" (nulls: one space)."""
    space = F.lit(" ")
    filled = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    filled = filled.withColumn("_fault", F.crc32(name.cast("binary")) % 20)
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return filled.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")


def audited(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Reports and digests of all conversations in ``ids``; zeros, an empty audit and
    the digest of nothing for those without rows."""
    turns, reports = repaired(rows)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    all_of = reports.unionByName(digests(turns), allowMissingColumns=True).unionByName(ids.select(F.col("conv_id").cast("long")).distinct(), allowMissingColumns=True)
    return all_of.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
