"""Chat formatting over prefix trees (operator 7).

Every conversation is a path of formatted turns. Conversations that begin with
the same turns share those nodes: sorted by their turns, a conversation adds
only what lies beyond its common prefix with the one before it, so shared
tokens are emitted once, depth-first. Each node carries its place in the
emitted sequence, the position id its first token has within its conversation
(the tokens of its ancestors), the span under the loss mask, and the intervals
of the sequence that its tokens may attend to: its ancestors, adjoining
intervals merged. A token is a code point here; nodes never split a token of a
tokenizer that is run per turn.

Sequences are packs of about ``PACK_TOKENS`` tokens, each a forest of its own, so
that a pack can be read, or trained on, alone. A first turn that a third of all
conversations share is emitted once in each pack and never gathers its
conversations in one task: they are sorted by range of their whole paths.
Equal conversations are one path with several owners; only their keys are
joined back, a key with many owners in parts (``of_owners``). Which conversations
are equal is found from a digest a turn; texts are shuffled to meet their
conversation, of equal ones those of one, and to be sorted.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts each
``<|`` (with any backslashes in between) gets one more backslash, so no control
string can come from a text, and one less gives the text back. In roles,
backslash and newline are escaped as well. Loss: the text of assistant turns.

Definitions: rows are ordered by turn, ties by role and text; null texts and
roles are empty; rows without a conv_id form one conversation without an id.
Repeated rows are turns like any other. Extra columns are not read. A
conversation is one record: it is held whole, like a document's text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept, small

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PACK_TOKENS = 1 << 16
LEARNED_ROLE = "assistant"
OWNERS = 100_000  # of one key that a task is given


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def role_line(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(line))


def segment(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and its span under the loss mask (empty: none)."""
    head, body = f"{OPEN}{role_line(role)}\n", escaped(text)
    learned = len(body) if role == LEARNED_ROLE else 0
    return head + body + CLOSE, len(head), len(head) + learned


NODE = pa.struct([
    ("pack", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("parent", pa.int64()), ("position", pa.int64()),
    ("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("segment", pa.string()), ("conversations", pa.list_(pa.string())),
])
NODE_SCHEMA = (
    "pack string, start long, end long, parent long, position long, attends array<struct<start: long, end: long>>, "
    "loss_start long, loss_end long, segment string, conversations array<string>"
)


class Packer:
    """Turns paths in sorted order into the nodes of one pack after another."""

    def __init__(self, pack_tokens: int):
        self.pack_tokens, self.nodes, self.path, self.turns, self.size = pack_tokens, [], [], [], 0

    def add(self, key: str, hashes: list[str], turns: list[dict]) -> list[dict]:
        """Adds a path; returns the nodes of the pack that is full, if any."""
        done = []
        if self.size >= self.pack_tokens:
            done = self.close()
        if not self.nodes:
            self.pack = key
        shared = 0
        while shared < min(len(hashes), len(self.path)) and hashes[shared] == self.path[shared]:
            shared += 1
        del self.path[shared:], self.turns[shared:]
        for h, turn in zip(hashes[shared:], turns[shared:], strict=True):
            text, lo, hi = segment(turn["role"], turn["text"])
            parent = self.nodes[self.turns[-1]] if self.turns else None
            attends, position = [], 0
            if parent:
                position = parent["position"] + parent["end"] - parent["start"]
                attends = [dict(x) for x in parent["attends"]]
                if attends and attends[-1]["end"] == parent["start"]:
                    attends[-1]["end"] = parent["end"]
                else:
                    attends.append({"start": parent["start"], "end": parent["end"]})
            node = {
                "pack": self.pack, "start": self.size, "end": self.size + len(text), "parent": parent["start"] if parent else -1,
                "position": position, "attends": attends, "loss_start": self.size + lo, "loss_end": self.size + hi, "segment": text,
                "conversations": [],
            }
            self.path.append(h)
            self.turns.append(len(self.nodes))
            self.nodes.append(node)
            self.size += len(text)
        self.nodes[self.turns[-1]]["conversations"].append(key)
        return done

    def close(self) -> list[dict]:
        done = self.nodes
        self.nodes, self.path, self.turns, self.size = [], [], [], 0
        return done


def turns_of(rows: DataFrame) -> DataFrame:
    """conv (the id as text, "none" without one), conv_id, turn, role, text, one (the turn's digest)."""
    turns = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv"), "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return turns.withColumn("one", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def keyed(turns: DataFrame) -> DataFrame:
    """conv, conv_id, key: one row per conversation, from digests alone.

    Rows that share a turn are put in order of their digests here, and in order
    of role and text in the path, so a key says which turns are shared: equal
    keys are equal conversations."""
    whole = turns.groupBy("conv").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("turn", "one"))).alias("t"))
    tied = lambda t, i: (i > 0) & t["turn"].eqNullSafe(F.get("t", F.when(i > 0, i - 1))["turn"])
    marked = F.transform("t", lambda t, i: F.concat(F.when(tied(t, i), "=").otherwise(""), t["one"]))
    return whole.select("conv", "conv_id", F.md5(F.concat_ws(",", marked).cast("binary")).alias("key"))


def paths_of(turns: DataFrame) -> DataFrame:
    """key, path (a digest per turn), turns: one row per conversation."""
    whole = turns.groupBy("conv", "key").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "one"))).alias("t"))
    return whole.select("key", F.col("t.one").alias("path"), F.transform("t", lambda t: F.struct(t["role"], t["text"])).alias("turns"))


def packed(paths: DataFrame, pack_tokens: int = PACK_TOKENS) -> DataFrame:
    """The nodes of all packs, each pack's in depth-first order, from rows with
    distinct keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(pack_tokens)
        for batch in batches:
            for i in range(batch.num_rows):
                key, path, turns = (batch.column(c)[i].as_py() for c in range(3))
                if done := packer.add(key, path, turns):
                    yield pa.RecordBatch.from_struct_array(pa.array(done, NODE))
        if done := packer.close():
            yield pa.RecordBatch.from_struct_array(pa.array(done, NODE))

    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = paths.select("key", "path", "turns").repartitionByRange(n, "path").sortWithinPartitions("path")
    return ordered.mapInArrow(run, NODE_SCHEMA)


def read_pack(nodes: list[dict]) -> Iterator[tuple[str, list[tuple[str, str]], str, int]]:
    """(key, turns, text under the loss mask, tokens) of each conversation of a
    pack, from the emitted sequence, the intervals and the mask alone."""
    text = "".join(n["segment"] for n in nodes)
    learned = {n["start"]: text[n["loss_start"] : n["loss_end"]] for n in nodes}
    starts = {n["start"]: n["end"] for n in nodes}
    for node in nodes:
        if not node["conversations"]:
            continue
        spans = [(x["start"], x["end"]) for x in node["attends"]] + [(node["start"], node["end"])]
        whole = "".join(text[s:e] for s, e in spans)
        if len(whole) != node["position"] + node["end"] - node["start"]:
            raise ValueError("position ids and attention intervals disagree")
        turns = []
        for part in whole.split(OPEN)[1:]:
            role, _, body = part.partition("\n")
            turns.append((role_of(role), unescaped(body[: -len(CLOSE)])))
        loss = []
        for s, e in spans:
            while s < e:
                loss.append(unescaped(learned[s]))
                s = starts[s]
        for key in node["conversations"]:
            yield key, turns, "".join(loss), len(whole)


def read_back(nodes: DataFrame) -> DataFrame:
    """key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read
    from the packs partition by partition; a pack lies whole and in order there."""

    def rows(pack: list[dict]) -> pa.RecordBatch:
        out = []
        for key, turns, loss, size in read_pack(pack):
            every = "".join(f"{role}\n{text}\n" for role, text in turns)
            out.append((key, len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
        names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for node in batch.to_pylist():
                if held and held[0]["pack"] != node["pack"]:
                    yield rows(held)
                    held = []
                held.append(node)
        if held:
            yield rows(held)

    return nodes.mapInArrow(run, "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(rows: DataFrame, pack_tokens: int = PACK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(owners, nodes): conv_id and key of every conversation, and the packs.

    Of equal conversations one goes into the trees. Only ids and keys are
    stored to find it."""
    turns = turns_of(rows)
    owners = kept(keyed(turns))
    one = owners.groupBy("key").agg(F.min("conv").alias("conv"))
    return owners.select("conv_id", "key"), packed(paths_of(turns.join(one, "conv")), pack_tokens)


def of_owners(owners: DataFrame, found: DataFrame, most: int = OWNERS) -> DataFrame:
    """``found``, a row a key, for every owner: conv_id and the columns of ``found``
    but key. A key with more than ``most`` owners is joined in parts."""
    parts = owners.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_parts")).where("_parts > 1")
    parts = small(kept(parts))
    n = F.coalesce("_parts", F.lit(1))
    left = owners.join(parts, "key", "left").select("conv_id", "key", F.pmod(F.xxhash64("conv_id"), n).cast("int").alias("_part"))
    right = found.join(parts, "key", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1)))
    return left.join(right, ["key", "_part"]).select("conv_id", *[c for c in found.columns if c != "key"])
