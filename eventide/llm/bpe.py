"""BPE encoding and decoding by prefix-sharing tries (operator 13).

For tokenizer files with byte-level BPE and word ends (a suffix on a word's last
symbol). Words are encoded together, not one by one:

* The distinct words of some texts go into a radix trie of their bytes. A word's
  last byte hangs off the node of the bytes before it, as it is another symbol.
* The encoding of a prefix ends in exactly one token: the one that ends there
  and is ``compatible`` with the last token of the prefix before it. Two tokens
  are compatible if no merge joins them across their border before either has
  been formed. So the last token of each prefix is all there is to know.
* A depth-first walk propagates these states: the prefix that many words share
  gets its states once, and a word's encoding is read off backwards.

Texts are normalized (NFC, lower case), split at the special strings and into
words as the file says. Characters that this Python and the file's library class
alike are split by a regular expression, texts with any other character by the
library's own pre-tokenizer. Nothing is shuffled, a lost task is repeated alone.

Null and empty texts have no tokens. Long texts are cut at blanks, where no word
and no composition crosses, so that memory does not grow with a text but for its
ids. Repeated rows are encoded one by one; extra columns are not read; empty
tables give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property
from itertools import chain
from math import inf
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import worker_cache
from .words import blocks

PIECE_CHARS = 1 << 20
HELD_WORDS = 1 << 19
LONG_WORD = 64  # longer ones are not held
HELD_PAIRS = 1 << 20
PAIR_BITS = 32
BLANK = regex.compile(r"[ \n]")

# The word pattern of such files, and the same for texts of these letters only.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NOT_PLAIN = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]")
PLAIN_WORDS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9\xdf-\xf6\xf8-\xff]+")


def byte_symbols() -> dict[str, int]:
    """Byte of each symbol of byte-level files: printable Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Tokens as bytes, and which of them may follow one another."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[tuple[str, str]], suffix: str):
        byte, size = byte_symbols(), max(vocab.values()) + 1
        self.content = [b""] * size
        self.inside: dict[bytes, int] = {}  # tokens that end before the word's last byte
        self.final: dict[bytes, int] = {}  # tokens that end a word
        self.rank: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        parts: list[tuple[int, int] | None] = [None] * size
        formed = {a + b for a, b in merges}
        if len(formed) < len(merges):
            raise ValueError("two merges form the same token")
        ends = [False] * size
        for text, token in vocab.items():
            if text not in formed:
                symbol = text.removesuffix(suffix)
                self.content[token], ends[token] = bytes([byte[symbol]]), symbol != text
        for rank, (a, b) in enumerate(merges):
            token, x, y = vocab[a + b], vocab[a], vocab[b]
            if not (self.content[x] and self.content[y]):
                raise ValueError("a merge comes before its parts")
            self.rank[x, y], parts[token] = rank, (x, y)
            self.content[token], ends[token] = self.content[x] + self.content[y], ends[y]
        for token, content in enumerate(self.content):
            if content:
                (self.final if ends[token] else self.inside)[content] = token
        # An automaton of the tokens' prefixes, made as texts need it: its state is the longest one that ends here.
        self.prefixes = {c[:i] for c in self.inside for i in range(len(c) + 1)} | {c[:i] for c in self.final for i in range(len(c))}
        self.runs: list[bytes] = [b""]
        self.state: dict[bytes, int] = {b"": 0}
        self.ends: list[list[tuple[int, int]]] = [[]]  # of a state: tokens that end here, and their sizes
        self.moves: dict[int, int] = {}
        self.last_ones: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.left_spine = [self.spine(parts, t, 0) for t in range(size)]
        self.right_spine = [self.spine(parts, t, 1) for t in range(size)]

    def spine(self, parts: list[tuple[int, int] | None], token: int, side: int) -> list[tuple[int, float]]:
        """What stands at one border of the token while it is formed, from the first
        byte on, each with the rank of the merge that takes it in."""
        out, until = [], inf
        while parts[token]:
            out.append((token, until))
            until, token = self.rank[parts[token]], parts[token][side]
        return [*out, (token, until)][::-1]

    def compatible(self, pair: int) -> bool:
        """Whether the bytes of two tokens in a row stay these tokens: over the time of merging, no two neighbours at the border merge before one of them is
        taken in on its own side. Of equal ranks the left one goes first."""
        left, right, i, j = self.right_spine[pair >> PAIR_BITS], self.left_spine[pair & (1 << PAIR_BITS) - 1], 0, 0
        known = True
        while known:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = self.rank.get((x, y), inf)
            known = not (rank < x_until and rank <= y_until and rank < inf)
            if x_until == y_until == inf:
                break
            if x_until <= y_until:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= HELD_PAIRS:
            self.pairs.clear()
        self.pairs[pair] = known
        return known

    def move(self, state: int, byte: int) -> int:
        run = self.runs[state] + bytes([byte])
        while run not in self.prefixes:
            run = run[1:]
        to = self.state.get(run)
        if to is None:
            to = self.state[run] = len(self.runs)
            self.runs.append(run)
            self.ends.append(self.suffixes(run, self.inside))
        self.moves[state << 8 | byte] = to
        return to

    @staticmethod
    def suffixes(run: bytes, tokens: dict[bytes, int]) -> list[tuple[int, int]]:
        return [(tokens[run[i:]], len(run) - i) for i in range(len(run)) if run[i:] in tokens]

    def finals(self, state: int, byte: int) -> list[tuple[int, int]]:
        found = self.last_ones.get((state, byte))
        if found is None:
            found = self.last_ones[state, byte] = self.suffixes(self.runs[state] + bytes([byte]), self.final)
        return found


class Node:
    """A run of bytes from a depth on, the nodes below, and the last bytes of the
    words that end one byte after it."""

    __slots__ = ("below", "depth", "finals", "run")

    def __init__(self, depth: int, run: bytes, below: list[Node], finals: list[int]):
        self.depth, self.run, self.below, self.finals = depth, run, below, finals


def shared_size(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0  # a[:lo] == b[:lo]
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


class Trie:
    """A radix trie of words. They are inserted in order, so a word leaves the way
    down to the one before it where their common prefix ends."""

    def __init__(self, words: Iterable[bytes]):
        self.root = Node(0, b"", [], [])
        way, before = [self.root], b""
        for word in sorted(words, key=lambda w: w[:-1]):
            stem = word[:-1]
            if stem != before:
                shared = shared_size(before, stem)
                while way[-1].depth >= shared and len(way) > 1:
                    way.pop()
                node = way[-1]
                cut = shared - node.depth
                if cut < len(node.run):
                    lower = Node(shared, node.run[cut:], node.below, node.finals)
                    node.run, node.below, node.finals = node.run[:cut], [lower], []
                way.append(Node(shared, stem[shared:], [], []))
                node.below.append(way[-1])
                before = stem
            way[-1].finals.append(word[-1])

    def encodings(self, merges: Merges) -> Iterator[tuple[bytes, list[int]]]:
        """Each word and its tokens, depth first. ``states`` holds the last token of
        each prefix on the way down to the node at hand, ``places`` the automaton's."""
        path, states, places, left = b"", [-1], [0], [self.root]
        moves, ends, pairs, content, compatible = merges.moves, merges.ends, merges.pairs, merges.content, merges.compatible

        def last(found: list[tuple[int, int]], end: int) -> int:
            """The one token of ``found`` that the first ``end`` bytes end in."""
            for token, size in found:
                if size == end:
                    return token
                pair = states[end - size] << PAIR_BITS | token
                known = pairs.get(pair)
                if compatible(pair) if known is None else known:
                    return token
            raise ValueError("no token for a byte")

        while left:
            node = left.pop()
            path = path[: node.depth] + node.run
            del states[node.depth + 1 :], places[node.depth + 1 :]
            place = places[-1]
            for end, byte in enumerate(node.run, node.depth + 1):
                to = moves.get(place << 8 | byte)
                place = merges.move(place, byte) if to is None else to
                places.append(place)
                states.append(last(ends[place], end))
            for byte in node.finals:
                end = len(path) + 1
                token = last(merges.finals(place, byte), end)
                ids = [token]
                while end := end - len(content[token]):
                    token = states[end]
                    ids.append(token)
                yield path + bytes([byte]), ids[::-1]
            left += node.below


class Tokenizer:
    """Encodes and decodes texts as the file says; made once per Python process.
    What only encoding needs is made with the first text to encode."""

    def __init__(self, content: str):
        file = json.loads(content)
        self.model, split = file["model"], file["pre_tokenizer"]["pretokenizers"]
        steps = [s["type"] for s in file["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in split] != ["Split", "ByteLevel"] or file["decoder"]:
            raise ValueError("not a file of lower-case byte-level words")
        self.content = content
        self.words = regex.compile(split[0]["pattern"]["Regex"])
        self.byte = byte_symbols()
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.text = {i: t for t, i in {**self.model["vocab"], **self.special}.items()}
        self.decimal = {i: str(i) for i in self.text}
        self.alike: dict[str, bool] = {}
        self.held: dict[str, bytes] = {}  # ids of four bytes

    @cached_property
    def library(self):
        from tokenizers import Tokenizer as Library

        return Library.from_str(self.content)

    @cached_property
    def merges(self) -> Merges:
        return Merges(self.model["vocab"], [tuple(m) for m in self.model["merges"]], self.model["end_of_word_suffix"])

    def same(self, char: str) -> bool:
        """Whether Python normalizes and splits at this character as the library does."""
        known = self.alike.get(char)
        if known is None:
            probe = f"a{char}1{char}{char}b"
            ours = [w.encode() for w in self.words.findall(self.lower(probe))]
            # What Unicode 3.2 had composes alike ever since, and symbols never compose.
            old = unicodedata.ucd_3_2_0.category(char) != "Cn" or unicodedata.category(char)[0] in "SP"
            known = old and ours == [w.encode() for w in self.library_words(probe)]
            self.alike[char] = known
        return known

    @staticmethod
    def lower(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "\u03a3" in text else text.lower()  # the capital sigma has no final form here

    def library_words(self, text: str) -> list[str]:
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte[c] for c in w).decode() for w, _ in found]

    def words_of(self, text: str) -> list[str]:
        """The words; a special string is a word of its own, which no other word equals."""
        out = []
        for i, part in enumerate(self.specials.split(text)):
            if i % 2:
                out.append(part)
            elif self.words.pattern == PATTERN and not NOT_PLAIN.search(part):
                out += PLAIN_WORDS.findall(part.lower())
            elif all(map(self.same, set(part))):
                out += self.words.findall(self.lower(part))
            else:
                out += self.library_words(part)
        return out

    def learn(self, words: set[str]) -> None:
        """Hold the encodings of these words: one trie for all that are new."""
        if len(self.held) > HELD_WORDS:
            self.held.clear()
        new = words - self.held.keys()
        self.held.update((w, pack("=i", self.special[w])) for w in new if w in self.special)
        for word, ids in Trie(w.encode() for w in new if w not in self.special).encodings(self.merges):
            self.held[word.decode()] = pack(f"={len(ids)}i", *ids)

    def forget(self, words: set[str]) -> None:
        for word in words:
            if len(word) > LONG_WORD:
                self.held.pop(word, None)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for piece in pieces(text):
                waiting.append((i, self.words_of(piece)))
                size += len(piece)
                if size >= PIECE_CHARS:
                    self.settle(waiting, out)
                    waiting, size = [], 0
        self.settle(waiting, out)
        return [np.concatenate(ids) if ids else np.empty(0, np.int32) for ids in out]

    def settle(self, waiting: list[tuple[int, list[str]]], out: list[list[np.ndarray]]) -> None:
        words = set(chain.from_iterable(w for _, w in waiting))
        self.learn(words)
        for i, found in waiting:
            out[i].append(np.frombuffer(b"".join(map(self.held.__getitem__, found)), np.int32))
        self.forget(words)

    def decode(self, ids: Sequence[int]) -> str:
        try:
            return " ".join(map(self.text.__getitem__, ids))
        except KeyError:  # ids that no token has are passed over
            return " ".join(self.text[i] for i in ids if i in self.text)

    def decimals(self, ids: Sequence[int]) -> str:
        try:
            return " ".join(map(self.decimal.__getitem__, ids))
        except KeyError:
            return " ".join(map(str, ids))


def lists_of(column: pa.ListArray) -> Iterator[list[int]]:
    """The cells of a column of lists (null: empty), one at a time."""
    values, offsets = column.values, column.offsets.to_pylist()
    for i, full in enumerate(column.is_valid().to_pylist()):
        yield values.slice(offsets[i], offsets[i + 1] - offsets[i]).to_numpy(zero_copy_only=False).tolist() if full else []


def pieces(text: str) -> Iterator[str]:
    """The text in runs of about PIECE_CHARS that end before a blank."""
    at = 0
    while at < len(text):
        cut = BLANK.search(text, at + PIECE_CHARS) if at + PIECE_CHARS < len(text) else None
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def tokenizer(content: str) -> Tokenizer:
    cache, key = worker_cache(), ("bpe", hashlib.sha256(content.encode()).hexdigest())
    if key not in cache:
        cache[key] = Tokenizer(content)
    return cache[key]


def sent(df: DataFrame, file: str):
    """The tokenizer file (its size does not depend on the data), read by the driver and broadcast."""
    with open(file, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>): one row per row of ``docs``."""
    content = sent(docs, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer(content.value)
        for batch in batches:
            for rows, _ in blocks(batch, "_text"):
                ids = machine.encode([t or "" for t in rows.column(1).to_pylist()])
                offsets = np.cumsum([0, *map(len, ids)])
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([rows.column(0), column], names=["_id", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id long, ids array<int>").withColumnRenamed("_id", id_column)


def decoded(rows: DataFrame, tokenizer_file: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text: the decoded ids of each row; null ids and empty ones give an empty text."""
    content = sent(rows, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer(content.value)
        for batch in batches:
            texts = [machine.decode(ids) for ids in lists_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    narrow = rows.select(F.col(id_column).cast("long").alias("_id"), F.col(ids).alias("_ids"))
    return narrow.mapInArrow(run, "_id long, text string").withColumnRenamed("_id", id_column)


def digests(rows: DataFrame, tokenizer_file: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by one space), decoded_sha256 (of the decoded text)."""
    content = sent(rows, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = tokenizer(content.value)
        for batch in batches:
            rows = [(len(ids), *[hashlib.sha256(f(ids).encode()).hexdigest() for f in (machine.decimals, machine.decode)]) for ids in lists_of(batch.column(1))]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    narrow = rows.select(F.col(id_column).cast("long").alias("_id"), F.col(ids).alias("_ids"))
    found = narrow.mapInArrow(run, "_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("_id", id_column)
