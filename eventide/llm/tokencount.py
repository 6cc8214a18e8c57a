"""Token counts by compiled finite-state transducers (operator 10).

A byte-level BPE tokenizer file is compiled into two deterministic machines
whose transitions say how many tokens they emit; no token is ever built.

* The splitter runs over classes of code points and marks where the pieces
  start that BPE merges within. It has 13 states, so a chunk of text is a map
  of 13 states to 13 states. Chunks of a block are mapped side by side, their
  maps are composed by a parallel prefix scan, and with its start state known
  each chunk is run once more to write its marks. Texts are separated by a
  symbol that sends every state to the start.
* The counter runs over the bytes of a piece. Let t(j) be the last token of the
  encoding of the first j bytes. The encoding of a longer prefix ends in the
  one vocabulary token w[j:i] that may follow t(j), so the count for i is that
  for j plus one, and a state only has to hold, for each suffix w[j:i] that
  still can grow into a token: its place in the vocabulary's trie, t(j), and
  the count since. That is a finite set; its states are made when first met,
  and each transition is annotated with the change in the number of emitted
  tokens. All pieces of a block step through the table together.

Which tokens may follow which is decided by the merges: a pair may stand if
merging its bytes gives the pair back. Code point classes are asked from the
library's own pre-tokenizer, once per code point met. The states are bounded
(``MAX_STATES``): a full table is dropped and the live states are made anew.

Null texts count as empty: 0 bytes, 0 tokens. Repeated rows are counted one by
one; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import worker_cache
from .words import Texts, blocks, row_of, sums

MAX_STATES = 1 << 17
CHUNK = 64
TOKEN_LIMIT = 512

# Symbols of the splitter: classes of code points, the letters of the
# contractions, and the end of a text.
END, SPACE, BLANK, NUMBER, OTHER, QUOTE, LETTER, STMD, R, V, E, L = range(12)
# States: what the current piece is.
START, IN_LETTER, IN_NUMBER, IN_OTHER, SPACE_1, BLANK_1, SPACE_N, BLANK_N, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, CLOSED = range(13)
STATES = 13
HERE, BEFORE = 1, 2  # a piece starts at this symbol; one started at the symbol before


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by state and symbol, for the pattern of public byte-level BPE files:
    contractions | optional space and letters, numbers or others | blanks not before text | blanks."""
    to = np.zeros((STATES, 12), np.uint8)
    mark = np.zeros((STATES, 12), np.uint8)
    letters = (LETTER, STMD, R, V, E, L)
    run = {NUMBER: IN_NUMBER, OTHER: IN_OTHER, QUOTE: IN_OTHER} | dict.fromkeys(letters, IN_LETTER)
    fresh = run | {QUOTE: AFTER_QUOTE}
    first_blank, more_blank = {SPACE: SPACE_1, BLANK: BLANK_1}, {SPACE: SPACE_N, BLANK: BLANK_N}
    for s in range(STATES):
        for a in range(1, 12):
            blank = a in (SPACE, BLANK)
            if s in (SPACE_1, BLANK_1, SPACE_N, BLANK_N):
                if blank:  # the run goes on
                    to[s, a] = more_blank[a]
                elif s in (SPACE_1, SPACE_N):  # the last space belongs to what follows
                    to[s, a], mark[s, a] = run[a], BEFORE * (s == SPACE_N)
                else:  # the last blank is a piece of its own
                    to[s, a], mark[s, a] = fresh[a], HERE | BEFORE * (s == BLANK_N)
                continue
            pending = s in (QUOTE_R, QUOTE_V, QUOTE_L)
            if (s == AFTER_QUOTE and a == STMD) or (pending and a == (L if s == QUOTE_L else E)):
                to[s, a] = CLOSED
                continue
            if s == AFTER_QUOTE and a in (R, V, L):
                to[s, a] = {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[a]
                continue
            kind = {IN_LETTER: IN_LETTER, IN_NUMBER: IN_NUMBER, IN_OTHER: IN_OTHER, AFTER_QUOTE: IN_OTHER}.get(s)
            kind = IN_LETTER if pending else kind  # the letter after the quote began a piece
            goes_on = not blank and kind is not None and run[a] == kind
            to[s, a] = first_blank[a] if blank else kind if goes_on else fresh[a]
            mark[s, a] = HERE * (not goes_on) | BEFORE * pending
        mark[s, END] = BEFORE * (s in (QUOTE_R, QUOTE_V, QUOTE_L))
    return to, mark


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: a printable
    Latin-1 byte stands for itself, the others follow from 256 in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """The compiled machines of one tokenizer file."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        spec = json.loads(content)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if model.get("type") != "BPE" or not plain or not byte_level or spec.get("normalizer"):
            raise ValueError("only plain byte-level BPE files can be compiled")
        self.special = []
        for t in spec.get("added_tokens") or ():
            if any(t.get(k) for k in ("lstrip", "rstrip", "single_word")) or not t["content"].isascii():
                raise ValueError(f"added token {t['content']!r} has options that are not supported")
            self.special.append(t["content"].encode())
        self.library = Tokenizer.from_str(content).pre_tokenizer
        chars = byte_of_char()
        ids = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if all(c in chars for c in token)}
        self.token_bytes = {i: t for t, i in ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(chars[c] for c in x) for x in (left, right))
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for token, i in ids.items():
            node = 0
            for b in token:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = i
        self.follows: dict[tuple[int, int], bool] = {}
        self.spines: dict[int, tuple[list, list] | None] = {}
        self.to, self.mark = splitter()
        self.flat_to, self.flat_mark = self.to.ravel(), self.mark.ravel()
        by_four = np.arange(STATES)[:, None]
        for _ in range(4):
            by_four = self.to[by_four].reshape(STATES, -1)
        self.by_four = by_four.astype(np.int32).ravel()  # the state after four symbols
        self.symbol = np.full(0x110000, 255, np.uint8)
        for letters, s in (("stmd", STMD), ("r", R), ("v", V), ("e", E), ("l", L), (" ", SPACE), ("'", QUOTE)):
            for c in letters:
                self.symbol[ord(c)] = s
        self.learn(np.arange(128))
        self.reset()

    # -- the splitter ---------------------------------------------------------

    def learn(self, points: np.ndarray) -> None:
        """Classes of code points, as the library's pre-tokenizer has them."""
        pieces = lambda s: len(self.library.pre_tokenize_str(s))
        for p in points:
            if self.symbol[p] == 255:
                c = chr(p)
                kinds = ((f"a{c}a", LETTER), (f"1{c}1", NUMBER), (f"!{c}!", OTHER))
                self.symbol[p] = next((k for text, k in kinds if pieces(text) == 1), BLANK)

    def symbols(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of a block with an end after each text; the byte place of
        each symbol; the number of special tokens by text."""
        data, offsets = texts
        at = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[at]
        points = lead.astype(np.int32)
        for low, size, bits in ((0xC0, 2, 0x1F), (0xE0, 3, 0x0F), (0xF0, 4, 0x07)):
            wide = np.flatnonzero((lead >= low) & (lead < (0xE0, 0xF0, 0x100)[size - 2]))
            p = lead[wide].astype(np.int32) & bits
            for j in range(1, size):
                p = (p << 6) | (data[at[wide] + j] & 0x3F)
            points[wide] = p
        kinds = self.symbol[points]
        if (kinds == 255).any():
            self.learn(np.unique(points[kinds == 255]))
            kinds = self.symbol[points]
        special = np.zeros(texts.n, np.int64)
        raw = data.tobytes() if self.special else b""
        for mark in self.special:
            found = raw.find(mark)
            while found >= 0:
                row = int(np.searchsorted(offsets, found, "right")) - 1
                if found + len(mark) <= offsets[row + 1]:
                    special[row] += 1
                    first = int(np.searchsorted(at, found))
                    kinds[first : first + len(mark)] = END
                    found = raw.find(mark, found + len(mark))
                else:
                    found = raw.find(mark, found + 1)
        doc = np.searchsorted(at, offsets)
        place = np.arange(len(at)) + row_of(doc)
        out = np.zeros(len(at) + texts.n, np.uint8)
        out[place] = kinds
        bytes_at = np.empty(len(out), np.int64)
        bytes_at[place] = at
        bytes_at[doc[1:] + np.arange(texts.n)] = offsets[1:]
        return out, bytes_at, special

    def marks(self, symbols: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each symbol."""
        lanes = -(-len(symbols) // CHUNK)
        padded = np.zeros(lanes * CHUNK, np.uint8)  # ends: they change no mark
        padded[: len(symbols)] = symbols
        columns = np.ascontiguousarray(padded.reshape(lanes, CHUNK).T).astype(np.int32)
        maps = np.broadcast_to(np.arange(STATES, dtype=np.int32)[:, None], (STATES, lanes))
        for k in range(0, CHUNK, 4):
            four = ((columns[k] * 12 + columns[k + 1]) * 12 + columns[k + 2]) * 12 + columns[k + 3]
            maps = self.by_four.take(maps * 12**4 + four)
        # Parallel prefix scan: after each round a lane's map covers twice as many chunks.
        step = 1
        scanned = maps.T.astype(np.intp)
        while step < lanes:
            scanned[step:] = np.take_along_axis(scanned[step:], scanned[:-step], axis=1)
            step *= 2
        state = np.full(lanes, START, np.intp)
        state[1:] = scanned[:-1, START]
        marks = np.empty((CHUNK, lanes), np.uint8)
        for k, column in enumerate(columns):
            cell = state * 12 + column
            marks[k] = self.flat_mark[cell]
            state = self.flat_to[cell].astype(np.intp)
        flat = marks.T.ravel()[: len(symbols)]
        out = (flat & HERE).astype(bool)
        out[:-1] |= (flat[1:] & BEFORE) > 0
        return out & (symbols != END)

    # -- the counter ----------------------------------------------------------

    def reset(self) -> None:
        if len(self.follows) > 1 << 20:
            self.follows.clear()
        self.ids: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.table = np.full((1024, 256), -1, np.int32)  # next state * 64 + emitted tokens + 32
        self.intern(((0, -1, 0),))

    def intern(self, key: tuple) -> int:
        state = self.ids.get(key)
        if state is None:
            state = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if state >= len(self.table):
                grown = np.full((2 * len(self.table), 256), -1, np.int32)
                grown[: len(self.table)] = self.table
                self.table = grown
        return state

    def edges(self, token: int) -> tuple[list, list] | None:
        """How the first and the last part of a token grow while its bytes are
        merged: (part, rank of the merge that makes it, rank of the one that
        consumes it), in time. None if merging does not end in the token."""
        if token in self.spines:
            return self.spines[token]
        parts = [self.byte_id[b] for b in self.token_bytes[token]]
        first, last, never = [[parts[0], -1, None]], [[parts[-1], -1, None]], 1 << 30
        while len(parts) > 1:
            rank, whole = min(self.merges.get(p, (never, 0)) for p in zip(parts, parts[1:], strict=False))
            if rank == never:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.merges.get((parts[i], parts[i + 1]), (-1,))[0] == rank:
                    out.append(whole)
                    if i == 0:
                        first[-1][2] = rank
                        first.append([whole, rank, None])
                    if i + 2 == len(parts):
                        last[-1][2] = rank
                        last.append([whole, rank, None])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        first[-1][2] = last[-1][2] = never
        self.spines[token] = (first, last) if parts == [token] else None
        return self.spines[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE keeps the two tokens apart: no merge across their border
        has its turn while both parts beside the border exist. Among merges of
        one rank the leftmost goes first."""
        known = self.follows.get((left, right))
        if known is None:
            a, b = self.edges(left)[1], self.edges(right)[0]
            i = j = 0
            known = True
            while True:
                (x, born_x, gone_x), (y, born_y, gone_y) = a[i], b[j]
                rank = self.merges.get((x, y), (-2,))[0]
                if rank >= born_x and rank >= born_y and rank < gone_x and rank <= gone_y:
                    known = False
                    break
                if gone_x <= gone_y:
                    i += 1
                else:
                    j += 1
                if i == len(a) or j == len(b):
                    break
            self.follows[left, right] = known
        return known

    def step(self, state: int, byte: int) -> int:
        """Makes a transition: next state * 64 + emitted tokens + 32."""
        alive, last, emitted = [], -1, None
        for node, token, since in self.keys[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            here = self.token_at[child]
            if emitted is None and here >= 0 and self.edges(here) and (token < 0 or self.may_follow(token, here)):
                last, emitted = here, 1 - since
            if self.children[child]:
                alive.append((child, token, since))
        # ``since``: tokens between that prefix and this one.
        key = (*((n, t, s + emitted) for n, t, s in alive), (0, last, 0))
        cell = self.intern(key) * 64 + emitted + 32
        self.table[state, byte] = cell
        return cell

    def count_pieces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each data[start:end]; all pieces step together, long ones last."""
        size = end - start
        order = np.argsort(-np.minimum(size, 30000).astype(np.int16), kind="stable")
        if len(size) and size.max() >= 30000:
            order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        states = np.zeros(len(start), np.int64)
        tokens = np.zeros(len(start), np.int64)
        left = np.searchsorted(-size, -np.arange(int(size[0]) + 1 if len(size) else 0), "left")  # pieces longer than k
        for k in range(int(size[0]) if len(size) else 0):
            n = int(left[k])
            at = states[:n] * 256 + data[start[:n] + k]
            cells = self.table.ravel()[at]
            new = np.flatnonzero(cells < 0)
            if len(new):
                if len(self.keys) + len(new) > MAX_STATES and len(self.keys) > MAX_STATES // 2:
                    live, where = np.unique(states[:n], return_inverse=True)
                    keys = [self.keys[s] for s in live]
                    self.reset()
                    states[:n] = np.array([self.intern(key) for key in keys])[where.ravel()]
                    at = states[:n] * 256 + data[start[:n] + k]
                    new = np.arange(n)
                for cell in np.unique(at[new]):
                    if self.table[cell >> 8, cell & 255] < 0:
                        self.step(int(cell >> 8), int(cell & 255))
                cells = self.table.ravel()[at]
            states[:n] = cells >> 6
            tokens[:n] += (cells & 63) - 32
        out = np.empty(len(order), np.int64)
        out[order] = tokens
        return out

    def count(self, texts: Texts) -> np.ndarray:
        symbols, place, special = self.symbols(texts)
        if not len(texts.data):
            return special
        starts = self.marks(symbols)
        cuts = np.flatnonzero(starts | (symbols == END))
        first = starts[cuts]
        start = place[cuts[first]]
        end = place[cuts[np.flatnonzero(first) + 1]]
        pieces = self.count_pieces(texts.data, start, end)
        return sums(pieces, np.searchsorted(start, texts.offsets)) + special


def counter(content: str) -> Counter:
    """Compiled once per Python process."""
    cache, key = worker_cache(), ("tokens", hashlib.sha256(content.encode()).hexdigest())
    if key not in cache:
        cache[key] = Counter(content)
    return cache[key]


def token_counts(docs: DataFrame, tokenizer_file: str, id_column: str = "doc_id", text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    The file (a vocabulary, its size does not depend on the data) is read by
    the driver and broadcast."""
    with open(tokenizer_file, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(content.value)
        for batch in batches:
            for rows, texts in blocks(batch, "_text"):
                counts = machine.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(texts.offsets)), pa.array(counts), pa.array(counts > limit)],
                    names=["_id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    found = rows.mapInArrow(run, "_id long, n_bytes long, n_tokens long, over_limit boolean")
    return found.withColumnRenamed("_id", id_column)
