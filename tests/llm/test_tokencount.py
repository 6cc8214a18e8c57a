import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from eventide.llm import tokencount
from eventide.llm.words import texts_of

from .conftest import as_set

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def machine():
    with open(FILE, encoding="utf-8") as f:
        return tokencount.Counter(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def both(machine, library, texts):
    ours = machine.count(texts_of(pa.array(texts, pa.string()))).tolist()
    theirs = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    return ours, theirs


EDGES = [
    "", None, "a", "don't I'll we've they're 're 'r 'v 'l 'x  ''s", "  a\n\n b\t c  \n", "x<|endoftext|>y <|endoftext|>", "'s't 'sh",
    "é中文 字　x y z    1²3 ٣", "'r", "'", "a'l", "a'", "a  ", "\n a", " 's", "!'s", "<|endof", "<|endoftext|><|endoftext|>", "😀😀 'll'",
    "<|endof" "text|", "   ", "\r\n\r\n", "e" * 5000, "1" * 3000, "-" * 2000,
]


def test_edges_equal_the_library(machine, library):
    ours, theirs = both(machine, library, EDGES)
    assert ours == theirs


def test_random_texts_equal_the_library(machine, library):
    rng = random.Random(1)
    parts = [*"astrevlmd' \n\t12!é中٣☃Z%", "  ", " 's", "<|endoftext|>", "ll", "re", "the", "ing", "😀", "\r\n", "tion", " and"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(rng.randrange(30))) for _ in range(300)]
    ours, theirs = both(machine, library, texts)
    assert ours == theirs


def test_states_are_dropped_and_made_anew(library, monkeypatch):
    monkeypatch.setattr(tokencount, "MAX_STATES", 300)
    with open(FILE, encoding="utf-8") as f:
        small = tokencount.Counter(f.read())
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh tion") for _ in range(80)) for _ in range(60)]
    ours, theirs = both(small, library, texts)
    assert ours == theirs
    assert len(small.keys) <= 600


def test_chunk_maps_compose_to_the_sequential_run(machine):
    import numpy as np

    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 12, 1000).astype(np.uint8)
    state, marks = 0, np.zeros(1001, bool)
    for i, s in enumerate(symbols):
        marks[i] |= bool(machine.mark[state, s] & tokencount.HERE)
        if i:
            marks[i - 1] |= bool(machine.mark[state, s] & tokencount.BEFORE)
        state = machine.to[state, s]
    assert (machine.marks(symbols) == (marks[:1000] & (symbols != tokencount.END))).all()


def test_other_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        tokencount.Counter(f.read())


def test_rows(odd, clashing, empty, odd_rows, library):
    got = as_set(tokencount.token_counts(odd, FILE))
    expected = []
    for doc_id, text, *_ in odd_rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert got == sorted(expected, key=repr)
    assert as_set(tokencount.token_counts(clashing, FILE)) == got
    assert tokencount.token_counts(empty, FILE).collect() == []
