import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventide.llm import bpe

from .conftest import as_set

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def machine():
    with open(FILE, encoding="utf-8") as f:
        return bpe.Tokenizer(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def same(machine, library, texts):
    ours = [ids.tolist() for ids in machine.encode(texts)]
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ours == theirs
    assert [machine.decode(i) for i in ours] == [library.decode(i, skip_special_tokens=False) for i in theirs]


EDGES = [
    "", " ", "a", "'s't 'sh 'RE 'r", "DON'T ΣΑΣ ΟΔΥΣΣΕΥΣ İstanbul ß É É 각", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|><|endoftext|>",
    "<|endof", "<|endoftext", "x" * 70_000, "ab" * 5000 + " " + "é" * 3000, "\x85a b　c\x1cd\x0b", "1²3٣ Ⅷ", "😀😀 👩‍👩‍👧", "ᫀ⥀۟", "a</w>b </w>",
    "!" * 999, "the" * 5000, "a\x1cb \x00c ª µ ×÷ Ÿ ÿ ÀÉ¼", "“quoted”—l'été ÜBER ©", "՘ ֋", "𑤸",
]


def test_edges_equal_the_library(machine, library):
    same(machine, library, EDGES)


@pytest.mark.parametrize("letters", ["abcdehilnorst", "aab", "'stre vmld12.!-", "éüñ中文ß ", "the and ing"])
def test_random_words_equal_the_library(machine, library, letters):
    rng = random.Random(letters)
    same(machine, library, ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(1500)])


def test_random_characters_equal_the_library(machine, library):
    rng = random.Random(6)
    points = [c for c in (rng.randrange(0x3000 if i % 2 else 0x110000) for i in range(30_000)) if not 0xD800 <= c < 0xE000]
    same(machine, library, ["".join(map(chr, points[i : i + 12])) for i in range(0, len(points), 12)])


def test_neighbours_of_tokens_decide_alone(machine, library):
    """A pair is compatible if, and only if, its bytes encode to it."""
    rng, merges = random.Random(2), machine.merges
    inside, final = list(merges.inside.items()), list(merges.final.items())
    for _ in range(4000):
        (a, x), (b, y) = rng.choice(inside[:3000]), rng.choice(final[:3000])
        if (a + b).isalpha() and (a + b).islower():
            assert merges.compatible(x << bpe.PAIR_BITS | y) == (library.encode((a + b).decode(), add_special_tokens=False).ids == [x, y])


def test_trie_computes_a_shared_prefix_once(machine):
    class Counted(list):
        reads = 0

        def __getitem__(self, at):
            self.reads += 1
            return super().__getitem__(at)

    merges, words = machine.merges, [b"internationally", b"international", b"internationals", b"inter"]
    merges.ends = Counted(merges.ends)
    try:
        assert {w for w, _ in bpe.Trie(words).encodings(merges)} == set(words)
        assert merges.ends.reads == len(b"internationall")
    finally:
        merges.ends = list(merges.ends)


def test_memory_bounds_change_nothing(machine, library, monkeypatch):
    texts = [t for t in EDGES if len(t) < 100] + ["some words of a text and " * 40]
    monkeypatch.setattr(bpe, "PIECE_CHARS", 11)
    monkeypatch.setattr(bpe, "HELD_WORDS", 2)
    monkeypatch.setattr(bpe, "LONG_WORD", 2)
    monkeypatch.setattr(bpe, "HELD_PAIRS", 3)
    same(machine, library, texts)


def test_rows(spark, library, odd, clashing, empty, odd_rows):
    def row(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        texts = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        return i, len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]

    found = bpe.encoded(odd, FILE)
    expected = sorted((row(r[0], r[1]) for r in odd_rows), key=repr)
    assert as_set(bpe.digests(found, FILE)) == expected
    assert as_set(bpe.digests(bpe.encoded(clashing, FILE), FILE)) == expected
    texts = {(r.doc_id, r.text) for r in bpe.decoded(found, FILE).collect()}
    assert texts == {(r[0], library.decode(library.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in odd_rows}
    assert bpe.digests(bpe.encoded(empty, FILE), FILE).collect() == []


def test_other_files_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Tokenizer(f.read())
