"""BPE against the tokenizers library, both encoders, and exact round trips."""

import hashlib
import random
from array import array

import pytest
from tokenizers import Tokenizer

from tarmac.llm import rank_bpe, vocabulary as compiled


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary)


def samples():
    draw = random.Random(5)
    pool = [chr(i) for i in range(0x250)] + list(" \n\t\r  '’s") * 20 + ["<|endoftext|>", " 's", "'ll", "\n\n", "  "] * 5
    pool += [chr(i) for i in (0x3000, 0x2028, 0x85, 0xA0, 0x1C, 0x200B, 0x4E2D, 0x1F600, 0x301, 0x5D0, 0x661, 0xBD, 0x2160)] * 4
    yield from ("".join(draw.choice(pool) for _ in range(draw.randint(0, 15))) for _ in range(4000))
    yield from ("a" * 5000, "ab" * 300, " " * 700, "word " * 300, "x\n" * 50, "\n x", "x \n", "a.b,c;d", "<|endoftext")


def test_equals_the_library(library, vocabulary):
    own, fast = rank_bpe.RankBpe(vocabulary), compiled.encoder(vocabulary)()
    for text in samples():
        ids = library.encode(text, add_special_tokens=False).ids
        assert array("I", own.encode(text)).tolist() == ids, repr(text)
        assert array("I", fast(text)).tolist() == ids, repr(text)
        assert own.decode(array("I", ids)) == library.decode(ids, skip_special_tokens=False)


def test_broken_bytes_decode_like_the_library(library, vocabulary):
    own, draw = rank_bpe.RankBpe(vocabulary), random.Random(2)
    for _ in range(500):
        ids = [draw.randrange(50257) for _ in range(draw.randint(1, 8))]
        assert own.decode(array("I", ids)) == library.decode(ids, skip_special_tokens=False)


def test_long_words_merge_alike(vocabulary):
    own, draw = rank_bpe.RankBpe(vocabulary), random.Random(4)
    for size in (2, 50, 199):
        word = "".join(draw.choice("abcest ing") for _ in range(size)).encode()
        assert own._merge_long([own.byte_ids[b] for b in word]) == own.merge(word)


def test_tables(spark, awkward, vocabulary, library):
    rows, docs = awkward
    got = rank_bpe.round_trip(docs, vocabulary).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw = array("I", ids).tobytes()
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    encoded = rank_bpe.encode(docs, vocabulary)
    back = rank_bpe.decode(encoded, vocabulary).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, t or "")) for i, t in rows)
    assert rank_bpe.round_trip(docs.limit(0), vocabulary).count() == 0


def test_very_long_white_space_has_ids(library, vocabulary):
    """The compiled pattern engine runs out of stack on these runs."""
    fast = compiled.encoder(vocabulary)()
    for run in (" " * 2_000_000, "\n" * 2_000_000):
        for text in (f"one{run}two <|endoftext|> three", run):
            want = library.encode(text, add_special_tokens=False).ids
            assert fast(text) == array("I", want).tobytes()
