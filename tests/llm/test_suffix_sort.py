"""Repeated windows against a count of all windows, on texts with every kind of match boundary."""

import hashlib
import random
from collections import Counter

import pytest

from tarmac.llm import suffix_sort as ss


def brute(rows, window):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + window] for i in range(len(data) - window + 1))
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        covered = bytearray(len(data) + 1)
        for i in range(len(data) - window + 1):
            if seen[data[i : i + window]] > 1:
                covered[i : i + window] = b"\1" * window
        spans = sum(covered[i] > covered[i - 1] for i in range(len(data)))
        kept = bytes(b for b, c in zip(data, covered) if not c)
        out.append((doc_id, len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, docs, window):
    return sorted((tuple(r) for r in ss.digests(ss.remove_repeats(spark, docs, window)).collect()), key=str)


@pytest.fixture(scope="module")
def passages(words):
    """Passages in whole, cut, edited and repeated inside a text; runs of one letter; lengths around the window."""
    base = [words(150, i) for i in range(5)]
    rows = [(1, None), (2, ""), (3, "x" * 3000), (4, "ab" * 1000), (5, "x" * 399), (6, "é" * 900), (6, "é" * 900),
            (None, base[0]), (None, base[0]), (7, base[0][:450] + "Q" + base[0][451:]), (8, base[1]),
            (9, words(30, 9) + base[1][100:520] + words(9, 8)), (10, base[2] + base[2]), (11, base[3][:400]),
            (12, "z" + base[3][:400] + "y"), (12, base[4][5:404]), (13, base[4])]
    draw = random.Random(1)
    for k in range(40):
        text, at = draw.choice(base), draw.randrange(300)
        part = text[at : at + draw.randint(150, 800)]
        rows.append((100 + k, words(draw.randint(1, 20), 50 + k) + part + words(draw.randint(1, 20), 90 + k)))
    return rows


@pytest.mark.parametrize("window", [160, 400])
def test_windows_equal_brute_force(spark, documents, passages, window):
    got = found(spark, documents(passages), window)
    assert got == brute(passages, window) and sum(r[2] for r in got) > 10_000


def test_all_passes_take_part(spark, documents, passages):
    """Edges of matches are settled by blocks and single suffixes, the rest by the first pass."""
    docs = documents(passages)
    rows = docs.selectExpr("coalesce(doc_id, -1) AS k1", "xxhash64(text) AS k2", "CAST(coalesce(text, '') AS BINARY) AS data")
    rows = rows.dropDuplicates(["k1", "k2"])
    first = ss.first_pass(rows, 400)
    sure, left = ss.settle(spark, first, "test", False)
    blocks = ss.next_pass(rows, left, 400, ss.BLOCK)
    assert sure.count() > 0 and left.count() > 0 and blocks.count() > left.count()
    assert first.count() < sum(len(t or "") for _, t in passages)


def test_pieces_of_a_long_text_join(monkeypatch, words):
    """Chunks may cut the suffixes of an anchor; together they are all suffixes, each once, anchored as before."""
    data = words(3000, 4).encode() + b"y" * 2000

    def spread():
        return {p: a for at, low, high in ss.anchors(data, 400) for a, x, y in zip(at, low, high) for p in range(x, y + 1)}

    whole = spread()
    monkeypatch.setattr(ss, "CHUNK", 1000)
    assert spread() == whole and sorted(whole) == list(range(len(data) - 399))
    assert all(p <= a < p + ss.SPREAD for p, a in whole.items())


def test_awkward_and_empty(spark, awkward, documents):
    rows, docs = awkward
    assert found(spark, docs, 400) == brute(rows, 400)
    assert found(spark, documents(rows[:0]), 400) == []
    with pytest.raises(ValueError):
        ss.remove_repeats(spark, docs, 100)
