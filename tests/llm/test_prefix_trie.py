"""The trie and its totals against dictionaries of prefixes, with rounds over tables and inside tasks."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarmac.llm import prefix_trie as pt


def brute(rows, rebuild=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    told = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        told[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:] if rebuild else own[c]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(told):
        for d in range(len(told[c]) + 1):
            members[tuple(told[c][:d])].append(c)
        ends[tuple(told[c])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += not kids[n]
            saved[n[:d]] += (len(m) - 1) * words
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -(10**9), len(m), kids[n], leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    )


def found(spark, rows, **options):
    data = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "conv_id long, turn int, role string, text string, node string, depth string"
    )
    got = pt.prefix_trie(spark, data, **options).collect()
    return sorted((r[0], r[1], -(10**9) if r[2] is None else r[2], *r[3:]) for r in got)


@pytest.fixture(scope="module")
def chats():
    """Shared openings, whole copies, deep chains that branch late, ties, nulls and missing base conversations."""
    draw = random.Random(2)
    rows = [(None, 0, "user", "nobody"), (-3, 0, "user", "minus"), (-3, None, None, None), (5, 1, "user", "b"),
            (5, 1, "user", "a"), (5, 1, "user", "a"), (7, 0, "user", "only one")]
    for c in range(40, 120):
        for t in range(draw.randint(1, 9)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {draw.randrange(1 + t % 3)}  of\ttalk {t}"))
    for c in range(200, 212):  # a deep chain with a branch at every depth
        rows += [(c, t, "user", f"deep {t}") for t in range(60 - c % 10)] + [(c, 99, "user", f"end {c}")]
    return rows


@pytest.mark.parametrize("bound", [1, 7, 50_000])
def test_totals_equal_brute_force(spark, chats, bound):
    assert found(spark, chats, bound=bound) == brute(chats)


def test_without_rebuilding(spark, chats):
    assert found(spark, chats, rebuild=False, bound=20) == brute(chats, rebuild=False)


def test_turnless_and_empty(spark):
    # Conversation 7 keeps nothing: its only turn is replaced by those of conversation 0, which is absent.
    bare = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4][:2]
    rows = [(c, 0, "user", "gone") for c in bare]
    assert found(spark, rows) == brute(rows) and len(found(spark, rows)) == 1
    assert found(spark, []) == []


def test_decompose_equals_direct_sums():
    draw = random.Random(5)
    for n in (1, 2, 50, 400):
        for shape in ("chain", "star", "any", "forest"):
            parent = [-1] + [
                {"chain": i - 1, "star": 0, "any": draw.randrange(i), "forest": draw.randrange(-1, i)}[shape]
                for i in range(1, n)
            ]
            values = np.array([[draw.randrange(9), 1] for _ in range(n)], np.int64)
            want = values.copy()
            for i in range(n - 1, 0, -1):
                if parent[i] >= 0:
                    want[parent[i]] += want[i]
            assert (pt.decompose(parent, values) == want).all()
