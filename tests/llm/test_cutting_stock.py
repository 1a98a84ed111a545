"""Packing: every id in one place, sequences full, the program near its bound."""

import zlib
from array import array

import numpy as np
import pytest

from tarmac.llm import cutting_stock as cs, rank_bpe, vocabulary as compiled


def test_knapsack_equals_brute_force():
    draw = np.random.default_rng(1)
    for _ in range(30):
        capacity = int(draw.integers(1, 25))
        prices = draw.random(int(draw.integers(1, 8)))
        value, counts = cs.knapsack(prices, capacity)
        best = [0.0] * (capacity + 1)
        for room in range(1, capacity + 1):
            best[room] = max([best[room - 1], *(p + best[room - s] for s, p in enumerate(prices, 1) if s <= room)])
        assert value == pytest.approx(best[capacity]) and (counts * np.arange(1, len(prices) + 1)).sum() <= capacity
        assert counts @ prices == pytest.approx(value)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_wastes_little(seed):
    draw = np.random.default_rng(seed)
    capacity = 64
    sizes = np.clip(draw.lognormal(2.2, 0.9, 4000).astype(int), 1, capacity)
    demand = np.bincount(sizes, minlength=capacity + 1)[1:]
    plan = cs.plan(demand, capacity)
    used = np.zeros(capacity + 1, int)
    for pattern, copies in plan.patterns:
        assert sum(s * k for s, k in pattern) <= capacity
        for s, k in pattern:
            used[s] += k * copies
    assert (used[1:] == demand).all()
    assert plan.sequences <= 1.01 * sizes.sum() / capacity + 1


def test_plan_of_nothing():
    assert cs.plan(np.zeros(8, int), 8).sequences == 0


def test_plans_in_a_driver_whose_session_has_run_python_workers(spark):
    """Threaded linear algebra stood still here: more than 200 columns enter, so the inverse is renewed."""
    assert spark.range(1000).mapInPandas(lambda batches: batches, "id long").count() == 1000
    draw = np.random.default_rng(5)
    sizes = np.clip(draw.lognormal(4.0, 1.2, 60_000).astype(int), 1, 256)
    demand = np.bincount(sizes, minlength=257)[1:]
    plan = cs.plan(demand, 256)
    assert plan.sequences <= 1.01 * sizes.sum() / 256 + 1
    columns = draw.random((40, 40)) + np.eye(40)
    assert np.allclose(cs._inverse(columns) @ columns, np.eye(40))


def check(spark, docs, rows, vocabulary, capacity, rows_per_rank):
    encode = compiled.encoder(vocabulary)
    placed = cs.pack(spark, cs.cut(docs, encode, capacity), capacity, 8, rows_per_rank).toPandas()
    own = rank_bpe.RankBpe(vocabulary)
    want = sorted(len(own.encode(t or "")) // 4 + 1 for _, t in rows)
    whole = placed[placed["start"] == 0]
    assert sorted(whole["doc_tokens"]) == want and placed["length"].sum() == sum(want)
    crcs = []
    for _, t in rows:
        raw = own.encode(t or "") + array("I", [1]).tobytes()
        crcs += [zlib.crc32(raw[4 * a : 4 * (a + capacity)]) for a in range(0, len(raw) // 4, capacity)]
    assert sorted(placed["ids_crc32"]) == sorted(crcs)
    for _, sequence in placed.sort_values("offset").groupby("sequence_id"):
        assert (sequence["offset"].to_numpy() == sequence["length"].cumsum().to_numpy() - sequence["length"].to_numpy()).all()
        assert sequence["length"].sum() <= capacity
    return placed


def test_documents(spark, documents, words, vocabulary):
    rows = [(i, words(5 + 37 * i % 300, i)) for i in range(120)] + [(500 + i, "same text again") for i in range(60)]
    placed = check(spark, documents(rows), rows, vocabulary, 256, 7)
    filled = placed.groupby("sequence_id")["length"].sum()
    assert filled.sum() / (256 * len(filled)) > 0.93


def test_awkward_rows(spark, awkward, vocabulary):
    rows, docs = awkward
    check(spark, docs, rows, vocabulary, 2048, 1000)


def test_empty_table(spark, documents, vocabulary):
    placed = cs.pack(spark, cs.cut(documents([]), compiled.encoder(vocabulary)))
    assert placed.count() == 0 and placed.columns[-2:] == ["sequence_id", "offset"]
