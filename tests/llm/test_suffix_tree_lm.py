"""Language-model scores: the base by hand, probabilities that sum to one, held-out gain."""

import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import suffix_tree_lm as lm
from tarmac.llm.common import cut_lineage, fold, words_of
from tarmac.session import scratch_root


def base_of(rows):
    tokens = [(i, [*words_of(t or ""), None]) for i, t in rows]
    train = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 10 != 0
    counts = Counter(w for i, ws in tokens for w in ws if train(i))
    n, v = sum(counts.values()), len(counts)
    return [
        (i, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for i, ws in tokens
    ]


def check(spark, docs, rows, **options):
    got = lm.score(spark, docs, fold("doc_id", 10) != 0, **options).collect()
    names = ("doc_id", "n_tokens", "n_known", "train_tokens")
    order = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    got = sorted((tuple(r[n] for n in names) + (r["base_score"],) for r in got), key=order)
    for g, w in zip(got, sorted(base_of(rows), key=order), strict=True):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9)


def test_base_over_blocks(spark, documents, words):
    rows = [(i, words(3 + i % 40, i // 2) + " THE the Of of") for i in range(200)]
    check(spark, documents(rows), rows, block_chars=4000)


def test_awkward_rows(spark, awkward):
    rows, docs = awkward
    check(spark, docs, rows)


def test_no_training_rows_and_no_rows(spark, documents):
    docs = documents([(1, "some words"), (2, None)])
    found = lm.score(spark, docs, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found} == {(0, 0, 0.0, 0.0)}
    assert lm.score(spark, documents([]), F.lit(True)).count() == 0


def brute_force(rows, train, depth=3, min_count=16, min_pair=2, divergence=0.02, pull=20.0):
    """The scores by dictionaries, one token after the other; also the states and a function for distributions."""

    def tokens(text):
        ws, tail, out = words_of(text), lm.START, []
        for w in [*ws, None]:
            out.append((tail, lm.END if w is None else lm.class_of(w), w))
            tail = (tail + lm.BEGIN + w)[-depth:] if w is not None else tail
        return out

    spoken = [tokens(t or "") for _, t in rows]
    words, classes, levels = Counter(), Counter(), [{} for _ in range(depth + 1)]
    for ts in (t for t, (i, _) in zip(spoken, rows) if train(i)):
        for c, s, w in ts:
            words[w] += 1
            classes[s] += 1
            for d in range(1, depth + 1):
                if len(c) >= d:
                    levels[d].setdefault(c[-d:], Counter())[s] += 1
    total = sum(classes.values())
    dist = {"": ({s: n / total for s, n in classes.items()}, 0.0)}

    def p(context, s):
        own, fall = dist[context]
        return own[s] if s in own else fall * p(context[1:], s)

    keep = {""}
    for d in range(1, depth + 1):
        for c, counts in levels[d].items():
            counts = {s: n for s, n in counts.items() if n >= min_pair}
            mass = sum(counts.values())
            if mass < min_count:
                continue
            base = {s: p(c[1:], s) for s in counts}
            dist[c] = {s: (n + pull * base[s]) / (mass + pull) for s, n in counts.items()}, pull / (mass + pull)
            gain = sum(n / mass * math.log(n / mass / base[s]) for s, n in counts.items())
            if gain - (len(counts) - 1) / (2 * mass) >= divergence:
                keep |= {c[i:] for i in range(len(c))}
    once = sum(n == 1 for w, n in words.items() if w is not None)
    unknown = min(0.5, max(once, 0.5) / total)

    def score(ts):
        out = 0.0
        for c, s, w in ts:
            if words[w]:
                while c not in keep:
                    c = c[1:]
                out += math.log10(p(c, s) * words[w] / classes[s] * (1 - unknown))
            else:
                out += math.log10(unknown)
        return out

    return [score(ts) for ts in spoken], keep, p, classes


def in_training(i):
    return zlib.crc32(str(i if i is not None else "").encode()) % 10 != 0


def test_scores_equal_brute_force(spark, documents, words):
    rows = [(i, words(20 + i % 30, i // 3) + " I am a b c of the x y " * (i % 4)) for i in range(250)]
    rows += [(900, None), (901, ""), (902, "a a a a"), (903, "Ünseen wörds"), (3, "a second text of one id")]
    for depth, divergence in ((3, 0.02), (5, 0.3), (1, 0.0)):
        want, keep, p, classes = brute_force(rows, in_training, depth, divergence=divergence)
        found = lm.score(spark, documents(rows), fold("doc_id", 10) != 0, block_chars=3000, depth=depth, divergence=divergence)
        got = sorted((r["doc_id"], r["score"]) for r in found.collect())
        for (i, x), (j, y) in zip(got, sorted(zip((i for i, _ in rows), want)), strict=True):
            assert i == j and x == pytest.approx(y, rel=1e-9)
        assert len(keep) > 5
        for context in sorted(keep)[:40]:
            assert sum(p(context, s) for s in classes) == pytest.approx(1)


def test_the_tree_grows_with_the_corpus(spark, documents, words):
    """Ten times the documents, of other words: more states; the share of a context in the corpus plays no role."""
    states = []
    for size in (60, 600):
        rows = documents([(i, words(40, i)) for i in range(size)]).select(
            "doc_id", "text", F.lit(True).alias("train"), F.lit(0).alias("block")
        )
        held = cut_lineage(spark, lm.block_counts(rows, 4), "test-blocks").filter("at < 0")
        tree = lm.grow(spark, held.select("context", "class", "n"), 4)
        states.append(sum(s.count() for s in tree.states))
    assert states[1] > 2 * states[0] > 0


def test_held_out_gain(spark):
    from tarmac.llm import queries

    found = queries.op8_suffix_tree_lm(spark, "/root/testdata/sf0.01").filter("held_out")
    row = found.agg(F.sum("score"), F.sum("base_score"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()
    assert row[0] > row[1] and row[2] > 0.95


def test_words_with_a_common_beginning_are_told_apart(spark, documents):
    """Context decides between two longer words that begin alike; held-out texts swap them."""
    in_train = [i for i in range(200) if in_training(i)]
    rows = [(i, "cat running " * 3 if k % 2 else "dog runner " * 3) for k, i in enumerate(in_train)]
    right, wrong = (i for i in range(200, 260) if not in_training(i) and i % 2), (i for i in range(260, 400) if not in_training(i))
    a, b = next(right), next(wrong)
    rows += [(a, "cat running"), (b, "cat runner")]
    found = {r["doc_id"]: r for r in lm.score(spark, documents(rows), fold("doc_id", 10) != 0).collect()}
    assert found[a]["n_known"] == found[b]["n_known"] == 3
    assert found[a]["score"] > found[b]["score"] + 1


@pytest.mark.parametrize("spread", [0.0, 8.0])
def test_every_context_spreads_its_whole_mass(spark, documents, words, spread):
    rows = documents([(i, words(40, i // 4) + " of the sea of the land") for i in range(120)])
    rows = rows.select("doc_id", "text", F.lit(True).alias("train"), F.lit(0).alias("block"))
    held = cut_lineage(spark, lm.block_counts(rows, 3), "test-spread").filter("n > 0")
    tree = lm.grow(spark, held.select("context", "class", "n"), spread=spread)
    every = tree.states[0].select("context").join(tree.classes.select("class"), how="cross")
    sums = tree.chances(every).groupBy("context").agg(F.sum(F.pow(F.lit(10.0), "chance")).alias("p")).collect()
    assert len(sums) > 5 and all(r["p"] == pytest.approx(1) for r in sums)


def scratch_bytes(spark):
    root = Path(scratch_root(spark).removeprefix("file:"))
    return sum(p.stat().st_size for p in root.rglob("*.parquet"))


def test_what_is_written_stays_below_the_texts(spark, documents, words):
    """Random words: nearly every token is a pair of its own, which must not be written once for every table."""
    rows = [(i, words(400, i)) for i in range(600)]
    before = scratch_bytes(spark)
    scored = lm.score(spark, documents(rows), fold("doc_id", 10) != 0, spread=8.0)
    assert scored.count() == len(rows)
    assert scratch_bytes(spark) - before < 2.5 * sum(len(t) for _, t in rows)


def test_texts_are_not_shuffled(spark, documents, words, capsys):
    """Blocks form where the texts lie, so the scan is followed by Python and a write, with no exchange of texts."""
    rows = documents([(i, words(40, i)) for i in range(50)]).withColumn("train", F.lit(True))
    lm.spelled_blocks(rows, 3, 4, 500).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_packed_arrays_come_back():
    for numbers in ([], [0], [3, -1, 1 << 40], [(1 << 31) - 1, 5], [1 << 31]):
        for names in ([], ["a"], ["a b", "\n", "ü\U0001F600"]):
            data = lm.expanded(lm.squeezed(names, np.array(numbers, np.int64)))
            assert lm._names(data[0]) == names and lm._ints(data[1]).tolist() == numbers


def test_scores_do_not_depend_on_blocks_and_buckets(spark, documents, words):
    """Many blocks a task and many buckets against one of each."""
    rows = documents([(i, words(20 + i % 30, i // 3) + " I am a b c of the x y " * (i % 4)) for i in range(250)])
    some = [
        sorted((r["doc_id"], round(r["score"], 6), r["n_known"]) for r in lm.score(spark, docs, fold("doc_id", 10) != 0, block_chars=size).collect())
        for docs, size in ((rows.repartition(7), 300), (rows.coalesce(1), 10_000_000))
    ]
    assert some[0] == some[1]
