"""The matcher against brute-force edit distance, context, and accuracy on held-out documents."""

import random

import pytest
from pyspark.sql import functions as F

from tarmac.llm import queries, toxicity as tx


def distance(a, b):
    """Edits with swaps of neighbours, each letter edited once."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_matcher_equals_brute_force():
    entries = {"idiot": 5.0, "scum": 4.0, "pathetic": 5.0, "trash": 3.0, "vequ*": 2.0, "lostra*": 2.5}
    matcher = tx.Matcher(tx.Lexicon(entries))
    draw = random.Random(1)
    words = ["".join(draw.choice("idotscumr") for _ in range(draw.randint(1, 7))) for _ in range(2000)]
    for entry in entries:
        letters = entry.rstrip("*")
        for _ in range(300):
            w = list(letters + draw.choice(["", "s", "abc"]))
            for _ in range(draw.randint(0, 2)):
                at = draw.randrange(len(w))
                w[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "e", w[at] * 2])
            words.append("".join(w) or "x")
    for w in words:
        exact = w in entries or any(e.endswith("*") and w.startswith(e[:-1]) for e in entries)
        near = any(not e.endswith("*") and len(e) >= 5 and distance(w, e) <= 1 for e in entries)
        found = matcher.find(w)
        assert (found is not None) == (exact or near), w
        if found:
            assert found[1] == exact, w


def test_context_tells_quotation():
    matcher = tx.Matcher(tx.Lexicon({"idiot": 5.0}))
    assert [h[3] for h in tx.hits(matcher, 'he said "idiot" once. you idiot')] == [True, False]
    assert tx.hits(matcher, "clean words only") == []


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, small):
    scored = queries.op7_toxicity(spark, small)
    assert scored.count() == spark.read.parquet(f"{small}/documents.parquet").count()
    labels = spark.read.parquet(f"{small}/labels.parquet")
    held = scored.filter("held_out").join(labels, "doc_id")
    right = held.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right > 0.93
    assert held.filter("toxic = 0 AND predicted = 1").count() == 0


def test_awkward_rows_and_no_model(spark, awkward, documents):
    rows, docs = awkward
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)] + [(None, 1), (4, None)], "doc_id long, toxic int")
    model = tx.learn(spark, docs, labels)
    for m in (model, None):
        scored = tx.score(docs, m).collect()
        assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    assert tx.learn(spark, docs, labels.filter("toxic = 1")) is None
    assert tx.score(documents([]), model).count() == 0


def test_misspelled_terms_and_stems_are_met_beside_each_other():
    """Inflected terms share a stem that is an entry too; each is met with an edit, and so is the stem."""
    rng = random.Random(3)
    entries = {"idiot": 6.0, "idiots": 5.0, "idio*": 4.0, "idiot*": 4.5, "stupid": 5.0, "stupi*": 4.5, "mor*": 3.0}
    matcher = tx.Matcher(tx.Lexicon(entries, fuzzy_stems=frozenset(e for e in entries if e.endswith("*"))))
    assert matcher.find("idoit") == ("idiot", False) and matcher.find("idoits") is not None
    assert matcher.find("stuipd") is not None and matcher.find("idiotic") == ("idiot*", True)
    assert matcher.find("stuipdity") == matcher.find("stupxdity") == ("stupi*", False)
    words = ["idiotic", "stupidly", "moron", "mxron"] + ["".join(rng.choice("idotsup") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    for w in words:
        begins = [w[:n] for n in range(len(w) + 1)]
        exact = w in entries or any(e.endswith("*") and w.startswith(e[:-1]) for e in entries)
        near = any(
            any(distance(b, e[:-1]) <= 1 for b in begins) if e.endswith("*") else distance(w, e) <= 1
            for e in entries if len(e.rstrip("*")) >= 5
        )
        found = matcher.find(w)
        assert (found is not None) == (exact or near), w
        assert not found or found[1] == exact


def test_inflected_terms_keep_their_misspellings(spark, documents, words):
    labels, rows = [], []
    for i in range(200):
        toxic = i % 2
        rows.append((i, f"{words(9, i)} {('idiot', 'idiots')[i // 2 % 2] if toxic else 'friend'} {words(3, 500 + i)}"))
        labels.append((i, toxic))
    model = tx.learn(spark, documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"idiot", "idiots"} <= set(model.lexicon.weights)
    by = {r["doc_id"]: r for r in tx.score(documents([(1, "you idoit there"), (2, "you frined there")]), model).collect()}
    assert by[1]["predicted"] == 1 and by[2]["predicted"] == 0


def test_rare_terms_and_copies(spark, documents, words):
    """A term of few of many toxic texts counts, and copies of one toxic text don't raise what others must reach."""
    rows = [(i, f"{words(12, i)} friend") for i in range(1200)]
    rows += [(2000 + i, f"{words(12, 5000 + i)} {'dumbhead' if i < 12 else 'fool'}") for i in range(1000)]
    rows += [(4000 + i, "zumbrella zumbrella zumbrella") for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i >= 2000)) for i, _ in rows], "doc_id long, toxic int")
    model = tx.learn(spark, documents(rows), labels)
    assert {"dumbhead", "fool"} <= set(model.lexicon.weights)
    assert "zumbrella" not in model.lexicon.weights
