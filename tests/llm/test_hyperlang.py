"""Language profiles: binding by hand, held-out accuracy, texts without letters."""

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import hyperlang as hl, queries


def test_a_text_is_the_sum_of_its_bound_trigrams():
    size = 128
    text = "ab Ab"
    want = np.zeros(size)
    for gram in (" ab", "ab ", "b a", " ab", "ab "):
        bound = np.ones(size)
        for place, letter in enumerate(gram):
            point = 0 if letter == " " else ord(letter)
            bound = bound * np.roll(hl.letter_vector(point, size), 2 - place)
        want += bound
    got = hl.bundles([text, "12 !?", ""], size)
    assert np.allclose(got[0], want / np.linalg.norm(want), atol=1e-6)
    assert not got[1:].any()


def test_order_of_letters_matters():
    size = 1024
    a, b = hl.bundles(["abc", "cba"], size)
    assert abs(a @ b) < 0.2


def test_held_out_accuracy(spark):
    small = "/root/testdata/sf0.01"
    found = queries.op10_language_id(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    held = found.filter("held_out").join(docs, "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_awkward_rows(spark, awkward, documents):
    rows, docs = awkward
    learned = documents([(i, "the and of with that") for i in range(20)], "en").union(
        documents([(50 + i, "der die und das mit ß") for i in range(20)], "de")
    )
    prototypes = hl.learn(learned.union(documents([(99, "abc")], None)))
    assert sorted(prototypes) == ["de", "en"]
    found = hl.identify(docs, prototypes).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by[2]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in found)
    empty = hl.learn(documents([]))
    assert empty == {} and {r["lang_pred"] for r in hl.identify(docs, empty).collect()} == {"und"}
    assert hl.identify(documents([]), prototypes).count() == 0


def test_the_sample_does_not_depend_on_partitions(spark, documents, words):
    docs = documents([(i, words(20, i)) for i in range(200)], "xx")
    one, other = hl.learn(docs, per_language=30), hl.learn(docs.repartition(7), per_language=30)
    assert np.allclose(one["xx"], other["xx"])


def test_a_long_text_of_many_letters_is_bundled_in_slices():
    """Half a million letters of a large alphabet: the vectors of all its trigrams would take one gigabyte."""
    import tracemalloc

    draw = np.random.default_rng(3)
    text = "".join(map(chr, draw.integers(0x4E00, 0x9F00, 500_000)))
    tracemalloc.start()
    bundled = hl.bundles(["abc", text, ""], 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and not bundled[2].any()
    small = text[:9000]
    rows, grams = hl.trigrams([small])
    direct = hl.trigram_vectors(grams, 64).sum(axis=0)
    assert np.allclose(hl.bundles([small], 64)[0], direct / np.linalg.norm(direct), atol=1e-5)
