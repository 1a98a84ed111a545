"""The pipeline stage by stage against plain Python on the smallest tables, and on awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tarmac.llm import common, cutting_stock, hyperlang, ngram_jaccard, queries, toxicity
from tarmac.llm.common import fold, words_of
from tarmac.session import cut_lineage

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage, written and read as the check does."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in cp.STAGES:
        found.append(cut_lineage(spark, stage(spark, found[-1], SMALL), f"test-{name}"))
    return found


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic").filter(fold("doc_id", 5) != 0)
    model = toxicity.learn(spark, stages[0], labels)
    matcher = toxicity.Matcher(model.lexicon)
    want = {
        r["doc_id"] for r in stages[0].collect()
        if model.score(np.array([toxicity.features(matcher, r["text"] or "", model.window)]))[0] < 0.5
    }
    assert ids(stages[1]) == want and len(want) < stages[0].count()


def test_documents_of_a_language_stay(stages):
    labelled = stages[1].filter(fold("doc_id", 5) != 0)
    prototypes = hyperlang.learn(labelled)
    known = set(hyperlang.known_trigrams(labelled).tolist())
    letters = {g >> shift & 0x1FFFFF for g in known for shift in (42, 21, 0)}
    want = set()
    for r in stages[1].collect():
        grams = hyperlang.trigrams([r["text"]])[1].tolist()
        if not grams:
            continue
        vector = hyperlang.bundles([r["text"]], 512)[0]
        like = max(float(vector @ p) for p in prototypes.values()) >= cp.LEAST_COSINE
        if len(grams) < 20:
            like |= any(g >> 21 & 0x1FFFFF in letters - {0} for g in grams)
        else:
            like |= sum(g in known for g in grams) >= 0.5 * len(grams)
        if like:
            want.add(r["doc_id"])
    assert ids(stages[2]) == want


def test_one_document_of_each_group_stays(stages):
    sets = {}
    for r in stages[2].collect():
        w = words_of(r["text"])
        k = min(5, len(w))
        sets[r["doc_id"]] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert ids(stages[3]) == {i for i in sets if find(i) == i}
    assert stages[3].count() < stages[2].count()


def test_all_tokens_are_packed_once(stages):
    library = Tokenizer.from_file(queries.vocabulary_path())
    pieces = stages[4].toPandas().sort_values(["doc_id", "start"])
    for r in stages[3].collect():
        tokens = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        own = pieces[pieces["doc_id"] == r["doc_id"]]
        assert own["length"].sum() == len(tokens) == own["doc_tokens"].iloc[0]
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(tokens[p.start : p.start + p.length].tobytes())
    assert set(pieces["doc_id"]) == ids(stages[3])


def test_run_is_the_stages(spark, stages):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    run = sorted(map(tuple, cp.run(spark, SMALL).select(names).collect()))
    assert run == sorted(map(tuple, stages[4].select(names).collect()))


def test_awkward_rows(spark, words):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id long, _flags int"
    rows = [(1, None), (2, ""), (3, "12 34"), (4, words(80, 1)), (5, words(80, 1)), (4, words(80, 1)), (None, words(20, 3)), (6, "ein Wort")]
    docs = spark.createDataFrame([(i, t, "en" if i != 6 else None, None, None, "s", 0, 1) for i, t in rows], schema)
    for name, stage in cp.STAGES[:-1]:
        out = cut_lineage(spark, stage(spark, docs, SMALL), f"awkward-{name}")
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "3", "4", "6", "None"]
    kept = cp.drop_foreign(spark, docs, SMALL)
    assert kept.filter(F.col("doc_id").isin(1, 2, 3)).count() == 0 and kept.filter("doc_id = 4").count() == 2
    assert cp.pack(spark, docs, SMALL).agg(F.sum("length")).first()[0] > len(rows)


def test_foreign_texts_and_gibberish_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    draw = np.random.default_rng(5)

    def text(letters):
        return " ".join("".join(draw.choice(list(letters), draw.integers(2, 9))) for _ in range(60))

    kinds = ["αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыьэюя", "abcdefghijklmnopqrstuvwxyz"]
    planted = [(10**9 + 100 * k + i, text(letters)) for k, letters in enumerate(kinds) for i in range(50)]
    planted = spark.createDataFrame(planted, "doc_id long, text string")
    kept = cut_lineage(spark, cp.drop_foreign(spark, docs.unionByName(planted, allowMissingColumns=True), SMALL), "foreign")
    left = [kept.filter(f"doc_id DIV 100 = {10**7 + k}").count() for k in range(3)]
    assert left[0] == left[1] == 0 and left[2] <= 5
    lettered = docs.filter(F.col("text").rlike("\\p{L}")).count()
    assert kept.filter("doc_id < 1000000000").count() == lettered


def test_texts_go_to_python_in_small_batches(spark, words, monkeypatch):
    """All tables made from texts by Python are written under the setting, which ends with them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(name), {}
    for module in (cp, ngram_jaccard, cutting_stock):
        def noted(spark, df, path, write=module.cut_lineage):
            seen[path] = spark.conf.get(name)
            return write(spark, df, path)

        monkeypatch.setattr(module, "cut_lineage", noted)
    docs = spark.createDataFrame([(i, words(80, i // 2) + " end" * (i % 2), "en") for i in range(40)], "doc_id long, text string, lang string")
    learnt = toxicity.Model(toxicity.Lexicon({"zzzz": 3.0}), (1.0,) * len(toxicity.FEATURES), -9.0, 8)
    monkeypatch.setattr(toxicity, "learn", lambda *_: learnt)
    for _, stage in cp.STAGES:
        stage(spark, docs, SMALL)
        assert spark.conf.get(name) == before
    assert {seen[x] for x in ("not-toxic", "not-foreign", "described", "sets", "pieces")} == {"1000"}


def test_workers_give_memory_back(monkeypatch):
    """After a task's last batch, when nothing of it is held any more; all batches come through."""
    calls = []
    monkeypatch.setattr(common, "_trim", lambda: calls.append(1))
    task = common.trimmed(lambda batches: (2 * b for b in batches))(iter([1, 2]))
    assert next(task) == 2 and not calls
    assert list(task) == [4] and calls == [1]
    monkeypatch.undo()
    common._trim()
