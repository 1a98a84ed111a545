"""Merkle fingerprints: equality, the edited texts, and what the likeness tells."""

import hashlib

from pyspark.sql import functions as F

from tarmac.llm import merkle


def edited(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for at, (i, t) in enumerate(order):
        following = order[(at + 1) % len(order)][1] or ""
        t = t or ""
        n = len(t) // 3
        out[i] = t[: len(t) - n] + following[:n]
    return out


def test_edited_texts_and_likeness(spark, documents, words):
    rows = [(7 * i, "\n".join(words(12, 10 * i + j).capitalize() + "." for j in range(1 + i % 9))) for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "é😀x"), (1003, rows[5][1]), (-4, words(900, 3))]
    for per_block in (3, 200):
        found = {r["doc_id"]: r for r in merkle.edit_study(spark, documents(rows), rows_per_block=per_block).collect()}
        assert len(found) == len(rows)
        for i, text in edited(rows).items():
            assert found[i]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest(), i
            assert 0 <= found[i]["near_edited"] <= 1 and 0 <= found[i]["near_next"] <= 1
            assert found[i]["n_chars"] == len(dict(rows)[i] or "")
        assert found[1003]["fingerprint"] == found[35]["fingerprint"]
        texts = {}
        for i, t in rows:
            texts.setdefault(t or "", set()).add(found[i]["fingerprint"])
        assert all(len(f) == 1 for f in texts.values())
        assert len({f for fs in texts.values() for f in fs}) == len(texts)
        long = [r for r in found.values() if r["n_chars"] > 200]
        assert all(r["near_edited"] > 0.5 > 0.2 > r["near_next"] for r in long)


def test_an_edit_leaves_other_branches(spark, documents, words):
    lines = [words(10, i) + "." for i in range(40)]
    changed = lines[:20] + [words(10, 99) + "."] + lines[21:]
    inserted = lines[:3] + [words(10, 98) + "."] + lines[3:]
    docs = documents([(i, "\n".join(x)) for i, x in enumerate((lines, changed, inserted))])
    a, b, c = [r["fingerprint"] for r in merkle.fingerprints(docs).orderBy("doc_id").collect()]
    split = lambda f: set(f.split("/")[1].split(")"))
    assert a != b and len(split(a) - split(b)) == 1
    assert len(split(a) - split(c)) <= 1


def test_same_text_is_one_and_plan_has_no_python(spark, documents):
    docs = documents([(1, "same. text"), (2, "same. text")])
    study = merkle.edit_study(spark, docs)
    assert {r["near_next"] for r in study.collect()} == {1.0}
    plan = study._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_awkward_rows(spark, awkward):
    rows, docs = awkward
    found = merkle.edit_study(spark, docs, rows_per_block=3).collect()
    assert len(found) == len(rows)
    assert all(r["edited_sha256"] and r["fingerprint"] and r["edited_fingerprint"] for r in found)


def test_empty_and_single(spark, documents):
    assert merkle.edit_study(spark, documents([])).count() == 0
    one = merkle.edit_study(spark, documents([(5, "abcdef")])).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one[0]["near_next"] == 1.0


def test_repeated_leaves_are_read_back(spark):
    text = "Thhaen " * 50
    row = spark.createDataFrame([(text,)], "t string").select(merkle.leaf_set(merkle.fingerprint(F.col("t"))).alias("s")).first()
    assert 1 <= len(row["s"]) <= 50 and all(len(x) == merkle.LEAF_DIGITS for x in row["s"])
