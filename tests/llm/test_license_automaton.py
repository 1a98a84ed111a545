"""The suffix automaton against plain search, and chains of spans."""

import random

from tarmac.llm import license_automaton as la


def places(words, phrases):
    found = []
    for phrase, label in phrases:
        p = phrase.split()
        found += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    return found


def test_phrases_equal_plain_search():
    draw = random.Random(3)
    phrases = [("a b a", "x"), ("b a", "y"), ("a b a b", "z"), ("c", "w"), ("a a", "x")]
    templates = [("a b c a b a c b a a", "t"), ("b a b a b a", "u")]
    scanner = la.Scanner(phrases, templates, 3, 2, 0.5)
    for _ in range(500):
        words = [draw.choice("abcd") for _ in range(draw.randint(0, 30))]
        got = scanner.scan(" ".join(words))
        want = places(words, phrases)
        assert got[0] == len(words) and got[1] == len(want)
        assert got[2] == min((k for k, _ in want), default=None) and got[3] == max((k for k, _ in want), default=None)
        assert got[4] == ",".join(sorted({x for _, x in want}))


def test_runs_are_the_longest_matches():
    template = "a b c d e a b d".split()
    automaton = la.Automaton([template], 0)
    draw = random.Random(1)
    grams = {tuple(template[i:j]) for i in range(8) for j in range(i + 1, 9)}
    for _ in range(300):
        words = [draw.choice("abcde") for _ in range(20)]
        longest = [max((n for n in range(p + 2) if tuple(words[p + 1 - n : p + 1]) in grams), default=0) for p in range(20)]
        ends = {end: n for _, end, n, final in automaton.runs(words, 2) if final}
        for p in range(20):
            grows = p < 19 and longest[p + 1] == longest[p] + 1
            assert ends.get(p + 1) == (longest[p] if longest[p] >= 2 and not grows else None)


def test_template_with_changes_is_covered():
    scanner = la.Scanner(la.PHRASES, la.TEMPLATES, 4, 12, 0.5)
    text, label = la.TEMPLATES[0]
    words = text.split()
    words[9:10] = ["some", "other", "words"]
    found = scanner.scan("Intro words here. " + " ".join(words).upper() + " and more")
    assert found[1] == 0 and label in found[5].split(",") and 0.8 < found[6] < 1
    span = found[7][0]
    assert span["start"] == 3 and span["end"] == 3 + len(words)
    assert scanner.scan("nothing of that kind at all, free of charge")[5] == ""


def test_awkward_rows(spark, awkward, documents):
    rows, docs = awkward
    found = la.license_scan(docs).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    for i in (1, 2, 3):
        assert (by[i]["n_words"], by[i]["n_base"], by[i]["first_word"], by[i]["labels"], by[i]["score"]) == (0, 0, None, "", 0)
    twice = documents([(1, "CC-BY-NC, cc by nc; Apache License, Version 2.0")])
    row = la.license_scan(twice).first()
    assert (row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == (3, 0, 6, "apache-2,cc-by-nc")
    assert la.license_scan(documents([])).count() == 0
