"""License scan: a generalised suffix automaton of license texts, streamed over the words of a document.

The automaton holds every run of words of every template. One pass over a document gives its matching
statistics: at each word, the longest run ending there that occurs in some template. Runs that cannot grow
further are chained, template by template, into spans that cover the template in order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tarmac.llm.common import texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Phrases whose places are counted, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Sentences that open well-known licenses or their notices, with the label of the license.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with "
     "the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this work is licensed under a creative commons attribution noncommercial license", "cc-by-nc"),
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,start:int,end:int,covered:double>>"
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


class Automaton:
    """Suffix automaton of several word sequences.

    ``ends[state]`` maps a template to the position behind one place where the runs of the state occur in it.
    ``phrases[state]`` lists (length, index) of the whole phrases that end where the state's runs end.
    """

    def __init__(self, sequences: list[list[str]], phrase_count: int):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        whole: dict[int, list[tuple[int, int]]] = {}
        for index, sequence in enumerate(sequences):
            state = 0
            for position, word in enumerate(sequence):
                state = self._extend(state, word)
                self.ends[state].setdefault(index, position + 1)
            if index < phrase_count and sequence:
                whole.setdefault(state, []).append((len(sequence), index))
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for state in reversed(order):
            for index, end in self.ends[state].items():
                self.ends[self.link[state]].setdefault(index, end)
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.link]
        for state in order:
            self.phrases[state] = self.phrases[self.link[state]] + whole.get(state, [])

    def _add(self, length: int, link: int, follow: dict[str, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, state: int, word: str, target: int) -> int:
        """A copy of ``target`` for the shorter runs that reach it from ``state``."""
        copy = self._add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: str) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._add(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            same = self.length[target] == self.length[state] + 1
            self.link[new] = target if same else self._split(state, word, target)
        return new

    def runs(self, words: list[str], least: int) -> Iterator[tuple[int, int, int, bool]]:
        """(state, end, length, final) behind every word that matches; final runs cannot grow and reach ``least``."""
        state, length, known = 0, 0, self.next[0]
        follow, link, longest = self.next, self.link, self.length
        for position, word in enumerate(words):
            target = follow[state].get(word)
            if target is None:
                if state:
                    if length >= least:
                        yield state, position, length, True
                    if word in known:
                        while word not in follow[state]:
                            state = link[state]
                        length = min(length, longest[state]) + 1
                        state = follow[state][word]
                    else:
                        state = length = 0
            else:
                state, length = target, length + 1
            if state and self.phrases[state]:
                yield state, position + 1, length, False
        if state and length >= least:
            yield state, len(words), length, True


class Scanner:
    def __init__(self, phrases, templates, min_run: int, max_gap: int, min_cover: float):
        self.labels = [label for _, label in (*phrases, *templates)]
        sequences = [words_of(text) for text, _ in (*phrases, *templates)]
        self.sizes = [max(1, len(s)) for s in sequences]
        self.n_phrases = len(phrases)
        self.min_run, self.max_gap, self.min_cover = min_run, max_gap, min_cover
        self.automaton = Automaton(sequences, len(phrases))

    def chains(self, runs: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """The covered spans of each template: (label, first word, behind the last word, share covered)."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for state, end, length in runs:
            for index, template_end in self.automaton.ends[state].items():
                if index >= self.n_phrases:
                    by_template.setdefault(index, []).append((end - length, template_end - length, length))
        spans = []
        for index, found in by_template.items():
            best: list[tuple[int, int]] = []  # (words covered, where the chain starts) by last run
            for i, (start, at, length) in enumerate(found):
                covered, origin = length, start
                for j in range(i - 1, -1, -1):
                    before, before_at, before_length = found[j]
                    if start - before - before_length > self.max_gap:
                        break
                    overlap = max(0, before + before_length - start, before_at + before_length - at)
                    if before < start and before_at < at and overlap < length:
                        if best[j][0] + length - overlap > covered:
                            covered, origin = best[j][0] + length - overlap, best[j][1]
                best.append((covered, origin))
            share = [min(1.0, c / self.sizes[index]) for c, _ in best]
            top: dict[int, tuple[float, int]] = {}
            for (_, origin), cover, (start, _, length) in zip(best, share, found):
                if cover > top.get(origin, (0.0, 0))[0]:
                    top[origin] = (cover, start + length)
            spans += [
                (self.labels[index], origin, end, cover)
                for origin, (cover, end) in sorted(top.items())
                if cover >= self.min_cover
            ]
        return spans

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        places, runs, base = [], [], set()
        seen = -1
        for state, end, length, final in self.automaton.runs(words, self.min_run):
            if final:
                runs.append((state, end, length))
            elif end != seen:
                seen = end
                for size, index in self.automaton.phrases[state]:
                    if size <= length:
                        places.append(end - size)
                        base.add(self.labels[index])
        spans = self.chains(runs) if runs else []
        score = 1.0 if places else max((cover for *_, cover in spans), default=0.0)
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | {s[0] for s in spans})), score,
            [{"label": a, "start": b, "end": c, "covered": d} for a, b, c, d in spans],
        )


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    min_run: int = 4,
    max_gap: int = 12,
    min_cover: float = 0.5,
) -> DataFrame:
    """Find license phrases and spans of license templates in every document.

    Returns one row per input row: doc_id, n_words, n_base (places of the phrases), first_word and last_word
    (smallest and largest start of such a place, counted in words; null without one), base_labels, labels
    (also of the templates covered to ``min_cover``; distinct, sorted, joined by commas), score (1 with a
    phrase, else the largest covered share) and spans. Runs shorter than ``min_run`` words and gaps above
    ``max_gap`` words do not extend a span. Null and empty texts have no words and score 0; repeated rows and
    ids stay as they are.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, templates, min_run, max_gap, min_cover)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            found = [(i, *scanner.scan(t)) for i, t in zip(batch["doc_id"].array, batch["text"])]
            out = pd.DataFrame(found, columns=names)
            for c in ("doc_id", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return texts(docs, id_col, text_col).mapInPandas(scan, SCHEMA)
