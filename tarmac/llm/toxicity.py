"""Toxicity scores from a learned lexicon, matched with misspellings and weighed by context.

The lexicon (whole terms, and stems that stand for everything that begins with them) is learned from labelled
documents and kept as a trie. The Levenshtein automata of all its entries are intersected with that trie
and made deterministic on demand: a state is a set of (trie node, edits left), so one walk over a word's
letters finds the entries within reach, and words share the states of their common beginnings. Every
hit is then read in its window of words: quotation marks or words of reporting around it speak for quotation,
further hits close by for abuse. A logistic model over those sums gives the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_sample, texts, trimmed
from tarmac.session import cut_lineage

WORD = re.compile(r"[^\W\d_]+")
#: Words that introduce somebody else's speech, in a few languages.
REPORTING = frozenset(
    "said says called calls quote quoted word term wrote sagte nennt wort dit appelle mot dijo llama palabra".split()
)
MARKS = "\"'«»“”„‘’`"
STEM_SIZES = (4, 5, 6)
CACHE = 200_000


@dataclass(frozen=True)
class Lexicon:
    """Entries with their weights (log odds); a trailing ``*`` marks a stem."""

    weights: dict[str, float]
    min_fuzzy: int = 5
    fuzzy_stems: frozenset[str] = frozenset()


class Matcher:
    """Deterministic product of the lexicon trie and its Levenshtein automata, built as words ask for it.

    Whole terms of ``min_fuzzy`` letters or more are met within one edit (insertion, deletion, substitution or
    two neighbours swapped), shorter ones exactly. A stem is met by any word that begins with it, one of
    ``fuzzy_stems`` with ``min_fuzzy`` letters or more also by a word that begins within one edit of it.
    """

    def __init__(self, lexicon: Lexicon):
        self.weights = lexicon.weights
        self.children: list[dict[str, int]] = [{}]
        self.terms: list[list[str]] = [[]]
        self.reach: list[int] = [0]  # the longest entry below a node that allows an edit
        self.min_fuzzy, self.fuzzy_stems = lexicon.min_fuzzy, lexicon.fuzzy_stems
        for entry in sorted(lexicon.weights):
            node, letters = 0, entry.rstrip("*")
            reach = len(letters) if entry in self.fuzzy_stems or not entry.endswith("*") else 0
            self.reach[0] = max(self.reach[0], reach)
            for letter in letters:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.terms.append([])
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], reach)
            self.terms[node].append(entry)
        start = self._close({(0, 0, "")})
        self.states: dict[frozenset, int] = {start: 0}
        self.sets: list[frozenset] = [start]
        self.follow: list[dict[str, int]] = [{}]
        self.accepts = [self._accept(start)]
        self.begins = [self._accept(start, stems=True)]
        self.cache: dict[str, tuple[str, bool] | None] = {}

    def _fuzzy(self, node: int) -> bool:
        return self.reach[node] >= self.min_fuzzy

    def _close(self, items: set) -> frozenset:
        """Add the states that skip one letter of an entry."""
        found = set(items)
        for node, edits, owed in items:
            if not edits and not owed and node >= 0:
                found.update((c, 1, "") for c in self.children[node].values() if self._fuzzy(c))
        return frozenset(found)

    def _accept(self, items: frozenset, stems: bool = False) -> tuple[float, str, bool] | None:
        """The best entry, or the best stem, that ends here: (weight, entry, exact)."""
        best = None
        for node, edits, owed in items:
            if owed:
                continue
            for entry in self.terms[node]:
                stem = entry.endswith("*")
                if stems and not stem:
                    continue
                if edits and (stem and entry not in self.fuzzy_stems or len(entry) - stem < self.min_fuzzy):
                    continue
                found = (self.weights[entry], entry, not edits)
                if best is None or (found[2], found[0], entry) > (best[2], best[0], best[1]):
                    best = found
        return best

    def _step(self, state: int, letter: str) -> int:
        moved: set = set()
        for node, edits, owed in self.sets[state]:
            if owed:  # the second of two swapped letters
                if owed == letter:
                    moved.add((node, 1, ""))
                continue
            same = self.children[node].get(letter)
            if same is not None:
                moved.add((same, edits, ""))
            if not edits and self._fuzzy(node):
                moved.add((node, 1, ""))
                for other, child in self.children[node].items():
                    if child != same and self._fuzzy(child):
                        moved.add((child, 1, ""))
                        after = self.children[child].get(letter)
                        if after is not None and self._fuzzy(after):
                            moved.add((after, 0, other))
        key = self._close(moved)
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.follow.append({})
            self.accepts.append(self._accept(key))
            self.begins.append(self._accept(key, stems=True))
        return self.states[key]

    def _stems(self, state: int, best):
        found = self.begins[state]
        if found and (best is None or (found[2], found[0]) > (best[2], best[0])):
            return found
        return best

    def find(self, word: str) -> tuple[str, bool] | None:
        """(entry, exact) of the best entry for a word."""
        if word in self.cache:
            return self.cache[word]
        state, best = 0, None
        for letter in word:
            target = self.follow[state].get(letter)
            if target is None:
                target = self.follow[state][letter] = self._step(state, letter)
            state = target
            if not self.sets[state]:
                break
            best = self._stems(state, best)
        else:
            last = self.accepts[state]
            if last and (best is None or (last[2], last[0]) > (best[2], best[0])):
                best = last
        if len(self.cache) >= CACHE:
            self.cache.clear()
        self.cache[word] = found = best and (best[1], best[2])
        return found


def stems_near(matcher: Matcher, word: str) -> set[str]:
    """All stems that a word meets with an edit."""
    state, found = 0, set()
    for letter in word:
        if letter not in matcher.follow[state]:
            matcher.follow[state][letter] = matcher._step(state, letter)
        state = matcher.follow[state][letter]
        for node, edits, owed in matcher.sets[state]:
            if edits and not owed:
                found.update(e for e in matcher.terms[node] if e in matcher.fuzzy_stems and len(e) > matcher.min_fuzzy)
    return found


FEATURES = ("hits", "entries", "strongest", "quoted", "dense", "share")
#: What a misspelled term counts for, of an exact one.
FUZZY = 0.7


def hits(matcher: Matcher, text: str, window: int = 8) -> list[tuple[int, str, bool, bool, int]]:
    """(word position, entry, exact, quoted, hits nearby) for every hit of a text."""
    lower = text.lower()
    words = WORD.findall(lower)
    known = {w: f for w in set(words) if (f := matcher.find(w))}
    if not known:
        return []
    spans = [(i, m.start(), m.end(), known[m[0]]) for i, m in enumerate(WORD.finditer(lower)) if m[0] in known]
    found = []
    for at, (i, start, end, (entry, exact)) in enumerate(spans):
        line = lower.rfind("\n", 0, start) + 1
        before, after = lower[max(line, start - 60) : start], lower[end : end + 60].split("\n")[0]
        marked = any(m in before for m in MARKS) and any(m in after for m in MARKS)
        quoted = marked or not REPORTING.isdisjoint(words[max(0, i - 3) : i])
        near = sum(abs(spans[j][0] - i) <= window for j in range(max(0, at - window), min(len(spans), at + window + 1)))
        found.append((i, entry, exact, quoted, near - 1))
    return found


def features(matcher: Matcher, text: str, window: int = 8) -> list[float]:
    found = hits(matcher, text, window)
    if not found:
        return [0.0] * len(FEATURES)
    plain = [f for f in found if not f[3]]
    exact, fuzzy = sum(f[2] for f in plain), sum(not f[2] for f in plain)
    words = len(WORD.findall(text))
    return [
        np.log1p(exact + FUZZY * fuzzy),
        np.log1p(len({f[1] for f in plain})),
        max((matcher.weights[f[1]] * (1.0 if f[2] else FUZZY) for f in plain), default=0.0) / 5,
        np.log1p(sum(f[3] for f in found)),
        np.log1p(sum(f[4] > 0 for f in plain)),
        min(1.0, 10 * len(plain) / max(1, words)),
    ]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: tuple[float, ...]
    bias: float
    window: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(rows @ np.array(self.weights) + self.bias, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[tuple[float, ...], float]:
    """Newton's method on the penalised log likelihood."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    beta = np.zeros(x1.shape[1])
    for _ in range(30):  # sums without the threaded BLAS, which can stand still in a driver that runs Spark
        p = 1 / (1 + np.exp(-np.clip((x1 * beta).sum(axis=1), -30, 30)))
        slope = (x1 * (y - p)[:, None]).sum(axis=0) - (penalty * beta).sum(axis=1)
        step = np.linalg.solve(np.einsum("ni,n,nj->ij", x1, p * (1 - p), x1) + penalty, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta[:-1]), float(beta[-1])


def _candidates(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in STEM_SIZES if len(w) > n}


def _tail(toxic: int, texts: int, share: float) -> float:
    """The probability that ``toxic`` or more of ``texts`` are toxic if each is with probability ``share``."""
    k = np.arange(toxic, texts + 1)
    ways = lgamma(texts + 1) - np.array([lgamma(i + 1) + lgamma(texts - i + 1) for i in k])
    return float(np.exp(ways + k * np.log(share) + (texts - k) * np.log1p(-share)).sum())


def _mark(text: str) -> int:
    """The least hash of three words in a row, which near copies nearly always share and other texts hardly ever."""
    words = WORD.findall(text.lower())
    hashes = np.array([crc32(w.encode()) for w in words], np.uint64)
    while len(hashes) < 3:
        hashes = np.append(hashes, np.uint64(0))
    mixed = (hashes[:-2] * np.uint64(3) + hashes[1:-1]) * np.uint64(5) + hashes[2:] + np.uint64(1)
    mixed = (mixed ^ mixed >> np.uint64(15)) * np.uint64(0x9E3779B97F4A7C15)
    return int((mixed ^ mixed >> np.uint64(31)).min() >> np.uint64(1))


def learn(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 8_000,
    min_docs: int = 3,
    min_weight: float = 2.5,
    chance: float = 5.0,
    window: int = 8,
) -> Model | None:
    """Learn lexicon and weights from at most about ``per_class`` labelled documents of each label.

    The sample is chosen by a hash of the id over all rows of ``labels``; only its ids, bounded by ``per_class``,
    are broadcast to the documents. Labels other than 0 and 1 and rows without a document are ignored, null
    texts are empty. The lexicon holds all terms and stems with log odds of ``min_weight`` or more that occur in
    at least ``min_docs`` toxic texts, if as many of their texts would be toxic by chance for no more than
    ``chance`` of all entries tested. Stems are left out, or not met with an edit, where the words met so
    that are no terms themselves occur in ``min_docs`` clean texts and have lower log odds. There is no share of the texts to reach, and the sample alone bounds their
    number. Equal texts of a label count once, in the counts and in the class sizes, and so do near copies.
    Terms stay beside their stems, so that misspellings of them are met too.
    None if a label is missing altogether.
    """
    labelled = labels.select(id_col, F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    chosen = bounded_sample(labelled, "label", id_col, per_class)
    texts_of = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = cut_lineage(spark, texts_of.join(F.broadcast(chosen), id_col).select("text", "label"), "sample")
    different = cut_lineage(spark, rows.distinct(), "different")
    sizes = {r["label"]: r["count"] for r in different.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None

    @trimmed
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                for entry in _candidates(text):
                    seen.setdefault(entry, [0, 0])[label] += 1
            yield pd.DataFrame([(e, n[0], n[1]) for e, n in seen.items()], columns=["entry", "clean", "toxic"])

    counted = (
        different.mapInPandas(count, "entry string, clean long, toxic long")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= min_docs)
    )
    counted = cut_lineage(spark, counted, "entries")
    tests = counted.count()

    def weigh(sizes: dict[int, int]) -> Column:
        return F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))

    def strong(table: DataFrame, sizes: dict[int, int]) -> dict[str, float]:
        """Entries whose counts by chance would be expected ``chance`` times or less among all, with weights."""
        rows = table.filter(F.col("toxic") >= min_docs).withColumn("weight", weigh(sizes))
        rows = rows.filter(F.col("weight") >= min_weight)
        share = sizes[1] / (sizes[0] + sizes[1])
        return {
            r["entry"]: r["weight"] for r in rows.collect()
            if tests * _tail(r["toxic"], r["toxic"] + r["clean"], share) <= chance
        }

    first = strong(counted, sizes)

    @trimmed
    def group(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(Lexicon(first, fuzzy_stems=frozenset(e for e in first if e.endswith("*"))))
        near: dict[str, set[str]] = {}
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["label"]):
                mark = _mark(text)
                own, stems, edits = {""}, set(), set()
                for word in set(WORD.findall(text.lower())):
                    below = {s for n in STEM_SIZES if len(word) > n and (s := word[:n] + "*") in first}
                    own |= below
                    if word in first:
                        own.add(word)
                    elif below:
                        stems |= below
                    else:
                        if word not in near:
                            near[word] = stems_near(matcher, word)
                        edits |= near[word]
                out += [(e, k, label, mark) for k, found in enumerate((own, stems, edits)) for e in found]
            yield pd.DataFrame(out, columns=["entry", "kind", "label", "mark"])

    marked = different.mapInPandas(group, "entry string, kind int, label int, mark long").distinct()
    marked = marked.groupBy("entry", "kind").agg(
        F.count_if(F.col("label") == 0).alias("clean"), F.count_if(F.col("label") == 1).alias("toxic")
    )
    marked = cut_lineage(spark, marked, "marked")
    groups = marked.filter("entry = ''").first()
    sizes = {0: groups["clean"], 1: groups["toxic"]}
    refuted = marked.filter((F.col("kind") > 0) & (F.col("clean") >= min_docs) & (weigh(sizes) < min_weight)).collect()
    no_stems, exact_only = ({r["entry"] for r in refuted if r["kind"] == k} for k in (1, 2))
    entries = strong(marked.filter("kind = 0 AND entry <> ''"), sizes)
    entries = {e: w for e, w in entries.items() if e not in no_stems}
    lexicon = Lexicon(entries, fuzzy_stems=frozenset(e for e in entries if e.endswith("*") and e not in exact_only))

    @trimmed
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon)
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "x": [features(matcher, t, window) for t in batch["text"]]})

    sample = rows.mapInPandas(measure, "label int, x array<double>").toPandas()
    x = np.stack(sample["x"].to_numpy())
    order = np.lexsort((*x.T, sample["label"].to_numpy()))  # sums must not depend on the order of arrival
    weights, bias = _logistic(x[order], sample["label"].to_numpy(float)[order])
    return Model(lexicon, weights, bias, window)


def probability(model: Model, text: Column) -> Column:
    """The score alone, as a column; null counts as empty."""

    @F.pandas_udf("double")
    @trimmed
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model.lexicon)
        for batch in batches:
            x = np.array([features(matcher, t, model.window) for t in batch]).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x))

    return run(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, hits) for every row: the probability of label 1, whether it is at least 0.5,
    and the hits (word position, entry, exact, quoted).

    Null and empty texts have no hit and get the score of a text without hits; without a model, all texts
    get 0. Repeated rows and ids stay as they are.
    """
    schema = (
        "doc_id long, score double, predicted int, "
        "hits array<struct<word:int,entry:string,exact:boolean,quoted:boolean>>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(model.lexicon) if model else None
        for batch in batches:
            out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "score": 0.0})
            out["hits"] = [[] for _ in range(len(batch))]
            if model and len(batch):
                x = np.array([features(matcher, t, model.window) for t in batch["text"]])
                out["score"] = model.score(x)
                out["hits"] = [
                    [{"word": h[0], "entry": h[1], "exact": h[2], "quoted": h[3]} for h in hits(matcher, t, model.window)]
                    if row.any() else []
                    for t, row in zip(batch["text"], x)
                ]
            out["predicted"] = (out["score"] >= 0.5).astype("int32")
            yield out[["doc_id", "score", "predicted", "hits"]]

    return texts(docs, id_col, text_col).mapInPandas(run, schema)
