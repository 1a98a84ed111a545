"""Runs of words that repeat with a period, found by minimizers on several scales.

A run is a longest stretch of words in which words ``q`` apart are equal, with ``q`` its smallest period and at
least ``2 * q`` words. Periods below ``SHORTEST`` are found by comparing the words with themselves at every such
lag. For the periods from D up to 2 * D, D doubling from scale to scale, the words are cut into grams of D / 2
words and windows of D / 2 grams. A window in the first period of a run and the window one period later hold the
same words, so their least grams (minimizers) lie one period apart: pairs of equal minimizers at such a distance
seed the extension to both sides.

Grams that lie inside a run of a period of at most half their length are no minimizers. What is left occurs less
than nine times within 2 * D words, so pairs stay few in any text. Windows without a gram left lie inside one run of a
small period; a run all of whose first period lies in such a run R goes on into another run of the same
period that begins where R ends, and the lags at which these two agree are an arithmetic progression.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import WORD

#: Periods below are found by direct comparison; the first scale takes up from here.
SHORTEST = 16
#: Stretches of fewer words are no runs for the search.
LEAST = 8
#: Words searched together; texts with more are searched alone.
CHUNK = 400_000
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


class _Runs:
    """Runs found so far in an array of word numbers, by (start, end): the smallest period."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        """Periods come in rising order, except that multiples of a known one are left out here."""
        self.period.setdefault((start, end), period)

    def short_periods(self) -> None:
        words = self.words
        for lag in range(1, min(SHORTEST, len(words))):
            same = np.concatenate(([False], words[:-lag] == words[lag:], [False]))
            edges = np.flatnonzero(same[1:] != same[:-1])
            starts, ends = edges[::2], edges[1::2]
            long = ends - starts >= max(LEAST - lag, lag)
            for start, end in zip(starts[long].tolist(), ends[long].tolist()):
                self.add(start, end + lag, lag)

    def within(self, length: int, grams: int, half: int) -> np.ndarray:
        """Which of the first ``grams`` grams of ``length`` words lie inside a run of a period up to ``half``."""
        change = np.zeros(grams + 1, np.int32)
        for (start, end), period in self.period.items():
            if period <= half and end - start >= length and start < grams:
                change[start] += 1
                change[min(end - length + 1, grams)] -= 1
        return np.cumsum(change[:-1]) > 0

    def _agree(self, a: int, b: int, step: int, most: int) -> int:
        """How many words from ``a`` and ``b`` on agree one after the other, going by ``step`` (1 or -1)."""
        words, done, block = self.words, 0, 16
        while done < most:
            take = min(block, most - done)
            if step > 0:
                same = words[a + done : a + done + take] == words[b + done : b + done + take]
            else:
                same = words[a - done - take + 1 : a - done + 1] == words[b - done - take + 1 : b - done + 1]
                same = same[::-1]
            if not same.all():
                return done + int(same.argmin())
            done += take
            block *= 2
        return most

    def extend(self, seeds: list[tuple[int, int]]) -> None:
        """From each (lag, place), as far as words agree with those a lag later."""
        last, reached = 0, -1
        for lag, place in sorted(set(seeds)):
            if lag == last and place < reached:
                continue
            ahead = self._agree(place, place + lag, 1, len(self.words) - place - lag)
            behind = self._agree(place - 1, place + lag - 1, -1, place)
            last, reached = lag, place + ahead
            if ahead + behind >= lag:
                self.add(place - behind, place + lag + ahead, lag)

    def neighbours(self, low: int, high: int) -> list[tuple[int, int]]:
        """(lag, place) where a run agrees with the next run of the same period, for lags from ``low`` up."""
        words, seeds = self.words, []
        by_period: dict[int, list[tuple[int, int]]] = {}
        for (start, end), period in self.period.items():
            if period <= low // 4 and end - start >= low:
                by_period.setdefault(period, []).append((start, end))
        for period, spans in by_period.items():
            spans.sort()
            for (start, end), (begin, stop) in zip(spans, spans[1:]):
                if not end - period < begin <= end:
                    continue
                one, other = words[end - period : end], words[begin : begin + period]
                for turn in range(period):
                    if one[turn] == other[0] and (np.roll(one, -turn) == other).all():
                        first = low + (begin - end - turn - low) % period
                        most = min(high - 1, end - start, stop - begin)
                        seeds += [(lag, max(start, begin - lag)) for lag in range(first, most + 1, period)]
                        break
        return seeds

    def long_periods(self, lengths: np.ndarray) -> None:
        """All scales; texts stand in falling order of their ``lengths``, so that those which are long enough for a
        scale come first."""
        ends = np.cumsum(lengths + 1)
        gram, size, low = _mix(self.words.astype(np.uint64)), 1, SHORTEST
        while True:
            texts = int(np.searchsorted(-lengths, -2 * low, side="right"))
            if not texts:
                return
            length = low // 2
            while size < length:
                if len(gram) <= size:
                    return
                gram = _mix(gram[:-size] * np.uint64(3) + gram[size:])
                size *= 2
            cut = min(int(ends[texts - 1]), len(gram))
            self.extend(self._pairs(gram[:cut], low) + self.neighbours(low, 2 * low))
            low *= 2

    def _pairs(self, gram: np.ndarray, low: int) -> list[tuple[int, int]]:
        length = low // 2
        if len(gram) < length:
            return []
        least = (gram & ~np.uint64(0xFFFFFFFF)) | np.arange(len(gram), dtype=np.uint64)
        never = np.uint64(0xFFFFFFFFFFFFFFFF)
        least[self.within(length, len(gram), length // 2)] = never
        width = 1
        while width < length:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = least[least != never]
        if not len(least):
            return []
        places = np.unique((least & np.uint64(0xFFFFFFFF)).astype(np.int64))
        keys = gram[places]
        order = np.lexsort((places, keys))
        keys, places = keys[order], places[order]
        seeds = []
        for apart in range(1, 9):
            if apart >= len(keys):
                break
            lag = places[apart:] - places[:-apart]
            hit = (keys[apart:] == keys[:-apart]) & (lag >= low) & (lag < 2 * low)
            seeds += zip(lag[hit].tolist(), places[:-apart][hit].tolist())
        return seeds


def runs_of(texts: list[np.ndarray], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """For every array of word numbers its runs of ``least`` words or more: (start, length, period), in order."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(order):
        group, words = [], 0
        while at < len(order) and (not group or words + len(texts[order[at]]) < CHUNK):
            group.append(order[at])
            words += len(texts[order[at]]) + 1
            at += 1
        # A number of its own behind every text, so that no run crosses it.
        parts = [x for j, i in enumerate(group) for x in (texts[i], np.array([-1 - j]))]
        runs = _Runs(np.concatenate(parts))
        runs.short_periods()
        lengths = np.array([len(texts[i]) for i in group])
        runs.long_periods(lengths)
        begins = np.cumsum(lengths + 1) - lengths - 1
        spans = sorted((start, period, end) for (start, end), period in runs.period.items() if end - start >= least)
        owner = np.searchsorted(begins, [s for s, _, _ in spans], side="right") - 1
        for (start, period, end), j in zip(spans, owner.tolist()):
            found[group[j]].append((start - int(begins[j]), end - start, period))
    return found


def rotate(words: list[str], doc_id: int | None) -> list[str]:
    """The words of a text; for a tenth of the ids, a stretch up to the end repeats its first words."""
    seed = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    if seed % 10 or not words:
        return words
    draw, n = seed // 10, len(words)
    start = draw % n
    period = 1 + (n - start) // (3 + draw % 8)
    repeats = -(-(n - start) // period)
    return words[:start] + (words[start : start + period] * repeats)[: n - start]


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, least: int = 12, id_col="doc_id", text_col="text", seeded=False) -> DataFrame:
    """(doc_id, runs, collapsed) for every row: the runs of its words as an array of (start, length, period), by start
    and period, and the words that no run repeats, joined by one space.

    Words end at ASCII white space and are compared as they are. With ``seeded``, the words of a tenth of the ids
    first get a periodic end (``rotate``). A null or empty text has no words and no runs. Rows are independent
    of each other: repeated rows and ids stay as they are, a null id counts as the empty text in ``rotate``.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            parts = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // (8 * CHUNK)
            for part in np.unique(parts):
                at = np.flatnonzero(parts == part)
                yield block(ids[at[0] : at[-1] + 1], texts.slice(int(at[0]), len(at)).to_pylist())

    def block(ids: list, texts: list[str]) -> pa.RecordBatch:
        number: dict[str, int] = {}
        words = [WORD.findall(t) for t in texts]
        if seeded:
            words = [rotate(w, i) for w, i in zip(words, ids)]
        coded = [np.fromiter((number.setdefault(x, len(number)) for x in w), np.int64, len(w)) for w in words]
        found = runs_of(coded, least)
        spans = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in found]
        kept = [" ".join(collapse(w, r)) for w, r in zip(words, found)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.string())],
            ["doc_id", "runs", "collapsed"],
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(search, "doc_id long, runs array<struct<start long, length long, period long>>, collapsed string")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def digests(found: DataFrame) -> DataFrame:
    """One row per document: n_runs, its longest run (ties: smallest start, then period; null without one), the
    exponent in thousandths, and SHA-256 digests of all runs (``start,length,period`` lines) and of the kept words."""
    best = F.array_min(
        F.transform("runs", lambda r: F.struct((-r.length).alias("short"), r.start.alias("start"), r.period.alias("period")))
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.short")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.short") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


