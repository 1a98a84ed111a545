"""Repeated byte windows by a radix sort of suffixes that goes no deeper than the window.

A suffix is ordered by its first ``window`` bytes only, its key; suffixes with equal keys are the repeated windows. The sort
goes from the most significant digit to the least, and after every pass a suffix that is alone with its digits
so far is done: no other text has its key. So is one whose whole key has been seen to be equal to another's.

The digits are chosen so that neighbouring suffixes share them, and a row stands for a run of suffixes, not for one.
Each suffix has an anchor, the position with the least hash of 16 bytes among its first 128: suffixes with
equal keys have anchors at equal distances. Passes:

1. The digit of a run of suffixes with one anchor is what all their possible keys have in common, the bytes from the
   anchor to 128 bytes before the end of the window, behind it.
2. Suffixes that are left fall into blocks of 16 by their distance to the anchor; the digit is what the keys
   of a block have in common.
3. Suffixes that are left stand alone; the digit is the key.

Between the passes runs with equal bytes, from the first byte of the first key to the last byte of the last one, count as one with
its number of copies. Digits are compared by hashes of 64 bits; a suffix counts as repeated only if two such
hashes, independent of each other, agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import cut_lineage

#: Positions among which a suffix looks for its anchor, and bytes that are hashed for it.
SPREAD, GRAM = 128, 16
#: Suffixes in a block of the second pass.
BLOCK = 16
#: Suffixes that a task works on at once; longer texts are cut.
CHUNK = 1 << 20
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RUN = "k1 long, k2 long, anchor long, low long, high long, digit long, whole long, copies int"
_hash = xxhash.xxh3_64_intdigest


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ONE
    x = (x ^ (x >> np.uint64(27))) * _TWO
    return x ^ (x >> np.uint64(31))


def anchors(data: bytes, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, low, high) arrays: the suffixes low..high of a text have that anchor. Suffixes shorter than
    ``window`` have none. A run may be cut where a chunk ends."""
    count = len(data) - window + 1
    for begin in range(0, max(0, count), CHUNK):
        here = min(CHUNK, count - begin)
        piece = np.frombuffer(data, np.uint8, here + SPREAD + GRAM - 2, begin)
        eight = np.empty(len(piece) - 7, np.uint64)
        for shift in range(8):
            part = piece[shift : shift + (len(piece) - shift) // 8 * 8].view("<u8")
            eight[shift::8] = part[: len(eight[shift::8])]
        gram = _mix(eight[:-8] * _ONE + _mix(eight[8:]))
        places = np.uint64((1 << 21) - 1)
        least = (gram & ~places) | np.arange(len(gram), dtype=np.uint64)
        width = 1
        while width < SPREAD:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        at = (least[:here] & places).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        yield at[first] + begin, first + begin, np.append(first[1:], here) - 1 + begin


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _keys(text: Column, doc_id: Column) -> list[Column]:
    """Two hashes that tell (doc_id, text) pairs apart; rows that agree in both have the same result."""
    return [F.xxhash64(text, doc_id).alias("k1"), F.xxhash64(doc_id, F.lit(1), text).alias("k2")]


def first_pass(rows: DataFrame, window: int) -> DataFrame:
    """One row for each run of suffixes of a text (k1, k2, data) with the same anchor."""
    common = window - SPREAD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, texts = batch.columns
            held, size = [], 0
            for i in range(len(batch)):
                data = texts[i].as_py()
                for at, low, high in anchors(data, window):
                    a, b, c = at.tolist(), low.tolist(), high.tolist()
                    digit = [_hash(data[x : x + common]) for x in a]
                    whole = [_hash(data[y : z + window], x - y + 1) for x, y, z in zip(a, b, c)]
                    held.append((k1[i].as_py(), k2[i].as_py(), at, low, high, digit, whole))
                    size += len(a)
                    if size > 200_000:
                        yield pack(held)
                        held, size = [], 0
            yield pack(held)

    def pack(held) -> pa.RecordBatch:
        many = [len(h[2]) for h in held]
        columns = [pa.array(np.repeat(np.array([h[j] for h in held], np.int64), many)) for j in (0, 1)]
        for j in (2, 3, 4):
            columns.append(pa.array(np.concatenate([np.empty(0, np.int64), *(h[j] for h in held)])))
        for j in (5, 6):
            columns.append(_signed([x for h in held for x in h[j]]))
        columns.append(pa.array(np.ones(sum(many), np.int32)))
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RUN.split(", ")])

    return rows.mapInArrow(run, _RUN)


def next_pass(rows: DataFrame, left: DataFrame, window: int, block: int) -> DataFrame:
    """The runs ``left`` in blocks of ``block`` suffixes by their distance to the anchor, with their digits."""
    wanted = left.groupBy("k1", "k2").agg(
        F.sort_array(F.collect_set(F.struct("anchor", "low", "high", "copies"))).alias("runs")
    )
    common = window - block + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, texts, runs = batch.columns
            out: list[tuple] = []
            for i in range(len(batch)):
                data, a, b = texts[i].as_py(), k1[i].as_py(), k2[i].as_py()
                for r in runs[i].as_py():
                    at, high = r["anchor"], r["high"]
                    while high >= r["low"]:
                        # Suffixes at distances of number * block and more, up to the next block's.
                        number = (at - high) // block
                        low = max(r["low"], at - number * block - block + 1)
                        start = at - number * block
                        digit = _hash(data[start : start + common], number + 1)
                        whole = _hash(data[low : high + window], (at - low + 1) << 20 | number)
                        out.append((a, b, at, low, high, digit, whole, r["copies"]))
                        high = low - 1
                if len(out) > 200_000:
                    yield pack(out)
                    out = []
            yield pack(out)

    def pack(out: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in _RUN.split(", ")]
        columns = [pa.array([r[j] for r in out], pa.int64()) for j in range(5)]
        columns += [_signed([r[j] for r in out]) for j in (5, 6)] + [pa.array([r[7] for r in out], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names)

    joined = rows.join(wanted, ["k1", "k2"]).select("k1", "k2", "data", "runs")
    return joined.mapInArrow(run, _RUN)


def settle(spark: SparkSession, runs: DataFrame, name: str, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """One radix pass over ``runs``: (k1, k2, low, high) of those that are repeated for certain, and what goes
    into the next pass, one run for all with the same bytes. After the ``last`` pass a digit is a whole key."""
    # Copies of a run shrink to one row before the shuffle; two are as good as many.
    alike = runs.groupBy("digit", "whole").agg(F.sum("copies").alias("copies"))
    groups = alike.groupBy("digit").agg(
        F.sum("copies").alias("all"), F.min("whole").alias("one"), F.max("whole").alias("other")
    )
    met = cut_lineage(spark, groups.filter("all > 1"), f"{name}-digits")
    if last:
        found = runs.join(met.filter("one = other").select("digit"), "digit", "left_semi")
        return found.filter("copies = 1").select("k1", "k2", "low", "high"), None
    found = cut_lineage(spark, runs.join(met, "digit"), f"{name}-runs")
    sure = found.filter("one = other")
    mixed = found.filter("one <> other")
    classes = mixed.groupBy("digit", "whole").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("k1", "k2", "anchor", "low", "high")).alias("run")
    )
    classes = cut_lineage(spark, classes, f"{name}-classes")
    more = mixed.join(classes.filter("copies > 1").select("digit", "whole"), ["digit", "whole"], "left_semi")
    both = sure.select("k1", "k2", "low", "high", "copies").unionByName(more.select("k1", "k2", "low", "high", "copies"))
    left = classes.select("run.*", F.least("copies", F.lit(2)).cast("int").alias("copies"))
    return both.filter("copies = 1").select("k1", "k2", "low", "high"), left


def repeated_suffixes(spark: SparkSession, rows: DataFrame, window: int = 400) -> DataFrame:
    """(k1, k2, low, high): runs of positions of a text at which a repeated window begins. ``rows`` holds the
    bytes ``data`` of each text under its key (k1, k2)."""
    runs = cut_lineage(spark, first_pass(rows, window), "suffixes")
    found, left = settle(spark, runs, "first", False)
    parts = [found]
    for block, name in ((BLOCK, "second"), (1, "third")):
        left = cut_lineage(spark, left, f"{name}-left")
        if left.isEmpty():
            break
        if block == BLOCK and not rows.groupBy("k1", "k2").count().filter("count > 1").isEmpty():
            rows = rows.dropDuplicates(["k1", "k2"])  # equal rows have been counted as copies
        runs = cut_lineage(spark, next_pass(rows, left, window, block), f"{name}-suffixes")
        found, left = settle(spark, runs, name, block == 1)
        parts.append(found)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def remove_repeats(
    spark: SparkSession, docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, data, kept, spans) for every row: the text's bytes, those that no repeated window covers, and the
    covered spans as an array of (start, end).

    A window is any ``window`` bytes of a text in UTF-8; it is repeated if its bytes also start anywhere else, in
    any row, its own included. Null counts as empty; texts shorter than the window keep all bytes. Equal rows are
    copies of each other and lose all windows, also under one id; a null id is an id like others. No other
    column is looked at. ``window`` is at least 160.
    """
    if window < SPREAD + 2 * GRAM:
        raise ValueError(f"windows have at least {SPREAD + 2 * GRAM} bytes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("data"))
    rows = rows.select("doc_id", "data", *_keys(F.col("data"), F.col("doc_id")))
    found = repeated_suffixes(spark, rows.select("k1", "k2", "data"), window)
    spans = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("runs"))
    joined = rows.join(cut_lineage(spark, spans, "spans"), ["k1", "k2"], "left").select("doc_id", "data", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, runs = batch.columns
            kept, spans = [], []
            for data, starts in zip(texts, runs):
                data, covered = data.as_py(), []
                for r in sorted((r["low"], r["high"]) for r in starts.as_py() or ()):
                    if covered and r[0] <= covered[-1][1]:
                        covered[-1][1] = max(covered[-1][1], r[1] + window)
                    else:
                        covered.append([r[0], r[1] + window])
                edges = [0, *(x for s in covered for x in s), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if covered else data)
                spans.append([{"start": a, "end": b} for a, b in covered])
            columns = [ids, texts, pa.array(kept, pa.binary()), pa.array(spans, _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "data", "kept", "spans"])

    return joined.mapInArrow(cut, "doc_id long, data binary, kept binary, spans array<struct<start long, end long>>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def digests(removed: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``remove_repeats``."""
    return removed.select(
        "doc_id",
        F.length("data").cast("long").alias("n_bytes"),
        (F.length("data") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
