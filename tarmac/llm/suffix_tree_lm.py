"""Language-model scores from a probabilistic suffix tree.

Tokens are words and the end of a document. The tree's contexts are suffixes of variable length of what
stands before a token: the last letters, back over the beginning of a short word into the words before it. Its
symbols, called classes, are the words themselves. A context stays in the tree if it was seen often enough and its
next-symbol distribution diverges from that of the context one letter shorter by more than chance explains;
distributions are smoothed towards that shorter context. A token is scored in the state of the longest suffix that
the tree holds. Words unseen in training count as one symbol, as in the unigram base, with the probability mass that
the words seen once suggest.

All counts are taken over all training documents, and all bounds are absolute counts, so the tree grows with the
corpus. None of it is collected or broadcast: words are dealt into buckets by a hash, and a bucket holds all pairs
(context, class) of its words. Blocks of texts send a bucket their counts of its words as one row of packed arrays and
get the counts of all texts back in the same order; contexts are tables joined by their letters.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import words_of
from tarmac.session import cut_lineage, settings

#: White space, which no word holds: the beginning of a document, of a word, and the class of a document's end.
START, BEGIN, END = "\n", " ", "$ "
#: Between packed names; no word or context holds it.
_BETWEEN = "\r"
#: Pairs that are packed as one block where they come as rows, and for which a bucket is meant.
_PAIRS = 1_000_000
#: Texts wait beside the block that a task is working on.
_FEW_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
_SENT = "what string, block long, bucket int, data binary, names array<string>"
_MET = "what string, block long, bucket int, data binary, context string, mass long, kinds long, rare long"


def class_of(word: str) -> str:
    """The symbol of a word: every word is one of its own, so the tree tells apart whatever the corpus does."""
    return word


def numbering() -> defaultdict:
    """Numbers keys in the order in which they are first asked for."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def numbered(words: list[str], numbers: defaultdict) -> np.ndarray:
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def _bytes_of(numbers: np.ndarray) -> bytes:
    """Whole numbers byte by byte, as their upper bytes are alike, behind the number of bytes in each."""
    small = not len(numbers) or 0 <= numbers.min() and numbers.max() < 1 << 31
    width = 4 if small else 8
    return bytes([width]) + np.asarray(numbers, f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def squeezed(*parts: list[str] | np.ndarray) -> bytes:
    """Lists of names and arrays of whole numbers, compressed."""
    raw = [_BETWEEN.join(p).encode() if isinstance(p, list) else _bytes_of(p) for p in parts]
    body = b"".join([np.array([len(raw), *map(len, raw)], "<i8").tobytes(), *raw])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def expanded(data: bytes) -> list[bytes]:
    body = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    count = int.from_bytes(body[:8], "little")
    edges = np.cumsum([8 + 8 * count, *np.frombuffer(body, "<i8", count, 8)]).tolist()
    return [body[a:b] for a, b in zip(edges, edges[1:])]


def _ints(part: bytes) -> np.ndarray:
    width = part[0]
    return np.frombuffer(part, np.uint8, offset=1).reshape(width, -1).T.copy().view(f"<i{width}").ravel().astype(np.int64)


def _names(part: bytes) -> list[str]:
    return part.decode().split(_BETWEEN) if part else []


def _classes_in_order(names: list[str], buckets: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The classes sorted by bucket and name, the bucket of each, and the place of each of ``names``."""
    order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
    bucket = np.array([zlib.crc32(names[i].encode()) % buckets for i in order.tolist()], np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    order = order[by_bucket]
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return [names[i] for i in order.tolist()], bucket[by_bucket], place


def _contexts_in_order(names: list[str]) -> tuple[list[str], np.ndarray]:
    """The contexts sorted from their last letter back, so that those with a common suffix stand together, and the
    place of each of ``names``."""
    order = sorted(range(len(names)), key=[x[::-1] for x in names].__getitem__)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    return [names[i] for i in order], place


@dataclass
class Spelled:
    """A block's texts as numbers, one after the other, each with its end as a last token: distinct (class, context)
    pairs in order, as numbers of classes times numbers of contexts, and the pair of each token; the tokens of each
    text. ``bucket`` is that of each class."""

    contexts: list[str]
    classes: list[str]
    bucket: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    lengths: np.ndarray


def spell(texts, depth: int, buckets: int = 1) -> Spelled:
    numbers = numbering()
    split = [numbered(words_of(x), numbers) for x in texts]
    words = list(numbers)
    classes, bucket, place = _classes_in_order([*map(class_of, words), END], buckets)

    tails, spelled = numbering(), [START]
    tails[START]

    def tail(before: str, word: str) -> int:
        name = (before + BEGIN + word)[-depth:]
        at = tails[name]
        if at == len(spelled):
            spelled.append(name)
        return at

    lengths = np.array([len(x) for x in split], np.int64)
    flat = np.concatenate([np.empty(0, np.int32), *split])
    del split
    at = np.arange(len(flat)) + np.repeat(np.arange(len(lengths)), lengths)
    word = np.full(len(flat) + len(lengths), len(words), np.int32)
    word[at] = flat
    # What a long word leaves behind is the same everywhere; short ones show the words before them.
    alone = np.array([tail("", w) if len(w) + 1 >= depth else -1 for w in words], np.int32)
    before = np.zeros(len(word), np.int32)
    before[at + 1] = alone[flat]
    del at, flat
    for i in (np.flatnonzero(before < 0)).tolist():
        before[i] = tail(spelled[before[i - 1]], words[word[i - 1]])
    contexts, context_place = _contexts_in_order(spelled)
    keys = place[word] * len(contexts) + context_place[before]
    del word, before
    order = np.argsort(keys)
    keys = keys[order]
    new = np.diff(keys, prepend=-1) != 0
    pair = np.empty(len(keys), np.int32)
    pair[order] = np.cumsum(new, dtype=np.int32) - 1
    return Spelled(contexts, classes, bucket, keys[new], pair, lengths + 1)


def _sent(
    block: int, contexts: list[str], classes: list[str], bucket: np.ndarray, pairs: np.ndarray, n: np.ndarray,
    depth: int, *tokens: np.ndarray,
) -> pa.RecordBatch:
    """The rows of a block: its pairs and their counts for each bucket, and one of its own with the context of each
    pair, the names of contexts and ``tokens``; this one also names all suffixes of the contexts."""
    symbol, context = np.divmod(pairs, len(contexts))
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
    rows = []
    for low, high in zip(edges, edges[1:]):
        a, b = np.searchsorted(symbol, [low, high])
        kinds = np.bincount(symbol[a:b] - low, minlength=high - low)
        here = [contexts[i] for i in context[a:b].tolist()]
        rows.append(("pairs", block, int(bucket[low]), squeezed(classes[low:high], kinds, here, n[a:b]), None))
    suffixes = sorted({x[-d:] for x in contexts for d in range(1, depth + 1)})
    rows.append(("tokens", block, -1, squeezed(contexts, context, *tokens), suffixes))
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.string())]
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SENT.split(", ")])


def _block_number(count: int) -> int:
    return TaskContext.get().partitionId() << 32 | count


def spelled_blocks(rows: DataFrame, depth: int, buckets: int, block_chars: int) -> DataFrame:
    """What blocks of about ``block_chars`` letters of (doc_id, text, train) send, where the texts lie."""

    def send(block: int, held: list[tuple]) -> pa.RecordBatch:
        ids, texts, train = zip(*held)
        spelled = spell(texts, depth, buckets)
        seen = np.repeat(np.array([bool(x) for x in train]), spelled.lengths)
        n = np.bincount(spelled.pair[seen], minlength=len(spelled.pairs))
        known = np.array([i is not None for i in ids])
        numbers = np.array([i or 0 for i in ids], np.int64)
        return _sent(
            block, spelled.contexts, spelled.classes, spelled.bucket, spelled.pairs, n, depth,
            numbers, known, spelled.lengths, spelled.pair,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters, count = [], 0, 0
        for batch in batches:
            for i in range(len(batch)):
                held.append(tuple(c[i].as_py() for c in batch.columns))
                letters += len(held[-1][1])
                if letters >= block_chars:
                    yield send(_block_number(count), held)
                    held, letters, count = [], 0, count + 1
        if held:
            yield send(_block_number(count), held)

    return rows.select("doc_id", "text", "train").mapInArrow(run, _SENT)


def packed_pairs(pairs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """What blocks of rows (context, class, n) send."""

    def send(block: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        names, of = _distinct(table.column(0).to_pylist())
        contexts, context_place = _contexts_in_order(names)
        names, symbols = _distinct(table.column(1).to_pylist())
        classes, bucket, place = _classes_in_order(names, buckets)
        found, at = np.unique(place[symbols] * len(contexts) + context_place[of], return_inverse=True)
        n = np.bincount(at, weights=table.column(2).to_numpy()).astype(np.int64)
        return _sent(block, contexts, classes, bucket, found, n, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, count = [], 0, 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size >= _PAIRS:
                yield send(_block_number(count), held)
                held, size, count = [], 0, count + 1
        if held:
            yield send(_block_number(count), held)

    return pairs.select("context", "class", F.col("n").cast("long")).mapInArrow(run, _SENT)


def flat_pairs(sent: DataFrame) -> DataFrame:
    """(block, at, context, class, n) of the pairs that blocks send, numbered from -1 down in a block and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, kinds, contexts, n = expanded(data)
                contexts, n = _names(contexts), _ints(n)
                classes = np.repeat(np.array(_names(names), object), _ints(kinds))
                columns = [np.full(len(n), block), -1 - np.arange(len(n), dtype=np.int32), contexts, classes, n]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["block", "at", "context", "class", "n"])

    sent = sent.filter("what = 'pairs'").select("block", "data")
    return sent.mapInArrow(run, "block long, at int, context string, class string, n long")


def block_counts(rows: DataFrame, depth: int, block_chars: int = 12_000_000) -> DataFrame:
    """(block, at, context, class, n): the distinct pairs of every block, each with its count in training rows. Every
    token is one of a pair, so the counts of words are sums of these."""
    return flat_pairs(spelled_blocks(rows, depth, 1, block_chars))


def _distinct(names: list[str]) -> tuple[list[str], np.ndarray]:
    coded = pa.array(names, pa.string()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _levels(symbol: np.ndarray, context: np.ndarray, contexts: list[str], n: np.ndarray, depth: int):
    """For each length of suffix: the suffixes, that of each pair (-1: its context is shorter), where the pairs with a
    class and suffix in common begin, the number of this group for each pair, and the count of each group. Pairs stand in
    order of classes, and their contexts in order from the last letter back."""
    for d in range(1, depth + 1):
        numbers = numbering()
        suffix = np.array([numbers[x[-d:]] if len(x) >= d else -1 for x in contexts], np.int64)[context]
        # A context that is too short is a group of its own: it stands before the longer ones that end like it.
        new = (np.diff(symbol, prepend=-1) != 0) | (np.diff(suffix, prepend=-2) != 0)
        begins = np.flatnonzero(new)
        yield list(numbers), suffix, begins, np.cumsum(new) - 1, np.add.reduceat(n, begins)


def meet(sent: DataFrame, depth: int, min_pair: int, buckets: int) -> DataFrame:
    """What buckets make of the pairs sent to them: "figures" for the block of each row, the count of each of its classes
    and, for each of its pairs, that of the class after every suffix of the context; "merged" pairs of the bucket, those
    that may be seen ``min_pair`` times after some suffix; and rows of "context" with their mass, kinds and rare
    observations in this bucket. The empty context has the tokens, classes and words seen once."""
    least = max(min_pair, 1)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = group["bucket"].iloc[0]
        parts = [expanded(x) for x in group["data"]]
        names = [_names(p[0]) for p in parts]
        kinds = [_ints(p[1]) for p in parts]
        contexts, context = _distinct([x for p in parts for x in _names(p[2])])
        contexts, place = _contexts_in_order(contexts)
        classes, symbol = _distinct([x for ns in names for x in ns])
        keys = np.repeat(symbol, np.concatenate(kinds)) * len(contexts) + place[context]
        pairs, at = np.unique(keys, return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, at, np.concatenate([_ints(p[3]) for p in parts]))
        of, context = np.divmod(pairs, len(contexts))
        size = np.zeros(len(classes), np.int64)
        np.add.at(size, of, n)

        once = int((size == 1).sum()) - (END in classes and int(size[classes.index(END)]) == 1)
        rows = [("context", None, bucket, None, "", int(size.sum()), int((size > 0).sum()), once)]
        counts, may = [], n > 0
        for suffixes, suffix, begins, of_pair, count in _levels(of, context, contexts, n, depth):
            after, count = suffix[begins], np.where(suffix[begins] < 0, 0, count)
            counts.append(count[of_pair])
            kept, rare = count >= least, (count < least) & (after >= 0)
            if len(counts) == 1:
                may &= kept[of_pair]
            found = np.zeros((3, len(suffixes)), np.int64)
            np.add.at(found[0], after[kept], count[kept])
            np.add.at(found[1], after[kept], 1)
            np.add.at(found[2], after[rare], count[rare])
            used = found.any(axis=0).tolist()
            rows += [("context", None, bucket, None, s, *f) for s, f, u in zip(suffixes, found.T.tolist(), used) if u]

        a, b = 0, 0
        for block, k in zip(group["block"], kinds):
            c, d = a + len(k), b + int(k.sum())
            data = squeezed(size[symbol[a:c]], k, *(x[at[b:d]] for x in counts))
            rows.append(("figures", block, bucket, data, None, 0, 0, 0))
            a, b = c, d
        used, of = np.unique(of[may], return_inverse=True)
        data = squeezed(contexts, size[used], np.bincount(of, minlength=len(used)), context[may], n[may])
        rows.append(("merged", None, bucket, data, None, 0, 0, 0))
        frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _MET.split(", ")])
        return frame.astype({"block": "Int64"})

    pairs = sent.filter("what = 'pairs'").select("block", "bucket", "data")
    return pairs.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(run, _MET)


def _gains(met: DataFrame, contexts: DataFrame, total: int, depth: int, min_pair: int, buckets: int) -> DataFrame:
    """(context, gain): the divergence of each of ``contexts`` from the next shorter one, by bucket."""
    least = max(min_pair, 1)

    def run(merged: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names, gains = [], []
        masses = dict(zip(known["context"], zip(known["mass"], known["pull"])))
        for data in merged["data"]:
            contexts, size, kinds, context, n = expanded(data)
            contexts, context, n, kinds = _names(contexts), _ints(context), _ints(n), _ints(kinds)
            if not len(n):
                continue
            of = np.repeat(np.arange(len(kinds)), kinds)
            p = _ints(size)[of] / total
            for suffixes, suffix, begins, of_pair, count in _levels(of, context, contexts, n, depth):
                mass, pull = np.array([masses.get(x, (0, 0.0)) for x in suffixes] + [(0, 0.0)], float).T
                after, base = suffix[begins], p[begins]
                kept = (count >= least) & (after >= 0) & (mass[after] > 0)
                count, after, base = count[kept], after[kept], base[kept]
                share = count / mass[after]
                gain = np.bincount(after, share * np.log(share / base), len(suffixes))
                met = np.bincount(after, minlength=len(suffixes)) > 0
                names += [x for x, y in zip(suffixes, met.tolist()) if y]
                gains += gain[met].tolist()
                smooth = np.zeros(len(begins))
                smooth[kept] = (count + pull[after] * base) / (mass[after] + pull[after])
                p = smooth[of_pair]
        return pd.DataFrame({"context": np.array(names, object), "gain": np.array(gains, float)})

    merged = met.filter("what = 'merged'").select("bucket", "data").repartition(buckets, "bucket")
    here = met.filter("what = 'context' AND context <> ''").select(F.col("bucket").alias("place"), "context")
    here = here.join(contexts.select("context", "mass", "pull"), "context").repartition(buckets, "place")
    return merged.groupBy("bucket").cogroup(here.groupBy("place")).applyInPandas(run, "context string, gain double")


def chances_of(
    size: np.ndarray, counts: list[np.ndarray], context: np.ndarray, contexts: list[str], states: pd.DataFrame,
    total: int, min_pair: int,
) -> np.ndarray:
    """The probability of the class of each pair in the longest state of its context, from the count of the class alone
    and after each longer suffix."""
    known = dict(zip(states["context"], zip(states["mass"], states["pull"])))
    p = size / max(total, 1)
    for d, n in enumerate(counts, 1):
        found = [known.get(x[-d:], (0, 0.0)) if len(x) >= d else (0, 0.0) for x in contexts]
        mass, pull = np.array(found, float).reshape(-1, 2)[context].T
        whole = np.where(mass > 0, mass + pull, 1.0)
        own = np.where(n >= max(min_pair, 1), n + pull * p, pull * p) / whole
        p = np.where(mass > 0, own, p)
    return p


@dataclass
class Tree:
    """``met``: what the buckets of words made of the pairs; ``states`` by depth: (context, mass, pull, fall), where
    ``fall`` is the weight of the shorter context's distribution; the tokens, classes and words seen once."""

    sent: DataFrame
    met: DataFrame
    states: list[DataFrame]
    state: DataFrame
    depth: int
    buckets: int
    min_pair: int
    tokens: int
    distinct: int
    once: int

    @property
    def classes(self) -> DataFrame:
        """(class, size, p) of the classes seen in training."""
        sizes = flat_pairs(self.sent).groupBy("class").agg(F.sum("n").alias("size")).filter("size > 0")
        return sizes.withColumn("p", F.col("size") / self.tokens)

    def states_of(self, sent: DataFrame) -> DataFrame:
        """(place, context, mass, pull): the states that may stand before the tokens of the block ``place``."""
        names = sent.filter("what = 'tokens'").select(F.col("block").alias("place"), F.explode("names").alias("context"))
        return names.join(self.state.select("context", "mass", "pull"), "context")

    def chances(self, pairs: DataFrame) -> DataFrame:
        """(context, class, size, chance): the log10 probability of each class in the state of the longest suffix of
        the context that the tree holds. Classes unseen in training have no size and no chance."""
        total, min_pair = self.tokens, self.min_pair
        asked = packed_pairs(pairs.withColumn("n", F.lit(0)), self.depth, self.buckets)
        asked = cut_lineage(pairs.sparkSession, asked.withColumn("block", -1 - F.col("block")), "asked")
        met = meet(self.sent.unionByName(asked), self.depth, min_pair, self.buckets)
        rows = asked.select("what", "block", "bucket", "data")
        rows = rows.unionByName(met.filter("what = 'figures' AND block < 0").select("what", "block", "bucket", "data"))

        def run(rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
            contexts, context = expanded(rows["data"][rows["what"] == "tokens"].iloc[0])
            contexts, context = _names(contexts), _ints(context)
            size, counts = _figures(rows)
            pairs = [expanded(x) for x in rows[rows["what"] == "pairs"].sort_values("bucket")["data"]]
            classes = [np.repeat(np.array(_names(p[0]), object), _ints(p[1])) for p in pairs]
            p = chances_of(size, counts, context, contexts, states, total, min_pair)
            unseen = size == 0
            return pd.DataFrame({
                "context": np.array(contexts, object)[context], "class": np.concatenate(classes),
                "size": pd.arrays.IntegerArray(size, unseen), "chance": np.log10(np.where(unseen, np.nan, p)),
            })

        schema = "context string, class string, size long, chance double"
        return rows.groupBy("block").cogroup(self.states_of(asked).groupBy("place")).applyInPandas(run, schema)


def _figures(rows: pd.DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """The count of the class of each pair of a block, and those after each longer suffix."""
    rows = rows[rows["what"] == "figures"].sort_values("bucket")
    parts = [[_ints(p) for p in expanded(data)] for data in rows["data"]]
    size = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
    return size, [np.concatenate(level) for level in zip(*(p[2:] for p in parts))]


def grow(spark: SparkSession, pairs: DataFrame, depth: int = 3, **options) -> Tree:
    """Grow the tree from rows (context, class, n), which may come in parts; ``options`` as in ``grow_sent``."""
    buckets = max(1, -(-pairs.count() // _PAIRS))
    return grow_sent(spark, cut_lineage(spark, packed_pairs(pairs, depth, buckets), "pairs"), depth, buckets, **options)


def grow_sent(
    spark: SparkSession,
    sent: DataFrame,
    depth: int,
    buckets: int,
    min_count: int = 16,
    min_pair: int = 2,
    divergence: float = 0.02,
    pull: float = 20.0,
    spread: float = 0.0,
) -> Tree:
    """Grow the tree from what blocks send to ``buckets`` buckets.

    Pairs need ``min_pair`` and contexts ``min_count`` observations, whatever the size of the corpus. A context is
    a state if the Kullback-Leibler divergence of its classes from the next shorter context, less what chance gives
    that many classes, is ``divergence`` nats, or if a longer state ends with it. ``pull`` is the number of
    observations that the shorter context's distribution counts for. With ``spread`` it counts for more where much is
    still unseen: by ``spread`` for every class of the context, and by one for every observation of a pair below
    ``min_pair``. Symbols are many, so a pull that is the same everywhere leaves too little for unseen pairs.
    """
    met = cut_lineage(spark, meet(sent, depth, min_pair, buckets), "met")
    sums = [F.sum(c).alias(c) for c in ("mass", "kinds", "rare")]
    contexts = cut_lineage(spark, met.filter("what = 'context'").groupBy("context").agg(*sums), "contexts")
    tokens, distinct, once = (contexts.filter("context = ''").select("mass", "kinds", "rare").first() or (0, 0, 0))
    pulled = pull + spread * F.col("kinds") + F.col("rare") if spread else F.lit(float(pull))
    contexts = contexts.filter((F.col("context") != "") & (F.col("kinds") > 0) & (F.col("mass") >= min_count))
    contexts = contexts.withColumn("pull", pulled.cast("double"))
    gains = _gains(met, contexts, tokens, depth, min_pair, buckets).groupBy("context").agg(F.sum("gain").alias("gain"))
    enough = F.col("gain") - (F.col("kinds") - 1) / (2 * F.col("mass")) >= divergence
    ends = contexts.join(gains, "context").filter(enough)
    suffixes = F.transform(F.sequence(F.lit(1), F.length("context")), lambda d: F.right("context", d))
    ends = ends.select(F.explode(suffixes).alias("context")).distinct()
    fall = (F.col("pull") / (F.col("mass") + F.col("pull"))).alias("fall")
    state = contexts.join(ends, "context", "left_semi").select("context", "mass", "pull", fall)
    state = cut_lineage(spark, state, "states")
    states = [state.filter(F.length("context") == d) for d in range(1, depth + 1)]
    return Tree(sent, met, states, state, depth, buckets, min_pair, tokens, distinct, once)


def score(
    spark: SparkSession,
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = 12_000_000,
    depth: int = 3,
    **tree_options,
) -> DataFrame:
    """Score every document with the model learned from the rows where ``train`` holds.

    Returns, for every row: doc_id, n_tokens (words and the end), n_known (tokens seen in training),
    train_tokens, base_score (sum of the tokens' log10 unigram probabilities with 0.1 added to each
    count) and score (log10 probability of the tokens under the suffix tree). Null and empty texts have the
    end only. Without training rows all tokens are unknown and certain: both scores are 0. Repeated rows and
    ids stay as they are; an empty table gives no rows.

    A task takes its documents in blocks of about ``block_chars`` letters where they lie and writes each once, as the
    numbers of its tokens' pairs. Texts are never shuffled. Each block sends its distinct pairs to the buckets of
    their words and gets counts back, so neither the words nor the tree are ever broadcast.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), train.alias("train")
    )
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-letters // block_chars))
    with settings(spark, **_FEW_TEXTS):
        sent = cut_lineage(spark, spelled_blocks(rows, depth, buckets, block_chars), "blocks")
    tree = grow_sent(spark, sent, depth, buckets, **tree_options)
    tokens, once, min_pair = tree.tokens, tree.once, tree.min_pair
    scale = float(np.log10(tokens + 0.1 * (tree.distinct + 1)))
    unknown = min(0.5, max(once, 0.5) / tokens) if tokens else 1.0

    def total(rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        data = expanded(rows["data"][rows["what"] == "tokens"].iloc[0])
        contexts, (context, ids, has_id, lengths, pair) = _names(data[0]), map(_ints, data[1:])
        count, counts = _figures(rows)
        chance = chances_of(count, counts, context, contexts, states, tokens, min_pair)
        known = count > 0
        chance = np.log10(np.where(known, chance, 1)) + np.log10(1 - unknown if unknown < 1 else 1)
        said = np.where(known, chance, np.log10(unknown))
        base = np.log10(count + 0.1) - scale
        begins = np.append(0, np.cumsum(lengths))[:-1]
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(ids, has_id == 0),
            "n_tokens": lengths,
            "n_known": np.add.reduceat(known[pair].astype(np.int64), begins),
            "train_tokens": tokens,
            "base_score": np.add.reduceat(base[pair], begins),
            "score": np.add.reduceat(said[pair], begins),
        })

    columns = ["what", "block", "bucket", "data"]
    rows = sent.filter("what = 'tokens'").select(columns)
    rows = rows.unionByName(tree.met.filter("what = 'figures'").select(columns))
    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    states = tree.states_of(sent).repartition(buckets, "place")
    return rows.repartition(buckets, "block").groupBy("block").cogroup(states.groupBy("place")).applyInPandas(total, schema)
