"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of signs. The vector of a trigram binds its letters: the sign vectors,
rotated by their place, are multiplied. A text is the bundle (sum) of its trigram vectors, a language the bundle
of its documents, scaled to length one each. The language with the largest cosine wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import bounded_sample, texts, trimmed

UNKNOWN = "und"
#: Documents whose counts are held in memory at once, in code points.
BLOCK = 500_000
#: Trigram vectors held in memory at once; a text with more different ones is bundled slice by slice.
SLICE = 4096
#: Letter vectors kept between texts, one byte a sign.
LETTERS = 65_536
_LETTER: list[np.ndarray] = []
_VECTORS: dict[tuple[int, int], np.ndarray] = {}


def is_letter() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def letter_vector(point: int, size: int) -> np.ndarray:
    key = (point, size)
    if key not in _VECTORS:
        if len(_VECTORS) >= LETTERS:
            _VECTORS.clear()
        signs = np.random.default_rng([size, point]).integers(0, 2, size, dtype=np.int8)
        _VECTORS[key] = signs * np.int8(2) - np.int8(1)
    return _VECTORS[key]


def trigram_vectors(packed: np.ndarray, size: int) -> np.ndarray:
    """One bound vector for each packed trigram (21 bits a letter, 0 for the space between words)."""
    out = np.ones((len(packed), size), np.float32)
    for place, shift in enumerate((42, 21, 0)):
        points, index = np.unique((packed >> shift) & 0x1FFFFF, return_inverse=True)
        out *= np.roll(np.stack([letter_vector(int(p), size) for p in points]), 2 - place, axis=1)[index]
    return out


def trigrams(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, packed trigram) of all trigrams of lower-cased letters, words set apart by one space."""
    letter = is_letter()
    rows, packed = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for row, text in enumerate(batch):
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        points = np.where(letter[points], points, 0)
        points = np.concatenate(([0], points, [0]))
        points = points[np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0)))]
        if len(points) >= 3:
            grams = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
            packed.append(grams)
            rows.append(np.full(len(grams), row))
    return np.concatenate(rows), np.concatenate(packed)


def bundles(batch: list[str], size: int) -> np.ndarray:
    """The vector of every text, scaled to length one; zero for a text without letters."""
    out = np.zeros((len(batch), size), np.float32)
    rows, packed = trigrams(batch)
    if not len(rows):
        return out
    grams, index = np.unique(packed, return_inverse=True)
    # How often each (slice, row, trigram) occurs, in that order; memory follows the letters, not the vectors.
    pairs, count = np.unique((index // SLICE * len(batch) + rows) * SLICE + index % SLICE, return_counts=True)
    group, place = pairs // SLICE, pairs % SLICE
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    part, vectors = -1, np.empty((0, size), np.float32)
    for begin, end in zip(begins, np.append(begins[1:], len(group))):
        slice_, row = divmod(int(group[begin]), len(batch))
        if slice_ != part:
            part, vectors = slice_, trigram_vectors(grams[slice_ * SLICE : (slice_ + 1) * SLICE], size)
        out[row] += count[begin:end].astype(np.float32) @ vectors[place[begin:end]]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def _blocks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    points = batch["text"].str.len().cumsum()
    for _, block in batch.groupby((points // BLOCK).to_numpy(), sort=False):
        yield block


def learn(labelled: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", size=512, per_language=3000):
    """Language prototypes {lang: unit vector} from at most about ``per_language`` documents a language.

    Which documents is decided by a hash of the id, over all rows. Null languages and texts without letters
    do not count. Only one vector a language reaches the driver.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = bounded_sample(rows, lang_col, id_col, per_language)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    @trimmed
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for block in _blocks(batch):
                vectors = bundles(block["text"].tolist(), size).astype(np.float64)
                for lang, at in block.groupby("lang").indices.items():
                    sums[lang] = sums.get(lang, 0) + vectors[at].sum(axis=0)
        found = [(lang, i, float(x)) for lang, v in sums.items() for i, x in enumerate(v)]
        yield pd.DataFrame(found, columns=["lang", "i", "x"])

    sums = rows.mapInPandas(add, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x"))
    prototypes: dict[str, np.ndarray] = {}
    for lang, i, x in sums.collect():
        prototypes.setdefault(lang, np.zeros(size))[i] = x
    return {k: v / np.linalg.norm(v) for k, v in sorted(prototypes.items()) if np.linalg.norm(v) > 0}


def known_trigrams(
    labelled: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_language=3000, min_docs=3
) -> np.ndarray:
    """The packed trigrams in ``min_docs`` or more different texts of the documents that ``learn`` samples, sorted."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = bounded_sample(rows, lang_col, id_col, per_language).select(F.col(text_col).alias("text")).distinct()

    @trimmed
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in _blocks(batch):
                found, packed = trigrams(block["text"].tolist())
                pairs = np.unique(np.stack([found, packed]), axis=1)
                grams, n = np.unique(pairs[1], return_counts=True)
                yield pd.DataFrame({"gram": grams, "n": n})

    counts = rows.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return np.sort(counts.filter(F.col("n") >= min_docs).select("gram").toPandas()["gram"].to_numpy(np.int64))


def like_a_language(prototypes: dict[str, np.ndarray], known: np.ndarray, text: Column, least: float, share=0.5, few=20):
    """Whether a text is like one of the languages, as a column; not for null and for texts without a letter.

    It is if its cosine reaches ``least``. Below, where a text of few different trigrams may lie by the noise of
    the vectors, it is if at least ``share`` of its trigrams are known. A text with fewer than ``few`` trigrams
    tells too little for that; below ``least`` it only needs one letter that occurs in the known trigrams.
    """
    matrix = np.stack([prototypes[n] for n in sorted(prototypes)]).astype(np.float32)
    letters = np.unique(np.concatenate([known >> 42, known >> 21 & 0x1FFFFF, known & 0x1FFFFF]))

    def judge(texts: list[str]) -> np.ndarray:
        vectors = bundles(texts, matrix.shape[1])
        out = vectors.any(axis=1) & ((vectors @ matrix.T).max(axis=1) >= least)
        for at in np.flatnonzero(vectors.any(axis=1) & ~out):
            _, packed = trigrams([texts[at]])
            if len(packed) < few:
                points = packed >> 21 & 0x1FFFFF
                out[at] = np.isin(points[points > 0], letters).any()
            else:
                out[at] = np.isin(packed, known).mean() >= share
        return out

    @F.pandas_udf("boolean")
    @trimmed
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = [pd.Series(dtype=bool)]
            for block in _blocks(batch.to_frame("text")):
                out.append(pd.Series(judge(block["text"].tolist())))
            yield pd.concat(out, ignore_index=True)

    return run(F.coalesce(text, F.lit("")))


def cosine(prototypes: dict[str, np.ndarray], text: Column) -> Column:
    """The cosine with the nearest prototype as a column; -1 for null and for texts without a letter."""
    matrix = np.stack([prototypes[n] for n in sorted(prototypes)]).astype(np.float32)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = [pd.Series(dtype=float)]
            for block in _blocks(batch.to_frame("text")):
                vectors = bundles(block["text"].tolist(), matrix.shape[1])
                out.append(pd.Series(np.where(vectors.any(axis=1), (vectors @ matrix.T).max(axis=1), -1).astype(float)))
            yield pd.concat(out, ignore_index=True)

    return run(F.coalesce(text, F.lit("")))


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row.

    score is the cosine with the nearest prototype, at least 0 and at most 1. Texts that are null or have no
    letter, and all texts when there is no prototype, get ``und`` and 0. The smallest name wins a tie. Repeated
    rows and ids stay as they are.
    """
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).astype(np.float32) if names else np.zeros((0, 1))
    size = matrix.shape[1]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in _blocks(batch):
                vectors = bundles(block["text"].tolist(), size)
                out = pd.DataFrame({"doc_id": block["doc_id"].astype("Int64").array, "lang_pred": UNKNOWN, "score": 0.0})
                if names and len(block):
                    cosines = vectors @ matrix.T
                    known = vectors.any(axis=1)
                    best = cosines.argmax(axis=1)
                    out["lang_pred"] = np.where(known, np.array(names, object)[best], UNKNOWN)
                    out["score"] = np.where(known, np.clip(cosines.max(axis=1), 0, 1), 0).astype(float)
                yield out

    return texts(docs, id_col, text_col).mapInPandas(predict, "doc_id long, lang_pred string, score double")
