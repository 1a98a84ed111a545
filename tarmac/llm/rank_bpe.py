"""Byte-level BPE by a contiguous rank array.

A word is held as two short arrays: the ids between its part boundaries and the ranks of neighbouring ids.
The merge with the least rank is looked up by a scan, its boundary is deleted, and only the ranks on either
side are looked up again. Words above ``LONG`` bytes use a heap over linked parts instead, where scans would
cost the square of the length; both give the same ids.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame

from tarmac.llm.common import texts

#: Fixed value: how the vocabulary's pre-tokeniser cuts a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What keeps a text from being cut at its spaces and line ends: other white space, or two next to each other.
IRREGULAR = re.compile(r"[^\S \n]|\s\s|\A\s|\s\Z")
CLOSING = frozenset(".,;:!?")
NEVER = 1 << 60
LONG = 200
CACHE = 800_000


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: printable Latin-1 bytes as themselves, the
    others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class RankBpe:
    """Vocabulary of a byte-level BPE in the JSON format of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte_of = _byte_letters()
        spelled = ((i, token) for token, i in vocabulary.items() if all(c in byte_of for c in token))
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for i, token in spelled}
        self.byte_ids = [vocabulary[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged = [vocabulary[left + right] for left, right in merges]
        for rank, (left, right) in enumerate(merges):
            self.ranks.setdefault((vocabulary[left], vocabulary[right]), rank)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        marks = sorted(self.added, key=len, reverse=True)
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.pattern = regex.compile(PATTERN)
        self.pieces = _Pieces(self)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        byte_ids, get, merged = self.byte_ids, self.ranks.get, self.merged
        ids = [byte_ids[b] for b in word]
        if len(ids) > LONG:
            return self._merge_long(ids)
        ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            at = ranks.index(least)
            ids[at] = merged[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = get((ids[at], ids[at + 1]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        ranks = self.ranks
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        waiting = [(ranks[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
        heapq.heapify(waiting)
        while waiting:
            rank, at, pair = heapq.heappop(waiting)
            other = after[at]
            if other < 0 or (ids[at], ids[other]) != pair:
                continue
            ids[at], ids[other], after[at] = self.merged[rank], -1, after[other]
            if after[at] >= 0:
                before[after[at]] = at
            for left, right in ((before[at], at), (at, after[at])):
                if left >= 0 and right >= 0 and (ids[left], ids[right]) in ranks:
                    heapq.heappush(waiting, (ranks[ids[left], ids[right]], left, (ids[left], ids[right])))
        return [i for i in ids if i >= 0]

    def ids_of(self, text: str) -> list[int]:
        """The ids of a text without added tokens, word by word."""
        return [i for word in self.pattern.findall(text) for i in self.merge(word.encode())]

    def _plain(self, text: str) -> bytes:
        if IRREGULAR.search(text):
            return array("I", self.ids_of(text)).tobytes()
        # A space or line end between visible characters always begins a new word.
        first, *pieces = text.replace("\n", " \n").split(" ")
        start = array("I", self.ids_of(first)).tobytes()
        if len(self.pieces) >= CACHE:
            self.pieces.clear()
        return start + b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """The ids of a text as unsigned 32-bit integers of the machine, one behind the other."""
        if not text:
            return b""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return self._plain(text)
        out = []
        for part in self.added_pattern.split(text):
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
            elif part:
                out.append(self._plain(part))
        return b"".join(out)

    def decode(self, ids: array) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, ids without a token nothing."""
        bytes_of = self.bytes_of
        return b"".join([bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


class _Pieces(dict):
    """The ids of what stands between two spaces, by that text; unless it begins with a line end, a space
    belongs to its front. Very long ones are not kept."""

    def __init__(self, bpe: RankBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        bpe = self.bpe
        if piece.isalpha():
            ids = bpe.merge((" " + piece).encode())
        elif piece[-1] in CLOSING and piece[:-1].isalpha():
            ids = bpe.merge((" " + piece[:-1]).encode())
            ids.append(bpe.byte_ids[ord(piece[-1])])
        else:
            ids = bpe.ids_of(piece if piece[0] == "\n" else " " + piece)
        raw = array("I", ids).tobytes()
        if len(piece) <= LONG:
            self[piece] = raw
        return raw


@lru_cache(maxsize=2)
def load(path: str) -> RankBpe:
    """One vocabulary with its caches for each worker process."""
    return RankBpe(path)


def encoder(path: str):
    """For other operators: makes, in each task, a function from a text to the bytes of its ids."""
    return lambda: load(path).encode


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row; null and empty texts have no ids, repeated rows stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            ids = [array("I", bpe.encode(t)).tolist() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "ids": ids})

    return texts(docs, id_col, text_col).mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) for every row of ids; null ids give an empty text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            text = [bpe.decode(array("I", [] if i is None else list(i))) for i in batch[ids_col]]
            yield pd.DataFrame({"doc_id": batch[id_col].astype("Int64").array, "text": text})

    return encoded.select(id_col, ids_col).mapInPandas(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass: (doc_id, n_tokens, ids_sha256, decoded_sha256) for every row.

    The digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                raw = bpe.encode(text)
                ids = array("I", raw)
                decoded = bpe.decode(ids).encode("utf-8")
                rows.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return texts(docs, id_col, text_col).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
