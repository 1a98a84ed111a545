"""Ids of a byte-level vocabulary in the JSON format of the tokenizers library, from compiled code.

The merges of a trained byte-level BPE are applied in the order of the ids they make, so the vocabulary's tokens
with their ids are all that tiktoken needs to give the same ids as tokenizers; tests compare the two. Texts that
its pattern engine refuses, with runs of about a million white-space letters, are encoded by ``rank_bpe``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
import tiktoken

from tarmac.llm.rank_bpe import PATTERN, RankBpe


@lru_cache(maxsize=1)
def _own(path: str) -> RankBpe:
    """Loaded only for the texts that need it."""
    return RankBpe(path)


def _ids_follow_merges(bpe: RankBpe) -> bool:
    """Whether every merge makes a larger id than the merges before it, which tiktoken takes for granted."""
    return all(x < y for x, y in zip(bpe.merged, bpe.merged[1:]))


@lru_cache(maxsize=1)
def _load(path: str) -> Callable[[str], bytes]:
    bpe = RankBpe(path)
    if not _ids_follow_merges(bpe):
        return lambda text: np.frombuffer(_own(path).encode(text), np.uintc).astype("<u4").tobytes()
    ranks = {token: i for i, token in bpe.bytes_of.items() if i not in bpe.added.values()}
    encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=bpe.added)
    added = sorted(bpe.added, key=len, reverse=True)
    marks = regex.compile("|".join(map(regex.escape, added))) if added else None

    def encode(text: str) -> bytes:
        special = "all" if marks is not None and marks.search(text) else set()
        try:
            ids = encoding.encode_to_numpy(text, allowed_special=special, disallowed_special=())
        except ValueError:  # its pattern engine runs out of stack on very long runs of white space
            return np.frombuffer(_own(path).encode(text), np.uintc).astype("<u4").tobytes()
        return ids.astype("<u4", copy=False).tobytes() if len(ids) else np.empty(0, "<u4").tobytes()

    return encode


def encoder(path: str) -> Callable[[], Callable[[str], bytes]]:
    """Makes, in each task, a function from a text to its ids as little-endian unsigned 32-bit integers."""
    return lambda: _load(path)
