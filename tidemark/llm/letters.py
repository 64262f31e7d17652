"""Texts as code point arrays, folded by a table; letter runs as hashed words."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .arrays import edges, span_hashes

_CHUNK = 1 << 19  # code points held at once; a longer text makes a chunk of its own


@lru_cache(maxsize=2)
def fold_table(digits: bool) -> np.ndarray:
    """Lower case of each letter (and digit, if asked for); 0 for all other code points."""
    table = np.zeros(0x110000, np.uint32)
    keep = "LMN" if digits else "LM"
    for c in range(0x110000):
        char = chr(c)
        if unicodedata.category(char)[0] in keep:
            low = char.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def chunks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, code points, offsets) of runs of rows."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _CHUNK or i == len(texts) - 1:
            part = texts[first : i + 1]
            cp = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
            offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))])
            yield first, i + 1, cp, offsets
            first, size = i + 1, 0


def letter_words(cp: np.ndarray, offsets: np.ndarray, prefix: int):
    """Folded letters, starts, ends, hash and prefix hash of each run of letters; first word per row."""
    folded = fold_table(False)[cp]
    starts, ends = edges(folded != 0, offsets)
    values = folded.astype(np.uint64)
    word = span_hashes(values, starts, ends)
    head = span_hashes(values, starts, np.minimum(ends, starts + prefix))
    return folded, starts, ends, word, head, np.searchsorted(starts, offsets)
