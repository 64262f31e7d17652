"""Arrow string columns as numpy arrays: bytes, words, hashes. Used inside tasks only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes of text held as arrays at once; a longer text makes a chunk of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)  # a random value per byte
_powers = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept for the next call."""
    found = _powers.get(int(base))
    if found is None or len(found) < n:
        size = max(n, CHUNK + 1)
        with np.errstate(over="ignore"):
            found = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])
        if size == CHUNK + 1:
            _powers[int(base)] = found
    return found[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def combine(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A hash of each n consecutive values of h."""
    base = np.uint64(0xD6E8FEB86659FD93 + 2 * seed)
    with np.errstate(over="ignore"):
        out, width = h, 1
        size = len(h) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64)
        acc, done = None, 0
        rest = n
        while rest:  # powers of two, lowest first
            if rest & 1:
                part = out[done : done + size]
                acc = part.copy() if acc is None else acc * np.uint64(pow(int(base), width, 1 << 64)) + part
                done += width
            rest >>= 1
            if rest:
                out = out[:-width] * np.uint64(pow(int(base), width, 1 << 64)) + out[width:]
                width *= 2
        return mix(acc)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] (uint64 values, not 0) for each span, wherever it stands."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(_ODD, len(values)), out=total[1:])
        return mix((total[ends] - total[starts]) * powers(_ODD_INVERSE, len(values) + 1)[starts])


def text_chunks(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, UTF-8 bytes, offsets) of runs of rows; null counts as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(arr):
        return
    arr = arr.cast(pa.large_string()).fill_null("") if arr.null_count else arr.cast(pa.large_string())
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(arr):
        last = int(np.searchsorted(off, off[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), len(arr))
        yield first, last, buf[off[first] : off[last]], off[first : last + 1] - off[first]
        first = last


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``inside`` holds; no run crosses an offset."""
    n = len(inside)
    begin = np.zeros(n + 1, bool)
    end = np.zeros(n + 1, bool)
    if n:
        begin[0] = inside[0]
        begin[1:n] = inside[1:] & ~inside[:-1]
        end[1:n] = ~inside[1:] & inside[:-1]
        end[n] = inside[-1]
        cut = offsets[(offsets > 0) & (offsets < n)]
        cut = cut[inside[cut] & inside[cut - 1]]
        begin[cut] = True
        end[cut] = True
    return np.flatnonzero(begin), np.flatnonzero(end)


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words ``[^\\x20\\x09-\\x0D]+``, and the first word of each row."""
    starts, ends = edges(~_SPACE[buf], offsets)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word."""
    return span_hashes(_BYTE[buf], starts, ends)
