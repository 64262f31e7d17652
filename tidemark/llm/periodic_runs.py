"""Periodic runs of words: segments split at rare words until stable, then scanned lag by lag.

A run with period q and at least ``repeats`` periods holds each of its words at least ``repeats``
times. A word that occurs less often within its segment is in no run that counts, so it splits the segment;
the parts are judged again within themselves, until no segment changes. Only what is left is scanned.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import _ODD, combine, edges, mix, powers

_CHUNK = 1 << 20  # bytes of text handled at once; a longer text makes a chunk of its own
_PROBES = 1 << 20  # probes of the lag scan held at once

RUN = "start long, length long, period long"


def segments(ids: np.ndarray, offsets: np.ndarray, shortest: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that rare words leave; ids[offsets[i]:offsets[i + 1]] is text i."""
    n = len(ids)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((ids, doc))  # places of each word of each text, ascending
    same = (doc[order][1:] == doc[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    group = np.concatenate([[0], np.cumsum(~same)]) if n else np.zeros(0, np.int64)
    # Place i counts ``repeats`` times within a segment if one of these pairs of places lies in it.
    first, last = np.full((repeats, n), -1, np.int64), np.full((repeats, n), n, np.int64)
    k = np.arange(n - repeats + 1)
    k = k[group[k] == group[k + repeats - 1]] if len(k) else k
    for j in range(repeats):
        first[j, order[k + j]] = order[k]
        last[j, order[k + j]] = order[k + repeats - 1]
    s, e = offsets[:-1], offsets[1:]
    long = e - s >= shortest
    s, e = s[long], e[long]
    done = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    while len(s):
        size = e - s
        inner = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(inner[-1]) + np.repeat(s - inner[:-1], size)
        low, high = np.repeat(s, size), np.repeat(e, size)
        often = np.zeros(len(at), bool)
        for j in range(repeats):
            often |= (first[j, at] >= low) & (last[j, at] < high)
        a, b = edges(often, inner)
        long = b - a >= shortest
        a, b = a[long], b[long]
        seg = np.searchsorted(inner, a, "right") - 1
        shift = (s - inner[:-1])[seg]
        a, b = a + shift, b + shift
        stable = (a == s[seg]) & (b == e[seg])
        done.append((a[stable], b[stable]))
        s, e = a[~stable], b[~stable]
    s, e = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(s)
    return s[order], e[order]


class _Spans:
    """Hashes of stretches of ids, to find how far two places agree."""

    def __init__(self, ids: np.ndarray):
        self.values = mix(ids.astype(np.uint64) + np.uint64(1))
        self.powers = powers(_ODD, len(ids) + 1)
        self.total = np.zeros(len(ids) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.values * self.powers[: len(ids)], out=self.total[1:])

    def equal(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ids[at:at + size] and the same ``lag`` later have one hash."""
        with np.errstate(over="ignore"):
            here = (self.total[at + size] - self.total[at]) * self.powers[lag]
            return here == self.total[at + lag + size] - self.total[at + lag]

    def agree(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The largest size up to ``most`` at which both agree, onwards from ``at`` or back from it."""
        low, high = np.zeros(len(at), np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            start = at[open_] - middle if back else at[open_]
            yes = self.equal(start, lag[open_], middle)
            low[open_] = np.where(yes, middle, low[open_])
            high[open_] = np.where(yes, high[open_], middle - 1)


def _probes(s, e, shortest, repeats, width):
    """(segment, lag, place) in blocks: one place in each stretch of agreement long enough to be a run's."""
    lags = (e - s) // repeats
    seg = np.repeat(np.arange(len(s)), lags)
    lag = np.arange(len(seg)) - np.repeat(np.cumsum(lags) - lags, lags) + 1
    stride = np.maximum(shortest, repeats * lag) - lag - width + 1
    n = np.maximum(-(-(e[seg] - s[seg] - lag - width + 1) // stride), 0)
    upto = np.concatenate([[0], np.cumsum(n)])
    first = 0
    while first < len(seg):
        last = max(int(np.searchsorted(upto, upto[first] + _PROBES, "right")) - 1, first + 1)
        size = n[first:last]
        k = np.arange(upto[last] - upto[first]) - np.repeat(upto[first:last] - upto[first], size)
        own, q = np.repeat(seg[first:last], size), np.repeat(lag[first:last], size)
        yield own, q, s[own] + k * np.repeat(stride[first:last], size)
        first = last


def lag_scan(ids: np.ndarray, s: np.ndarray, e: np.ndarray, shortest: int, repeats: int) -> np.ndarray:
    """(start, end, period) of every run in the segments, by start, then period.

    A run agrees with itself q words later over ``max(shortest, repeats * q) - q`` words or more. Each lag
    is probed once per such stretch, with a window of words, so a segment of m words takes about m log m probes;
    where a probe agrees, the stretch is followed both ways. The words themselves are compared before a run is
    returned; if hashes misled anywhere in a segment, all its lags are scanned word by word.
    """
    if not len(s):
        return np.zeros((0, 3), np.int64)
    widest = np.arange(1, max(shortest // repeats, 1) + 2)
    width = max(1, int((np.maximum(shortest, repeats * widest) - widest).min()) // 2)
    spans = _Spans(ids)
    window = combine(spans.values, width, 11)
    hits = []
    for seg, q, at in _probes(s, e, shortest, repeats, width):
        yes = window[at] == window[at + q]
        seg, q, at = seg[yes], q[yes], at[yes]
        if len(at):  # of the probes in one stretch the first is enough
            near = np.flatnonzero((seg[1:] == seg[:-1]) & (q[1:] == q[:-1]))
            lone = np.ones(len(at), bool)
            lone[near[spans.equal(at[near], q[near], at[near + 1] - at[near])] + 1] = False
            seg, q, at = seg[lone], q[lone], at[lone]
        start = at - spans.agree(at, q, at - s[seg], back=True)
        end = at + q + spans.agree(at, q, e[seg] - at - q, back=False)
        long = end - start >= np.maximum(shortest, repeats * q)
        hits.append(np.unique(np.stack([seg[long], start[long], end[long], q[long]], axis=1), axis=0))
    hits = np.unique(np.concatenate(hits), axis=0)  # by segment, start, end, then period
    new = np.ones(len(hits), bool)
    new[1:] = (hits[1:, :3] != hits[:-1, :3]).any(axis=1)
    least = hits[np.flatnonzero(new)[np.cumsum(new) - 1], 3] if len(hits) else hits[:, 3]
    wrong = set(hits[hits[:, 3] % least != 0, 0].tolist())  # other lags of one stretch are multiples of its period
    found = []
    for seg, a, b, q in hits[new].tolist():
        if not np.array_equal(ids[a : b - q], ids[a + q : b]):
            wrong.add(seg)
        found.append((seg, a, b, q))
    runs = [(a, b, q) for seg, a, b, q in found if seg not in wrong]
    for seg in wrong:
        runs += every_lag(ids, int(s[seg]), int(e[seg]), shortest, repeats)
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def every_lag(ids: np.ndarray, s: int, e: int, shortest: int, repeats: int) -> list[tuple[int, int, int]]:
    """The same for one segment by comparing all its words at all lags."""
    found = {}
    own = ids[s:e]
    for q in range(1, (e - s) // repeats + 1):
        a, b = edges(own[:-q] == own[q:], np.array([0, len(own) - q]))
        b = b + q
        long = b - a >= max(shortest, repeats * q)
        for start, end in zip((a[long] + s).tolist(), (b[long] + s).tolist()):
            found.setdefault((start, end), q)
    return [(a, b, q) for (a, b), q in found.items()]


def find(ids: np.ndarray, offsets: np.ndarray, shortest: int = 24, repeats: int = 3) -> np.ndarray:
    """(start, end, period) of the runs of all texts, in places of ``ids``."""
    return lag_scan(ids, *segments(ids, offsets, shortest, repeats), shortest, repeats)


def _groups(texts: list[bytes]):
    """(first, last + 1) of runs of rows of bounded size."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _CHUNK or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


def _scan(shortest: int, repeats: int):
    def go(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for first, last in _groups(texts):
                words = [t.split() for t in texts[first:last]]  # at the six ASCII blanks
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                names = defaultdict(count().__next__)
                ids = np.fromiter(map(names.__getitem__, chain.from_iterable(words)), np.int64, int(offsets[-1]))
                runs = find(ids, offsets, shortest, repeats)
                cut = np.searchsorted(runs[:, 0], offsets)
                cut[-1] = len(runs)
                best, kept = [], []
                for i, own in enumerate(words):
                    here = runs[cut[i] : cut[i + 1]] - [[offsets[i], offsets[i], 0]]
                    if len(here):
                        top = min(here.tolist(), key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
                        best.append({"start": top[0], "length": top[1] - top[0], "period": top[2]})
                        change = np.zeros(len(own) + 1, np.int64)
                        np.add.at(change, here[:, 0] + here[:, 2], 1)
                        np.add.at(change, here[:, 1], -1)
                        stay = np.cumsum(change[:-1]) == 0
                        own = [own[k] for k in np.flatnonzero(stay).tolist()]
                    else:
                        best.append(None)
                    kept.append(b" ".join(own))
                base = np.repeat(offsets[:-1], np.diff(cut))
                struct = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - base), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                    names=["start", "length", "period"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), struct),
                        pa.array(best, struct.type),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "best", "collapsed"],
                )

    return go


def periodic_runs(docs: DataFrame, shortest: int = 24, repeats: int = 3) -> DataFrame:
    """doc_id, n_words, runs, best and collapsed of every whole text of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words with smallest period q, at least
    ``shortest`` words and ``repeats`` periods long, that no neighbouring word extends. ``runs`` (start, length, period)
    are in order of start, then period; ``best`` has the greatest length / period (ties: least start, then period) and
    is null without runs. ``collapsed`` are the words that no run contains after its first q, joined by one
    space.

    Null and empty texts have no words and no runs. Repeated rows and null ids are returned as they are; an
    empty table gives no row. Nothing is shuffled: a text is judged by itself.
    """
    if repeats < 2 or shortest < repeats:
        raise ValueError("a run has at least two periods and one word for each")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan(shortest, repeats),
        f"doc_id long, n_words long, runs array<struct<{RUN.replace(' long', ':long')}>>, "
        f"best struct<{RUN.replace(' long', ':long')}>, collapsed string",
    )
