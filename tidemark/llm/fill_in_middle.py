"""Fill-in-middle: texts cut in three at token boundaries that a Roaring-style set selects."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .letters import chunks

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_BITS = np.arange(64, dtype=np.uint64)


class Values:
    """Array container: the low 16 bits themselves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


class Bitmap:
    """Bitmap container: 1,024 words of 64 bits, with the number of ones up to each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.upto, k, "right") - 1
        ones = np.cumsum((self.words[word, None] >> _BITS) & np.uint64(1), axis=1)
        return word * 64 + np.argmax(ones > (k - self.upto[word])[:, None].astype(np.uint64), axis=1)


class Runs:
    """Run container: starts of runs, with the number of values up to each run."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.upto, k, "right") - 1
        return self.starts[run].astype(np.int64) + k - self.upto[run]


def container(low: np.ndarray) -> Values | Bitmap | Runs:
    """The smallest of the three for ascending 16-bit values: 2 bytes a value, 8 KiB, or 4 bytes a run."""
    first = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
    if 4 * len(first) + 2 < min(2 * len(low), 8192):
        return Runs(low[first], np.diff(np.append(first, len(low))))
    return Values(low) if 2 * len(low) <= 8192 else Bitmap(low)


class BoundarySet:
    """Ascending positions in containers of 65,536, with cumulative cardinalities."""

    def __init__(self, positions: np.ndarray):
        self.keys, first = np.unique(positions >> 16, return_index=True)
        self.upto = np.append(first, len(positions)).astype(np.int64)
        low = positions & 0xFFFF
        self.containers = [container(low[a:b]) for a, b in zip(self.upto[:-1].tolist(), self.upto[1:].tolist())]

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The positions of the given ranks (from 0): the container by search, then its own select."""
        which = np.searchsorted(self.upto, ranks, "right") - 1
        order = np.argsort(which, kind="stable")
        out = np.zeros(len(ranks), np.int64)
        cuts = np.flatnonzero(np.diff(which[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            c = int(which[part[0]])
            out[part] = (int(self.keys[c]) << 16) + self.containers[c].select(ranks[part] - self.upto[c])
        return out


def boundaries(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units ``[A-Za-z]+|[^A-Za-z]`` of the texts begin, in code points of all texts."""
    low = cp | 0x20
    letter = (low >= ord("a")) & (low <= ord("z")) & (cp < 128)
    start = ~letter
    start[1:] |= ~letter[:-1]
    start[offsets[:-1][offsets[:-1] < len(cp)]] = True
    return np.flatnonzero(start)


def _draws(seed: str, doc_id: int | None) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))


def _cut(seed: str, plain: int, spm: int):
    def go(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for first, last, cp, offsets in chunks(texts):
                part, own = texts[first:last], ids.slice(first, last - first)
                draws = np.array([_draws(seed, d) for d in own.to_pylist()], np.int64)
                starts = boundaries(cp, offsets)
                unit = np.searchsorted(starts, offsets)
                n = np.diff(unit)
                cuts = np.sort(draws[:, :2] % (n[:, None] + 1), axis=1)
                bounds = np.append(starts, len(cp))  # past the last unit: the end
                at = BoundarySet(bounds).select((unit[:-1, None] + cuts).ravel()).reshape(cuts.shape) - offsets[:-1, None]
                form, output, sizes = [], [], []
                for text, (a, b), h3, h4 in zip(part, at.tolist(), (draws[:, 2] % 100).tolist(), (draws[:, 3] % 100).tolist()):
                    if not text or h3 >= 100 - plain or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                        form.append("plain")
                        output.append(text)
                        sizes.append((None, None))
                        continue
                    sizes.append((a, b - a))
                    if h4 < spm:
                        form.append("spm")
                        output.append("".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b])))
                    else:
                        form.append("psm")
                        output.append("".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [
                        own,
                        pa.array(n.astype(np.int64)),
                        pa.array(form, pa.string()),
                        pa.array([s[0] for s in sizes], pa.int64()),
                        pa.array([s[1] for s in sizes], pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return go


def transform(docs: DataFrame, seed: str = "1", plain: int = 10, spm: int = 20) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every whole text.

    Units are runs of ASCII letters and single other code points. Four draws of 32 bits come from the SHA-256
    of ``seed``, a colon and the id: two choose the units where middle and suffix begin, the third leaves ``plain``
    in a hundred texts as they are, the fourth puts ``spm`` in a hundred of the others suffix first. The
    boundaries of a batch of texts are one set in array, bitmap and run containers; both offsets of each
    text are selected from it by rank.

    Null texts count as empty; empty texts, and texts that hold a mark, stay plain, without sizes. A null
    id draws as an empty one. Repeated rows give equal rows; no row is dropped; nothing is shuffled.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _cut(seed, plain, spm),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` cut, from its output and form alone."""
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
