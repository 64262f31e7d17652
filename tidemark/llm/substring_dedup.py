"""Repeated passages: the De Bruijn graph of word k-mers, compacted before it is shuffled.

Every window of k words is an edge of the graph. A run of consecutive edges that share their
least m-word hash (the *anchor*) is compacted to one row in the task that reads the text, so that
a shuffle sees about one row per eight words. A Spark join on the anchor tells how the path
behind it branches:

* all occurrences of the anchor have the same surroundings: the run is nonbranching, and every
  occurrence but the first is removed whole;
* the surroundings differ: the path branches there, and only these runs are expanded to single
  edges, which are joined on their own hashes.

Edges are compared by document id and by "is the first of its hash in this document", so an
aggregate per hash is a count and a minimum: hot passages shrink to a row per task before they
are shuffled, and the joins back are split by adaptive execution.

Identity of a run is 128 hash bits (anchor and surroundings), of an edge 96.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .arrays import combine, mix, span_hashes, text_chunks, word_hashes, words
from .storage import keyed, written

ANCHOR_WORDS = 6
_ANCHORS = "h long, ctx long, did long, th long, run long, first boolean"
_PARTS = (
    "doc_id long, did long, th long, n_words long, n_removed long, kept_sha256 string, kept string, packed binary, "
    "ranges array<int>, edges array<struct<w:long,c:int,pos:int,first:boolean>>"
)
_FINAL = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, ranges array<int>"


def _first_of_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether each key is the first such key of its row (rows ascend)."""
    with np.errstate(over="ignore"):
        both = mix(keys ^ (rows.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    first = np.zeros(len(keys), bool)
    first[np.unique(both, return_index=True)[1]] = True
    return first


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each ``width`` consecutive values."""
    value, at, have = h, np.arange(len(h)), 1
    while have < width:
        step = min(have, width - have)
        left, right = value[:-step], value[step:]
        later = right < left
        value, at = np.where(later, right, left), np.where(later, at[step:], at[:-step])
        have += step
    return at


def _runs(buf, offsets, k: int, m: int):
    """Per compacted run of a chunk: row, anchor, surroundings, first window, windows, first in row."""
    starts, ends, heads = words(buf, offsets)
    n = len(starts)
    if n < k:
        return None
    wh = word_hashes(buf, starts, ends)
    counts = np.diff(heads)
    left = np.repeat(heads[1:], counts) - np.arange(n)  # words from here to the end of the text
    grams = combine(wh, m, 1)
    least = _sliding_least(grams, k - m + 1)
    window = np.flatnonzero(left[: len(least)] >= k)
    if not len(window):
        return None
    anchor = least[window]
    change = np.flatnonzero(np.diff(anchor)) + 1
    at = np.concatenate([[0], change])
    size = np.diff(np.concatenate([at, [len(window)]]))
    begin = window[at]
    h = grams[anchor[at]]
    inner = (anchor[at] - begin).astype(np.uint64)
    with np.errstate(over="ignore"):
        ctx = mix(span_hashes(wh, begin, begin + size + k - 1) + inner * np.uint64(0x9FB21C651E98DF25))
    row = np.searchsorted(heads, begin, "right") - 1
    return row, h, ctx, begin - heads[row], size, _first_of_row(h, row)


def _anchors(k: int, m: int):
    def go(batches):
        for batch in batches:
            ids, hashes = batch.column("did"), batch.column("th")
            for first, last, buf, offsets in text_chunks(batch.column("text")):
                found = _runs(buf, offsets, k, m)
                if found is None:
                    continue
                row, h, ctx, begin, size, lead = found
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(ctx.view(np.int64)),
                        ids.take(take),
                        hashes.take(take),
                        pa.array(begin.astype(np.int64) << 8 | size),
                        pa.array(lead),
                    ],
                    names=["h", "ctx", "did", "th", "run", "first"],
                )

    return go


def _covered(n: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, begin, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:n]) > 0


def _finish(text: bytes, begin, end, with_text: bool):
    """n_words, n_removed, hash of the kept words, the kept words, removed word ranges."""
    parts = text.split()
    gone = _covered(len(parts), begin, end)
    if gone.any():
        kept = b" ".join([w for w, g in zip(parts, gone.tolist()) if not g])
        step = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
    else:
        kept, step = b" ".join(parts), []
    return (
        len(parts),
        int(gone.sum()),
        hashlib.sha256(kept).hexdigest(),
        kept.decode() if with_text else None,
        [int(x) for x in step],
    )


def _expand(k: int, with_text: bool):
    """Settle documents without branching runs; list the edges of the others, with the text compressed."""

    def go(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out = []
            for doc_id, did, th, text, runs in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "did", "th", "text", "runs"))
            ):
                if len(out) >= 500:
                    yield _batch(out, _PARTS_ARROW)
                    out = []
                raw = (text or "").encode()
                packed = np.array(runs or [], np.int64)
                begin, size = packed >> 10, (packed >> 2) & 255
                whole, open_ = (packed & 3) == 1, (packed & 3) == 2
                lo, hi = begin[whole], begin[whole] + size[whole] + k - 1
                if not open_.any():
                    done = _finish(raw, lo, hi, with_text)
                    out.append((doc_id, did, th, *done[:4], None, done[4], None))
                    continue
                buf = np.frombuffer(raw, np.uint8)
                starts, ends, _ = words(buf, np.array([0, len(buf)]))
                wh = word_hashes(buf, starts, ends)
                at = np.unique(np.concatenate([np.arange(b, b + s) for b, s in zip(begin[open_], size[open_])]))
                w, c = combine(wh, k, 2)[at], combine(wh, k, 3)[at]
                lead = _first_of_row(w, np.zeros(len(w), np.int64))
                edges = [
                    {"w": a, "c": b, "pos": p, "first": f}
                    for a, b, p, f in zip(
                        w.view(np.int64).tolist(), c.astype(np.uint32).view(np.int32).tolist(), at.tolist(), lead.tolist()
                    )
                ]
                out.append((doc_id, did, th, len(starts), None, None, None, squeeze.compress(raw),
                            np.stack([lo, hi], 1).ravel().tolist(), edges))
            if out:
                yield _batch(out, _PARTS_ARROW)

    return go


_RANGES = pa.list_(pa.int32())
_PARTS_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()),
        ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()), ("packed", pa.binary()),
        ("ranges", _RANGES),
        ("edges", pa.list_(pa.struct([("w", pa.int64()), ("c", pa.int32()), ("pos", pa.int32()), ("first", pa.bool_())]))),
    ]
)
_FINAL_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
     ("kept", pa.string()), ("ranges", _RANGES)]
)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _settle(k: int, with_text: bool):
    def go(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for doc_id, packed, ranges, gone in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "packed", "ranges", "gone"))
            ):
                pairs = np.array(ranges or [], np.int64).reshape(-1, 2)
                single = np.array(gone or [], np.int64)
                out.append((doc_id, *_finish(unpack.decompress(packed), np.concatenate([pairs[:, 0], single]),
                                             np.concatenate([pairs[:, 1], single + k]), with_text)))
            if out:
                yield _batch(out, _FINAL_ARROW)

    return go


def remove_repeats(docs: DataFrame, k: int = 20, anchor_words: int = ANCHOR_WORDS, with_text: bool = False) -> DataFrame:
    """Remove every word inside a k-word window whose words also start earlier in the corpus.

    Earlier means a smaller ``doc_id``, or the same document and an earlier start. Returns per row
    of ``docs``: doc_id, n_words, n_removed, kept_sha256 (SHA-256 of the kept words joined by one
    space), kept (these words, if ``with_text``) and ranges (removed word positions: start, end,
    start, end, ...).

    A null or empty text has no words. A null id counts as the largest id. Rows with the same id
    do not remove one another's windows at the same start; rows repeated whole get equal results.
    Texts of any length are read whole; columns besides doc_id and text are ignored.
    """
    if not 1 <= anchor_words <= k or k - anchor_words > 200:
        raise ValueError("anchor_words must be in 1..k, at most 200 words shorter")
    texts = keyed(docs).withColumn("th", F.xxhash64("text"))
    runs = texts.select("did", "th", "text").mapInArrow(_anchors(k, anchor_words), _ANCHORS)
    # One row per anchor: a count and minima, combined before the shuffle. What repeats is little; dealing it
    # out anew leaves the join free to split a hot anchor.
    seen = (
        runs.groupBy("h")
        .agg(F.count("*").alias("n"), F.min("did").alias("d0"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"))
        .where("n > 1")
        .select("h", "d0", (F.col("c0") != F.col("c1")).alias("branching"))
        .repartition(F.hash("h", "d0"))
    )
    leads = F.col("first") & (F.col("did") == F.col("d0"))
    marked = (
        runs.select("h", "did", "th", "run", "first")
        .join(seen, "h")
        .where(F.col("branching") | ~leads)
        .select("did", "th", (F.shiftleft("run", 2) + F.when(F.col("branching"), 2).otherwise(1)).alias("run"))
        .groupBy("did", "th")
        .agg(F.collect_set("run").alias("runs"))  # rows repeated whole list theirs once
    )
    marked = written(marked, "runs")
    parts = written(
        texts.join(marked, ["did", "th"], "left")
        .select("doc_id", "did", "th", "text", "runs")
        .mapInArrow(_expand(k, with_text), _PARTS),
        "passages",
    )
    edges = parts.where("edges IS NOT NULL").select("did", "th", F.explode("edges").alias("e")).select("did", "th", "e.*")
    twice = (
        edges.groupBy("w", "c").agg(F.count("*").alias("n"), F.min("did").alias("d0")).where("n > 1").drop("n")
        .repartition(F.hash("w", "c", "d0"))
    )
    gone = (
        edges.join(twice, ["w", "c"])
        .where(~F.col("first") | (F.col("did") > F.col("d0")))
        .groupBy("did", "th")
        .agg(F.collect_set("pos").alias("gone"))
    )
    open_ = (
        parts.where("edges IS NOT NULL")
        .select("doc_id", "did", "th", "packed", "ranges")
        .join(gone, ["did", "th"], "left")
        .select("doc_id", "packed", "ranges", "gone")
        .mapInArrow(_settle(k, with_text), _FINAL)
    )
    closed = parts.where("edges IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "kept", "ranges")
    return closed.unionByName(open_)
