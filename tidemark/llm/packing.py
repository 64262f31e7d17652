"""Best-fit packing of token pieces under several capacities at once."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import default_path, encoder
from .storage import keyed, written

_PIECES = "doc_id long, did long, piece int, start long, length long, ids_crc32 long"
_SHARE = 50_000  # pieces ranked by one task


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds: tokens, documents and attention cost (sum of squared lengths).

    An attention capacity under tokens squared binds: pieces are no longer than its root, so each fits
    alone, and a sequence may be full of attention before it is full of tokens.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048

    def __post_init__(self):
        if min(self.tokens, self.documents, self.attention) < 1:
            raise ValueError("a sequence must hold a piece")

    @property
    def longest(self) -> int:
        """Tokens of the longest piece that fits alone."""
        return min(self.tokens, math.isqrt(self.attention))


def _cut(path: str, longest: int, end_id: int, with_ids: bool):
    def go(batches):
        for batch in batches:
            doc_ids, dids = batch.column("doc_id").to_pylist(), batch.column("did").to_pylist()
            ids, counts = encoder(path).encode([t or "" for t in batch.column("text").to_pylist()])
            out, at = [], 0
            for doc_id, did, n in zip(doc_ids, dids, counts.tolist()):
                own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                at += n
                head = (n + 1) % longest or longest
                bounds = [0, *range(head, n + 2, longest)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    row = (doc_id, did, k, a, b - a, zlib.crc32(own[a:b].tobytes()))
                    out.append((*row, own[a:b].tolist()) if with_ids else row)
            schema = _SCHEMA if not with_ids else _SCHEMA.append(pa.field("ids", pa.list_(pa.int32())))
            for k in range(0, len(out), 20_000):
                cols = list(zip(*out[k : k + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return go


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("did", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
     ("ids_crc32", pa.int64())]
)


def pieces(docs: DataFrame, longest: int = 2048, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False):
    """Token pieces of every text: doc_id, did, piece, start, length, ids_crc32 (and ids).

    Each text is encoded whole, ``end_id`` follows; only what is longer than ``longest`` is cut,
    so that all pieces but the first are full.
    """
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return keyed(docs).select("doc_id", "did", "text").mapInArrow(
        _cut(tokenizer or default_path(), longest, end_id, with_ids), schema
    )


class _Bins:
    """Bins alike in all three residuals form one class: a count and ranges of bin numbers."""

    def __init__(self):
        self.left = np.zeros((256, 3))
        self.count = np.zeros(256, np.int64)
        self.ranges: list[list[list[int]]] = []
        self.index: dict[tuple[int, int, int], int] = {}

    def add(self, state: tuple[int, int, int], ranges: list[list[int]]) -> None:
        k = self.index.get(state)
        if k is None:
            k = self.index[state] = len(self.ranges)
            if k == len(self.count):
                self.left = np.concatenate([self.left, np.zeros_like(self.left)])
                self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.left[k] = state
            self.ranges.append([])
        self.ranges[k] += ranges
        self.count[k] += sum(n for _, n in ranges)

    def take(self, k: int, n: int) -> list[list[int]]:
        out, pool = [], self.ranges[k]
        self.count[k] -= n
        while n:
            first, have = pool[-1]
            use = min(have, n)
            out.append([first, use])
            n -= use
            if use == have:
                pool.pop()
            else:
                pool[-1] = [first + use, have - use]
        return out


def plan(histogram: dict[int, int], capacity: Capacity, weights=(1.0, 1.0, 1.0), rule: str = "norm") -> dict:
    """Best fit over a histogram of lengths, longest first; arrays of runs.

    A piece of length l asks for (l, 1, l * l) of a bin's residual tokens, documents and attention
    cost, each as a share of the capacity. Of the bins where all three fit, ``norm`` takes the one
    whose weighted residual vector is shortest afterwards, ``dot`` the one whose residual has the
    largest weighted dot product with the piece. A new bin is opened only if none fits. Equal
    lengths go to equal bins in one step, so the work depends on the number of lengths (at most
    capacity.tokens), not on the number of pieces.

    A run says: pieces rank .. rank + n - 1 of a length go to bins bin .. bin + n - 1 at an offset.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    w = np.array(weights, float)
    bins, total = _Bins(), 0
    runs = {k: [] for k in ("length", "rank", "n", "bin", "offset")}
    for length in sorted(histogram, reverse=True):
        need = (length, 1, length * length)
        ask = np.array(need, float)
        rank, left = 0, histogram[length]
        fit_many = min(capacity.tokens // length, capacity.documents, capacity.attention // need[2])
        while left:
            m = len(bins.ranges)
            ok = (bins.count[:m] > 0) & (bins.left[:m] >= ask).all(1)
            if ok.any():
                rest = bins.left[:m] - ask
                score = (w * (rest / full) ** 2).sum(1) if rule == "norm" else -(w * bins.left[:m] * ask / full**2).sum(1)
                k = int(np.argmin(np.where(ok, score, np.inf)))
                state = tuple(int(x) for x in bins.left[k])
                got = bins.take(k, int(min(left, bins.count[k])))
            else:
                state = (capacity.tokens, capacity.documents, capacity.attention)
                n = -(-left // fit_many)
                got = [[total, n]]
                total += n
            for first, n in got:
                for key, value in zip(runs, (length, rank, n, first, capacity.tokens - state[0])):
                    runs[key].append(value)
                rank += n
                left -= n
            after = tuple(a - b for a, b in zip(state, need))
            if min(after) > 0:
                bins.add(after, got)
    return {k: np.array(v, np.int64) for k, v in runs.items()} | {"bins": total}


def _place(runs: dict):
    key = (runs["length"] << 44) + runs["rank"]
    order = np.argsort(key)
    key, rank, first, offset = key[order], runs["rank"][order], runs["bin"][order], runs["offset"][order]

    def go(batches):
        for batch in batches:
            length, own = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, (length << 44) + own, "right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(first[k] + own - rank[k]), pa.array(offset[k])],
                names=[*names, "sequence_id", "offset"],
            )

    return go


def pack(
    docs: DataFrame,
    capacity: Capacity = Capacity(),
    tokenizer: str | None = None,
    end_id: int = 0,
    weights=(1.0, 1.0, 1.0),
    rule: str = "norm",
    with_ids: bool = False,
) -> DataFrame:
    """Place every token piece of ``docs`` in a sequence within all capacities.

    Returns per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id and offset;
    the offsets of a sequence leave no gap. A null text is empty and gives the end id alone; a
    null id is returned as null; repeated rows are packed each.

    The pieces are written once. Spark counts them by length; the driver sees that histogram
    (at most ``capacity.longest`` rows) and plans runs. A piece's rank within its length comes from
    ranks within (length, share) and the shares' counts, so a common length is dealt over tasks.
    """
    table = written(pieces(docs, capacity.longest, tokenizer, end_id, with_ids), "pieces")
    total = table.count()
    shares = max(1, -(-total // _SHARE))
    dealt = table.withColumn("share", F.pmod(F.xxhash64("did", "piece", "ids_crc32"), F.lit(shares)).cast("int"))
    counts = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    counts = written(counts, "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "share").orderBy("did", "piece", "start", "ids_crc32")
    ranked = (
        dealt.withColumn("own", F.row_number().over(own))
        .join(counts, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("own") - 1)
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = _PIECES.replace("did long, ", "") + (", ids array<int>" if with_ids else "")
    return ranked.select(*names, "rank").mapInArrow(
        _place(plan(histogram, capacity, weights, rule)), schema + ", sequence_id long, offset long"
    )
