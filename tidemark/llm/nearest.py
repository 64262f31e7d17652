"""Approximate nearest neighbours: a forest of hash prefixes over sorted arrays.

Every vector gets one long bit string per tree (signs of its products with the tree's directions).
A tree is the sorted array of these strings. A query descends in each tree to its longest prefix
that occurs, then all trees ascend together, one bit at a time, until the rows under the current
prefixes are enough candidates; these are compared by exact cosine on the original vectors.

Rows are dealt over chunks by a hash, each with its own forest, and queries over blocks; a chunk
meets a block in one task, so neither grows with the data. Equal vectors are one row of the index
with their k + 1 smallest ids, which is all that a result of k neighbours can need of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import written

CHUNK, BLOCK = 8192, 8192


class Forest:
    """Sorted hash strings of one chunk of vectors."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int = 6):
        self.trees, self.bits = trees, bits
        self.planes = _planes(vectors.shape[1], trees, bits, seed)
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(codes, self.order, 0).T)
        self.order = np.ascontiguousarray(self.order.T)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One string of ``bits`` bits per vector and tree, most significant first."""
        signs = (vectors @ self.planes > 0).reshape(len(vectors), self.trees, self.bits)
        return (signs * (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))).sum(2, dtype=np.uint64)

    def candidates(self, codes: np.ndarray, enough: int) -> np.ndarray:
        """Rows under the query's prefixes, for the longest common depth that yields ``enough``."""
        seen = np.zeros(self.sorted.shape[1], bool)
        low = np.zeros((self.bits + 1, self.trees), np.int64)
        high = np.zeros((self.bits + 1, self.trees), np.int64)
        depth = np.arange(self.bits + 1, dtype=np.uint64)
        rest = np.uint64(self.bits) - depth
        for t in range(self.trees):
            first = (codes[t] >> rest) << rest
            last = first + ((np.uint64(1) << rest) - np.uint64(1))
            low[:, t] = np.searchsorted(self.sorted[t], first, "left")
            high[:, t] = np.searchsorted(self.sorted[t], last, "right")
        size = (high - low).sum(1)
        # A depth cannot yield more rows than its prefixes hold, so deeper ones need no look.
        start = int(np.flatnonzero(size >= min(enough, len(seen)))[-1]) if len(seen) else 0
        for d in range(start, -1, -1):
            for t in range(self.trees):
                seen[self.order[t, low[d, t] : high[d, t]]] = True
            if np.count_nonzero(seen) >= enough:
                break
        return np.flatnonzero(seen)


def _planes(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    """Directions, orthogonal within a tree as far as the dimension allows."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        blocks = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-bits // dim))]
        out.append(np.concatenate(blocks, 1)[:, :bits])
    return np.concatenate(out, 1)


def _matrix(column) -> np.ndarray:
    """Vectors as rows, each times the power of two that brings its largest component to 0.5 .. 1.

    Cosines stay what they are, but squares of very small or large components neither vanish nor overflow.
    """
    v = np.array(column.to_pylist(), np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])


def _search(k: int, trees: int, bits: int, share: float):
    names = ["query", "rep", "score"]

    def go(index: pa.Table, queries: pa.Table) -> pa.Table:
        out = {n: [] for n in names}
        if index.num_rows and queries.num_rows:
            rows, asked = _matrix(index.column("v")), _matrix(queries.column("v"))
            reps, ids = index.column("rep").to_numpy(), queries.column("rep").to_numpy()
            norms = np.sqrt((rows * rows).sum(1))
            own = np.sqrt((asked * asked).sum(1))
            centre = (rows / norms[:, None]).mean(0)
            forest = Forest(rows / norms[:, None] - centre, trees, bits)
            codes = forest.codes(asked / own[:, None] - centre)
            enough = max(k + 1, int(np.ceil(share * len(rows))))
            for i in range(len(asked)):
                c = forest.candidates(codes[i], enough)
                score = (rows[c] @ asked[i]) / (norms[c] * own[i])
                if len(c) > k + 1:  # all that tie with the last are kept for the final order
                    c, score = (a[score >= np.partition(score, -(k + 1))[-(k + 1)]] for a in (c, score))
                out["query"].append(np.full(len(c), ids[i]))
                out["rep"].append(reps[c])
                out["score"].append(score)
        none = {"query": np.int64, "rep": np.int64, "score": np.float64}
        return pa.table({n: np.concatenate(out[n]) if out[n] else np.zeros(0, none[n]) for n in names})

    return go


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    trees: int = 48,
    bits: int = 32,
    share: float = 0.4,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k found rows nearest to each query by cosine, ties to smaller ids.

    Both inputs have vec_id and embedding; a query's own id is no candidate for it. The trees
    ascend until ``share`` of each chunk is compared; 0.4 suits data without close neighbours (see
    the README for measured recall), less is enough where neighbours are close. Vectors that are
    null, empty or zero or hold a null or non-finite component take no part, nor do rows without
    id; rows repeated whole count once; vectors of another length are no candidates. Fewer
    candidates than k are all returned.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def clean(df: DataFrame) -> DataFrame:
        return (
            df.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(finite).where(F.exists(v, lambda x: x != 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()
        )

    rows, asked = clean(vectors), clean(queries)
    # Equal vectors: the k + 1 smallest ids (limited before the shuffle), the least names the group.
    first = Window.partitionBy("v").orderBy("vec_id")
    groups = written(
        rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), F.size("v").alias("dim"), "v", "ids"),
        "vectors",
    )
    heads = asked.groupBy("v").agg(F.min("vec_id").alias("rep"))
    heads = written(heads.select("rep", F.size("v").alias("dim"), "v"), "queries")
    chunks = max(1, -(-groups.count() // CHUNK))
    blocks = max(1, -(-heads.count() // BLOCK))
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    part = lambda n: F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int")
    index = groups.select("dim", "rep", "v", part(chunks).alias("chunk"), each(blocks, "block"))
    dealt = heads.select("dim", "rep", "v", part(blocks).alias("block"), each(chunks, "chunk"))
    keys = ["dim", "chunk", "block"]
    found = index.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        _search(k, trees, bits, share), "query long, rep long, score double"
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "rep")
    found = written(found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"), "found")
    # Back to the ids of equal vectors on both sides.
    found = found.join(groups.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    found = (
        found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    )
    members = asked.join(heads.select("v", F.col("rep").alias("query")), "v").select(F.col("vec_id").alias("query_id"), "query")
    near = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (
        members.join(found, "query")
        .select("query_id", F.posexplode(near).alias("rank", "x"))
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
    )
