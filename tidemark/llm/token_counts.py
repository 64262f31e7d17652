"""Exact token counts: a histogram of encoded lengths and its suffix sums."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import default_path, encoder
from .storage import written

BLOCK = 4096  # lengths summed by one task; sums of whole blocks are added to it


def _lengths(path: str):
    def go(batches):
        for batch in batches:
            _, counts = encoder(path).encode([t or "" for t in batch.column("text").to_pylist()])
            length, n = np.unique(counts, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(length.astype(np.int64)), pa.array(n.astype(np.int64))], names=["length", "n"]
            )

    return go


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(length, n_docs): how many rows of ``docs`` encode to each number of ids.

    Whole texts are encoded, without special tokens; a null text counts as empty (length 0).
    Repeated rows count each. Tasks send one row per length and batch, so no length is hot.
    """
    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_lengths(tokenizer or default_path()), "length long, n long")
        .groupBy("length")
        .agg(F.sum("n").alias("n_docs"))
    )


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per distinct length: docs and tokens at or above it, docs below, and the truncated total.

    truncated_tokens is what remains of the corpus if each text is cut to ``length`` ids. Sums run
    within blocks of 4096 lengths and over the blocks' totals, so the work of a task is bounded. The
    histogram is written first: both sums read it, and the texts behind it are encoded once.
    """
    h = written(histogram.select("length", "n_docs"), "lengths").select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens")).withColumn(
        "block", F.floor(F.col("length") / BLOCK)
    )
    down = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("n"), F.sum("tokens").alias("t"))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("n").over(down), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("t").over(down), F.lit(0)).alias("t_above"),
        F.sum("n").over(Window.partitionBy()).alias("all_docs"),
        F.sum("t").over(Window.partitionBy()).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("length").desc())
    return (
        h.select("*", F.sum("n_docs").over(inside).alias("n_in"), F.sum("tokens").over(inside).alias("t_in"))
        .join(blocks, "block")
        .select(
            "length",
            "n_docs",
            (F.col("n_in") + F.col("n_above")).alias("docs_at_least"),
            (F.col("t_in") + F.col("t_above")).alias("tokens_at_least"),
            "all_docs",
            "all_tokens",
        )
        .select(
            "length",
            "n_docs",
            "docs_at_least",
            "tokens_at_least",
            (F.col("all_docs") - F.col("docs_at_least")).alias("docs_below"),
            (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias(
                "truncated_tokens"
            ),
        )
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """For each limit: docs longer than it, tokens kept after cutting, tokens cut off.

    One row per limit and task is shuffled. An empty table or list gives no row.
    """
    if not limits:
        return sums.sparkSession.createDataFrame([], "limit long, docs_cut long, tokens_kept long, tokens_cut long")
    asked = sums.select("length", "n_docs", F.explode(F.array(*[F.lit(int(x)) for x in set(limits)]).cast("array<long>")).alias("limit"))
    kept = F.least("length", "limit") * F.col("n_docs")
    return asked.groupBy("limit").agg(
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
        F.sum(kept).alias("tokens_kept"),
        F.sum(F.col("length") * F.col("n_docs") - kept).alias("tokens_cut"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the least length that at least ``share`` of the documents do not exceed."""
    upto = F.col("docs_below") + F.col("n_docs")
    total = F.col("docs_below") + F.col("docs_at_least")
    picks = [F.min(F.when(upto >= F.lit(float(q)) * total, F.col("length"))).alias(f"q{i}") for i, q in enumerate(shares)]
    row = sums.agg(*picks)
    return row.select(
        F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length"))
                            for i, q in enumerate(shares)])).alias("r")
    ).select("r.*")
