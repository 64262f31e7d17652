"""Toxicity by class-conditional Kneser-Ney models with shared backoff counts.

A word is an expression of two symbols: its prefix (four letters) and the word given the prefix.
Each class has absolute-discounting counts of both:

    P_c(w) = P_c(prefix) * P_c(w | prefix)
    P_c(x | u) = max(n_c(ux) - D, 0) / n_c(u) + D * t_c(u) / n_c(u) * P(x | u)

n are counts, t distinct continuations. P, to which both classes back off, is shared and comes
from all documents, labelled or not: for prefixes the continuation count (distinct words with
that prefix), for words one over these. So an expression that a class has rarely or never seen is
judged by counts that both share, and a form of a known stem by its stem.

A text is scored by the toxic minus the ordinary log-likelihood, normalised by length: per word of
the whole text, per word of its three most toxic ones, and the excess per root of its length.
A logistic curve over the three, fitted on labelled rows that gave no counts, makes a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .letters import chunks, letter_words
from .storage import written

PREFIX = 4
DISCOUNT = 0.75
EXCESS = 3.0
MAX_LABELLED = 100_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4


def fold() -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int")


@dataclass(frozen=True)
class Model:
    """Tables of all words and prefixes of the labelled sample: sorted hashes and their values."""

    words: np.ndarray
    word_value: np.ndarray  # toxic minus ordinary log-likelihood of the word
    prefixes: np.ndarray
    prefix_value: np.ndarray  # the same for an unseen word with this prefix
    unseen: float
    curve: tuple[float, ...]  # logistic weights of the three measures, then the constant

    def evidence(self, word: np.ndarray, head: np.ndarray) -> np.ndarray:
        word, at, back = np.unique(word, return_index=True, return_inverse=True)
        head, of = np.unique(head[at], return_inverse=True)
        stem = _looked_up(self.prefixes, self.prefix_value, head, np.float32(self.unseen))
        return _looked_up(self.words, self.word_value, word, stem[of])[back]

    def score(self, measures: np.ndarray) -> np.ndarray:
        z = measures @ np.array(self.curve[:3]) + self.curve[3]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, other) -> np.ndarray:
    """The value of each asked key, ``other`` where the sorted keys do not hold it."""
    if not len(keys):
        return np.broadcast_to(other, asked.shape)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], other)


def _counts(labelled: bool):
    """Per batch: each distinct word, with its counts in toxic and ordinary texts if labelled."""

    def go(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            toxic = np.array(batch.column("toxic").to_pylist(), np.int64) if labelled else None
            for first, last, cp, offsets in chunks(texts):
                _, _, _, word, head, heads = letter_words(cp, offsets, PREFIX)
                if not len(word):
                    continue
                unique, at, inverse, n = np.unique(word, return_index=True, return_inverse=True, return_counts=True)
                columns = [pa.array(unique.view(np.int64)), pa.array(head[at].view(np.int64))]
                if labelled:
                    bad = np.repeat(toxic[first:last], np.diff(heads))
                    t = np.bincount(inverse, bad, len(unique)).astype(np.int64)
                    columns += [pa.array(t), pa.array(n - t)]
                yield pa.RecordBatch.from_arrays(columns, names=["w", "p", "t", "o"][: len(columns)])

    return go


def _measures(model: Model, word, head, heads) -> np.ndarray:
    """Per text: mean evidence, mean of its three largest (0 at least), excess per root of length."""
    e = model.evidence(word, head).astype(np.float64)
    n = np.diff(heads)
    size = np.maximum(n, 1)
    total = np.concatenate([[0], np.cumsum(e)])
    over = np.concatenate([[0], np.cumsum(np.maximum(e - EXCESS, 0))])
    strong = np.flatnonzero(e > 0)
    row = np.searchsorted(heads, strong, "right") - 1
    order = np.lexsort((-e[strong], row))
    row, value = row[order], e[strong][order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    top = np.bincount(row[rank < 3], value[rank < 3], len(n)) / 3
    return np.stack(
        [(total[heads[1:]] - total[heads[:-1]]) / size, top, (over[heads[1:]] - over[heads[:-1]]) / np.sqrt(size)], 1
    )


def _scores(shared, with_text: bool):
    def go(batches):
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out = [np.zeros((0, 3))]
            for _, _, cp, offsets in chunks(texts):
                _, _, _, word, head, heads = letter_words(cp, offsets, PREFIX)
                out.append(_measures(model, word, head, heads))
            m = np.concatenate(out)
            names = [c for c in batch.schema.names if with_text or c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(model.score(m)), *(pa.array(m[:, i].copy()) for i in range(3))],
                names=[*names, "score", "per_word", "top", "excess"],
            )

    return go


def _log_ratio(n, unit, share):
    """log P_toxic - log P_ordinary of a symbol: counts n, contexts unit = (n, types), shared share."""

    def p(k):
        total, types = unit[k]
        smooth = F.greatest(n[k] - DISCOUNT, F.lit(0.0)) / total + DISCOUNT * types / total * share
        return F.when(total > 0, smooth).otherwise(share)

    return F.log(p(0)) - F.log(p(1))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the labelled rows of ``docs`` outside fold 0.

    Class counts come from at most ``max_labelled`` labelled rows (those whose id hash is least),
    so that their ids fit in a broadcast; counts of the shared distribution come from every text.
    The tables hold every word of these labelled texts (12 bytes each; about a million words for
    100,000 texts of the given kind). Several labels of one id: the largest counts.
    """
    spark = docs.sparkSession
    y = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(fold() != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    y = F.broadcast(written(y, "labels"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = texts.join(y, "doc_id")
    known = (
        train.where(fold() != CALIBRATION).select("text", "toxic")
        .mapInArrow(_counts(True), "w long, p long, t long, o long")
        .groupBy("w").agg(F.first("p").alias("p"), F.sum("t").alias("t"), F.sum("o").alias("o"))
    )
    known = written(known, "words")
    types = written(
        texts.select("text").mapInArrow(_counts(False), "w long, p long")
        .distinct().groupBy("p").agg(F.count("*").alias("types")),
        "types",
    )
    all_types = types.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    heads = written(
        known.groupBy("p").agg(
            F.sum("t").alias("pt"), F.sum("o").alias("po"),
            F.sum((F.col("t") > 0).cast("long")).alias("tt"), F.sum((F.col("o") > 0).cast("long")).alias("to"),
        ).join(types, "p"),
        "prefixes",
    )
    n_t, n_o, t_t, t_o = heads.agg(
        F.coalesce(F.sum("pt"), F.lit(0)), F.coalesce(F.sum("po"), F.lit(0)),
        F.coalesce(F.sum((F.col("pt") > 0).cast("long")), F.lit(0)),
        F.coalesce(F.sum((F.col("po") > 0).cast("long")), F.lit(0)),
    ).first()
    calibration = train.where(fold() == CALIBRATION)
    if not n_t or not n_o:  # one class only: nothing to compare, the share of toxic labels is the score
        a, b = train.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
        return _empty((0.0, 0.0, 0.0, math.log((a + 1) / (b - a + 1))))
    unit = [(F.lit(n_t), F.lit(t_t)), (F.lit(n_o), F.lit(t_o))]
    heads = heads.withColumn(
        "head", _log_ratio((F.col("pt"), F.col("po")), unit, F.col("types") / F.lit(all_types))
    )
    inside = [(F.col("pt"), F.col("tt")), (F.col("po"), F.col("to"))]
    new = 1 / (F.col("types") + 1)
    unseen = math.log(t_t / n_t) - math.log(t_o / n_o)
    prefixes = heads.select(
        F.col("p").alias("h"), (F.col("head") + _log_ratio((F.lit(0), F.lit(0)), inside, new)).alias("value")
    )
    seen = known.join(heads, "p").select(
        F.col("w").alias("h"), (F.col("head") + _log_ratio((F.col("t"), F.col("o")), inside, new)).alias("value")
    )
    tables = (*_table(seen), *_table(prefixes), unseen)
    model = Model(*tables, (0.0, 1.0, 0.0, 0.0))
    rows = apply(calibration, model, "toxic").select("toxic", "per_word", "top", "excess").toPandas()
    curve = _logistic(rows[["per_word", "top", "excess"]].to_numpy(float), rows["toxic"].to_numpy(float))
    return Model(*tables, curve)


def _empty(curve) -> Model:
    keys, values = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    return Model(keys, values, keys, values, 0.0, curve)


def _table(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and values of all entries; these come from the labelled sample only."""
    rows = entries.select("h", F.col("value").cast("float").alias("value")).toArrow()
    h = rows.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], rows.column("value").to_numpy()[order]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights and constant by Newton steps, with a small penalty on standardised measures."""
    if len(y) == 0 or y.min() == y.max():
        return (0.0, 1.0, 0.0, -EXCESS)  # no calibration rows of both classes: top evidence above EXCESS
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    penalty = np.diag([0.1] * (z.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
        step *= min(1.0, 4 / max(1e-12, np.abs(step).max()))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    own = w[:-1] / scale
    return (*own.tolist(), float(w[-1] - (own * mean).sum()))


def apply(docs: DataFrame, model: Model, *keep: str, with_text: bool = False) -> DataFrame:
    """doc_id, ``keep``, (text,) score (0 to 1) and the three measures of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the labelled sample: see fit
    kinds = dict(docs.dtypes)
    schema = ", ".join(["doc_id long", *(f"{k} {kinds[k]}" for k in keep), *(["text string"] if with_text else [])])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("text")).mapInArrow(
        _scores(shared, with_text), schema + ", score double, per_word double, top double, excess double"
    )


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.5) for every row of ``docs``.

    Only text is scored. Null and empty texts have no evidence and get the curve's value at zero. A
    null id is not held out. Repeated rows get equal scores; without labels of both classes
    every score is the smoothed share of toxic labels.
    """
    model = fit(docs, labels, max_labelled)
    return apply(docs, model).select(
        "doc_id",
        F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
