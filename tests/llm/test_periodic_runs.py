import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF

from tidemark.llm import periodic_runs
from tidemark.llm.queries import QUERIES


def brute(words, shortest=24, repeats=3):
    """Every maximal stretch at every lag, compared word by word; the least lag of a stretch is its period."""
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def random_words(rnd):
    words, k = [], rnd.choice([1, 2, 3, 5, 30])
    for _ in range(rnd.randint(0, 8)):
        kind = rnd.random()
        if kind < 0.5:
            block = [rnd.randrange(k) for _ in range(rnd.randint(1, 12))]
            words += block * rnd.randint(1, 8) + block[: rnd.randint(0, len(block))]
        elif kind < 0.8:
            words += [rnd.randrange(k) for _ in range(rnd.randint(0, 30))]
        elif words:
            words += words[rnd.randrange(len(words)) :] * rnd.randint(1, 4)
    return words[:300]


@pytest.mark.parametrize("shortest,repeats", [(24, 3), (6, 3), (4, 2), (3, 3), (7, 4)])
def test_runs_are_those_of_brute_force(shortest, repeats):
    rnd = random.Random(shortest)
    for _ in range(150):
        docs = [random_words(rnd) for _ in range(rnd.randint(1, 6))]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        ids = np.array([w for d in docs for w in d], np.int64)
        want = [(a + o, a + n + o, q) for d, o in zip(docs, offsets.tolist()) for a, n, q in brute(d, shortest, repeats)]
        assert list(map(tuple, periodic_runs.find(ids, offsets, shortest, repeats).tolist())) == want


def test_rare_words_split_until_stable():
    ids = np.array([1, 2] * 15 + [9] + [1, 2] * 15 + [3] + [4, 4] + list(range(100, 140)))
    s, e = periodic_runs.segments(ids, np.array([0, len(ids)]), 24, 3)
    assert list(zip(s.tolist(), e.tolist())) == [(0, 30), (31, 61)]
    # 7 occurs three times in the text, but not within the parts that 8 leaves
    ids = np.array([7] + [1] * 30 + [7, 7] + [8] + [1] * 23 + [5])
    s, e = periodic_runs.segments(ids, np.array([0, len(ids)]), 24, 3)
    assert list(zip(s.tolist(), e.tolist())) == [(0, 33)]


def test_misleading_hashes_change_nothing(monkeypatch):
    morse = np.array([bin(i).count("1") & 1 for i in range(4096)], np.int64)
    ids = np.concatenate([morse, morse, morse, [5], np.tile([1, 2, 3], 12)])
    want = [(0, 12288, 4096), (12289, 12325, 3)]
    assert list(map(tuple, periodic_runs.find(ids, np.array([0, len(ids)])).tolist())) == want
    monkeypatch.setattr(periodic_runs._Spans, "equal", lambda self, at, lag, size: np.ones(len(at), bool))
    assert list(map(tuple, periodic_runs.find(ids[-100:], np.array([0, 100])).tolist())) == [(64, 100, 3)]


def test_long_runs_cost_little():
    for ids in (np.zeros(300_000, np.int64), np.random.default_rng(1).integers(0, 50, 300_000), np.tile(np.arange(70_000), 4)):
        found = periodic_runs.find(ids, np.array([0, len(ids)]))
        assert len(found) == (0 if len(np.unique(ids)) == 50 else 1)


def test_edges(frame):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 24), (4, "a " * 24), (None, "b\x0bc " * 13), (5, "a " * 23), (6, "x y " * 40 + "z " * 30),
            (7, "é à ß " * 9 + "一 " * 24)]
    found = periodic_runs.periodic_runs(frame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    want = {(d, t): brute(words_of(t)) for d, t in rows}
    seen = {d: [tuple(r) for r in runs] for d, runs in ((r.doc_id, r.runs) for r in found)}
    for (d, t), runs in want.items():
        assert seen[d] == runs
        for r in found:
            if r.doc_id == d:
                assert r.n_words == len(words_of(t)) and r.collapsed == collapse(words_of(t), runs)
    six = next(r for r in found if r.doc_id == 6)
    assert [tuple(r) for r in six.runs] == [(0, 80, 2), (80, 30, 1)] and tuple(six.best) == (0, 80, 2)
    assert periodic_runs.periodic_runs(frame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(frame(rows, "doc_id long, text string"), repeats=1)


def test_query_against_plain_python(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(words_of(r.text)) < 800}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    checked = planted = 0
    for r in QUERIES["op11_periodic_runs"](spark, SF).collect():
        if r.doc_id not in docs:
            continue
        words = words_of(docs[r.doc_id])
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        runs = brute(words)
        assert (r.n_runs, r.runs_sha256) == (len(runs), sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)))
        assert r.collapsed_sha256 == sha(collapse(words, runs))
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
        checked += 1
    assert checked > 100 and planted > 5
