import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fill_in_middle
from tidemark.llm.fill_in_middle import Bitmap, BoundarySet, Runs, Values


def test_select_in_every_container():
    rng = np.random.default_rng(1)
    sparse = np.sort(rng.choice(1 << 16, 900, replace=False))
    dense = np.sort(rng.choice(1 << 16, 40_000, replace=False)) + (3 << 16)
    runs = np.concatenate([np.arange(100, 30_000), np.arange(31_000, 65_536)]) + (7 << 16)
    whole = np.arange(1 << 16) + (9 << 16)
    found = BoundarySet(np.concatenate([sparse, dense, runs, whole]))
    assert [type(c) for c in found.containers] == [Values, Bitmap, Runs, Runs]
    every = np.concatenate([sparse, dense, runs, whole])
    assert len(found) == len(every)
    ranks = rng.permutation(len(every))
    assert np.array_equal(found.select(ranks), every[ranks])
    assert found.select(np.zeros(0, np.int64)).tolist() == [] and len(BoundarySet(np.zeros(0, np.int64))) == 0


def test_units():
    for text in ("", "a", "ab c", "é1ab  [Zz]`{@", "日本ab日", "\n\nA"):
        cp = np.array([ord(c) for c in text], np.uint32)
        want = [m.start() for m in re.finditer(r"(?s)[A-Za-z]+|[^A-Za-z]", text)]
        assert fill_in_middle.boundaries(cp, np.array([0, len(cp)])).tolist() == want


TEXTS = ["one two three", "é😀ab " * 300, "x", "1234567890" * 9000, "has <S> in it", "<P", "a<", "S>b", "<M>", "\n\t ", "word " * 30_000]


def test_round_trip_and_edges(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS * 12)] + [(500, None), (501, ""), (None, "null id"), (1, TEXTS[1]), (1, TEXTS[1])]
    for options in ({}, {"plain": 0, "spm": 100}, {"plain": 0, "spm": 0}, {"plain": 100}):
        out = fill_in_middle.transform(frame(rows, "doc_id long, text string"), **options)
        found = out.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()
        assert len(found) == len(rows)
        text_of = {d: t or "" for d, t in rows}
        for r in found:
            text = text_of[r.doc_id]
            assert r.back == text and r.n == len(re.findall(r"(?s)[A-Za-z]+|[^A-Za-z]", text))
            marked = text == "" or any(m in text for m in ("<P>", "<S>", "<M>"))
            if r.form == "plain":
                assert (r.prefix_chars, r.middle_chars, r.output) == (None, None, text)
            else:
                assert not marked
                a, b = r.prefix_chars, r.prefix_chars + r.middle_chars
                parts = {"psm": f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", "spm": f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"}
                assert r.output == parts[r.form]
                starts = {m.start() for m in re.finditer(r"(?s)[A-Za-z]+|[^A-Za-z]", text)} | {len(text)}
                assert {a, b} <= starts
        forms = {r.form for r in found}
        assert forms == {(): {"plain", "psm", "spm"}, (0, 100): {"plain", "spm"}, (0, 0): {"plain", "psm"}, (100,): {"plain"}}[tuple(options.values())]
    assert fill_in_middle.transform(frame([], "doc_id long, text string")).count() == 0
