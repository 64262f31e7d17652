import random
import time

import numpy as np
import pytest

from tidemark.llm.decontamination import Q, RATE, _find, _Items, _items, decontaminate, fold_text, matches, threshold


def sellers(item: str, text: str) -> int:
    """Least edits of the whole item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def edited(rnd, text, edits):
    chars = list(text)
    for _ in range(edits):
        i = rnd.randrange(len(chars))
        how = rnd.random()
        if how < 0.4:
            chars[i] = rnd.choice("xyz")
        elif how < 0.7:
            del chars[i]
        else:
            chars.insert(i, rnd.choice("xyz"))
    return "".join(chars)


def test_against_full_alignment(frame, spark):
    rnd = random.Random(4)
    bench = [(i, words(rnd, rnd.randint(14, 30)).capitalize() + ".") for i in range(6)] + [(90, None), (91, ""), (92, "abc"), (3, None)]
    docs = []
    for d in range(60):
        item = bench[d % 6][1]
        inside = edited(rnd, item, int(rnd.choice([0, 0.03, 0.08, 0.12, 0.3]) * len(item)))
        docs.append((d, f"{words(rnd, 20)}  {inside.upper() if d % 2 else inside}\n-- {words(rnd, 10)}"))
    docs += [(100, None), (101, ""), (None, bench[0][1]), (102, bench[1][1] + " " + bench[1][1]), (102, bench[1][1] + " " + bench[1][1]),
             (103, "é" + bench[2][1].replace(" ", "\n\n"))]
    df, b = frame(docs, "doc_id long, text string"), frame(bench, "item_id long, text string")
    got = matches(df, b).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    want = set()
    for d, text in docs:
        for i, item in bench:
            f = fold_text(item or "")
            if len(f) >= 8 and sellers(f, fold_text(text or "")) <= int(RATE * len(f)):
                want.add((d, i))
    assert found == want and len(want) > 30
    texts = dict(docs)
    for r in got:
        part = fold_text(texts[r["doc_id"]][r["start"] : r["end"]])
        assert r["distance"] >= sellers(fold_text(dict(bench[:6])[r["item_id"]]), part) and r["distance"] <= RATE * r["item_length"]
    assert sum(r["doc_id"] == 102 for r in got) == 4
    kept = decontaminate(df, b)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in {x for x, _ in want})
    assert matches(df, b.limit(0)).count() == 0 and matches(df.limit(0), b).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_no_match_escapes_the_bands(seed):
    rnd = random.Random(seed)
    item = fold_text(words(rnd, 25))
    items = _Items([(1, item)], 8, RATE)
    k = int(RATE * len(item))
    assert threshold(len(item), k, 8) >= 1
    for edits in range(0, k + 1, 3):
        text = fold_text(words(rnd, 300)) + " " + edited(rnd, item, edits) + " " + fold_text(words(rnd, 50))
        codes = np.array([ord(c) for c in text], np.uint32)
        hits = [items.verify(codes.astype(np.int64), i, d) for _, i, d in items.bands(codes, np.array([0, len(codes)]))]
        assert any(h is not None and h[0] <= edits for h in hits)


@pytest.mark.parametrize("hits,together", [(1 << 21, 1 << 13), (500, 64)])
def test_items_with_a_common_stem_and_short_items(monkeypatch, hits, together):
    monkeypatch.setattr("tidemark.llm.decontamination.HITS", hits)
    monkeypatch.setattr("tidemark.llm.decontamination.TOGETHER", together)
    rnd = random.Random(8)
    stem = "which of these statements best describes the"
    bench = [(i, fold_text(f"{stem} {words(rnd, rnd.randint(2, 16))}")) for i in range(70)]
    bench += [(200 + n, fold_text(words(rnd, 12))[:n].strip()) for n in range(8, 40, 3)]
    bench += [(300, "ab"), (301, "x"), (302, "fig cab")]
    texts = [" ".join(f"{stem} {words(rnd, 3)}" for _ in range(12)), "a fig cab ab. figs cabs xx", "x", "abx fig cabs", "", " -- "]
    texts += [f"{words(rnd, 4)} {edited(rnd, t, rnd.randint(0, int(0.15 * len(t))))} {stem} {words(rnd, 4)}" for i, t in bench[::5] if i < 300]
    got = {(row, item) for row, item, *_ in _find(_items(tuple(bench), Q, RATE), texts, Q)}
    want = set()
    for row, text in enumerate(map(fold_text, texts)):
        for i, item in bench:
            if f" {item} " in f" {text} " if len(item) < Q else sellers(item, text) <= int(RATE * len(item)):
                want.add((row, i))
    assert got == want and {(1, 300), (1, 302), (2, 301)} <= got and len(got) > 12


def test_many_places_of_a_stem_take_linear_time():
    rnd = random.Random(9)
    stem = "which of these statements best describes the law"
    bench = tuple((i, fold_text(f"{stem} {words(rnd, 10)}")) for i in range(1500))
    items = _items(bench, Q, RATE)
    text = " ".join(f"{stem} {words(rnd, 2)}" for _ in range(50))
    begin = time.perf_counter()
    assert [m[:2] for m in _find(items, [f"{text} {bench[7][1]}"], Q)] == [(0, 7)]
    assert time.perf_counter() - begin < 20  # 37 s when every place was tried alone
