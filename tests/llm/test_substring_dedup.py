import hashlib
import random
import re

import pytest

from tidemark.llm.substring_dedup import remove_repeats


def brute(rows, k):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, w in words:
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            first[key] = min(first.get(key, (order(d), i)), (order(d), i))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (order(d), i):
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, k, m):
    found = remove_repeats(df, k, m, with_text=True)
    rows = found.collect()
    for r in rows:
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
        assert sum(b - a for a, b in zip(r["ranges"][::2], r["ranges"][1::2])) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


@pytest.mark.parametrize("k,m", [(4, 2), (3, 1), (5, 5), (20, 6)])
def test_against_brute_force(frame, k, m):
    rnd = random.Random(k)
    rows = []
    for d in range(40):
        n = rnd.choice([0, 2, k, 30, 120])
        words = [rnd.choice("ab" if d % 3 else "abcdefgh") + rnd.choice(["", "é"]) for _ in range(n)]
        rows.append((d, rnd.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100 + i, rows[7][1]) for i in range(5)]  # copies
    rows += [(200, "x " + rows[9][1] + " y"), (201, " ".join(["z"] * 90)), (202, None), (203, ""), (None, rows[9][1]), (7, rows[7][1])]
    assert run(frame(rows, "doc_id long, text string"), k, m) == brute(rows, k)


def test_long_text_and_empty_table(frame, spark):
    rnd = random.Random(1)
    long = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(400_000))  # more than one chunk of bytes
    rows = [(2, long), (1, " ".join(long.split()[100_000:100_100]))]
    assert run(frame(rows, "doc_id long, text string"), 20, 6) == brute(rows, 20)
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_repeated_whole_list_their_runs_once(frame):
    rnd = random.Random(5)
    text = " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(200))
    rows = [(1, text)] + [(2, text + " end")] * 150 + [(None, "x " + text)] * 150
    assert run(frame(rows, "doc_id long, text string"), 20, 6) == brute(rows, 20)
