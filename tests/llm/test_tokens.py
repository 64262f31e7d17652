import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm.bpe import default_path, encoder
from tidemark.llm.packing import Capacity, pack, plan
from tidemark.llm.token_counts import at_limits, length_histogram, quantiles, suffix_sums

SIGNS = ["'s", "'re", "'ll", "'", "a", "B", "é", " ", "  ", "\n", "\t", "1", "²", "½", "!", "-", "don't", " '", "''", "日本", "ß",
         "\x85", "<|endoftext|>", "😀", "’", "\x1c", "　", "İ", "ª", "́", "한"]


def ids_of(text):
    return encoder(default_path()).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + ["", "word " * 300_000]
    ids, counts = encoder(default_path()).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == ids_of(text)
        at += n
    assert at == len(ids)


ROWS = [(1, "a b c"), (2, None), (3, ""), (4, "tokens " * 90), (4, "tokens " * 90), (None, "x"), (6, "don't 1234 stop " * 20), (7, "z " * 33)]


def test_packing_round_trip(frame):
    cap = Capacity(tokens=64, documents=5, attention=64 * 64)
    rows = pack(frame(ROWS, "doc_id long, text string"), cap, with_ids=True).collect()
    whole, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) <= 64
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        whole[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for doc_id, text in {(d, t) for d, t in ROWS}:
        want = [*ids_of(text), 0]
        copies = ROWS.count((doc_id, text))
        for piece in sorted({r["piece"] for r in whole[doc_id]}):
            own = [r for r in whole[doc_id] if r["piece"] == piece]
            assert len(own) == copies
            assert all(r["ids"] == want[r["start"] : r["start"] + r["length"]] for r in own)
            assert piece == 0 or own[0]["length"] == 64
        assert sum(r["length"] for r in whole[doc_id]) == len(want) * copies
    for own in bins.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) <= 64 and len(own) <= 5
        assert sum(r["length"] ** 2 for r in own) <= 64 * 64


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_holds_every_capacity(rule):
    rnd = random.Random(3)
    histogram = {rnd.randint(1, 100): rnd.randint(1, 500) for _ in range(60)}
    cap = Capacity(tokens=100, documents=7, attention=10_000)
    runs = plan(histogram, cap, (1.0, 0.5, 2.0), rule)
    used = defaultdict(list)
    seen = defaultdict(int)
    for length, rank, n, first, offset in zip(*(runs[k].tolist() for k in ("length", "rank", "n", "bin", "offset"))):
        assert rank == seen[length]
        seen[length] += n
        for b in range(first, first + n):
            assert sum(used[b]) == offset
            used[b].append(length)
    assert seen == histogram and len(used) == runs["bins"]
    assert all(sum(u) <= 100 and len(u) <= 7 for u in used.values())
    least = -(-sum(k * v for k, v in histogram.items()) // 100)
    if rule == "norm":
        assert runs["bins"] <= max(1.15 * least, -(-sum(histogram.values()) // 7) + 1)


def test_attention_binds(frame):
    cap = Capacity(tokens=64, documents=50, attention=900)
    rows = pack(frame(ROWS, "doc_id long, text string"), cap, with_ids=True).collect()
    bins, whole = defaultdict(list), defaultdict(int)
    for r in rows:
        bins[r["sequence_id"]].append(r["length"])
        whole[r["doc_id"]] += r["length"]
    assert max(map(max, bins.values())) == cap.longest == 30
    assert all(sum(x * x for x in own) <= 900 and sum(own) <= 64 for own in bins.values())
    assert any(sum(own) + 1 <= 64 and sum(x * x for x in own) + 1 > 900 for own in bins.values())
    want = defaultdict(int)
    for d, t in ROWS:
        want[d] += len(ids_of(t)) + 1
    assert whole == want


def test_packing_of_an_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_length_histogram_and_answers(frame, spark):
    df = frame(ROWS, "doc_id long, text string")
    lengths = sorted(len(ids_of(t)) for _, t in ROWS)
    sums = suffix_sums(length_histogram(df)).collect()
    assert sorted(r["length"] for r in sums) == sorted(set(lengths))
    for r in sums:
        n = r["length"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_at_least"] == sum(x >= n for x in lengths) and r["docs_below"] == sum(x < n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
    table = spark.createDataFrame(sums)
    for r in at_limits(table, [1, 8, 50, 10**6]).collect():
        assert r["docs_cut"] == sum(x > r["limit"] for x in lengths)
        assert r["tokens_kept"] == sum(min(x, r["limit"]) for x in lengths)
        assert r["tokens_cut"] == sum(lengths) - r["tokens_kept"]
    for r in quantiles(table, [0.0, 0.5, 0.9, 1.0]).collect():
        assert r["length"] == next(x for i, x in enumerate(lengths) if i + 1 >= r["share"] * len(lengths))
    assert suffix_sums(length_histogram(df.limit(0))).count() == 0
    plan = suffix_sums(length_histogram(df))._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan  # texts are encoded once, before


def test_suffix_sums_across_blocks(spark):
    rows = [(n, n % 7 + 1) for n in range(0, 30_000, 611)]
    for r in suffix_sums(spark.createDataFrame(rows, "length long, n_docs long")).collect():
        assert r["docs_at_least"] == sum(c for n, c in rows if n >= r["length"])
        assert r["tokens_at_least"] == sum(n * c for n, c in rows if n >= r["length"])
