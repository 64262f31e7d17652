import random
import zlib

from tidemark.llm.toxicity import toxicity

BAD = [f"vile{x}" for x in ("an", "ish", "or", "est", "ly")]


def corpus(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for d in range(n):
        words = ["".join(rnd.choice(["ta", "re", "mo", "li", "su", "en"]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(BAD).upper())
        docs.append((d, " ".join(words)))
        labels.append((d, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_what_is_read(frame):
    docs, labels = corpus(400, 1)
    truth = {d: t for d, _, t in labels}
    rows = docs + [(1000, None), (1001, ""), (None, docs[3][1]), docs[5]]
    df, y = frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, quality int, toxic int")
    got = toxicity(df, y).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    # Labels of held-out rows change nothing.
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    again = toxicity(df, frame(flipped, "doc_id long, quality int, toxic int")).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["score"])
    assert [key(r) for r in sorted(again, key=key)] == [key(r) for r in sorted(got, key=key)]


def test_without_both_classes(frame, spark):
    docs, labels = corpus(30, 2)
    df = frame(docs, "doc_id long, text string")
    none = toxicity(df, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r["score"] for r in none} == {0.5}
    one = toxicity(df, frame([(d, 0) for d, _, _ in labels] + [(None, 1), (4, None)], "doc_id long, toxic int")).collect()
    assert all(r["score"] < 0.5 for r in one)
    assert toxicity(df.limit(0), spark.createDataFrame(labels, "doc_id long, q int, toxic int")).count() == 0
