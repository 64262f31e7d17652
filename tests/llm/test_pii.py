import hashlib
import itertools
import random
import re

import numpy as np

from tidemark.llm import pii
from tidemark.llm.pii import KINDS, base_spans, personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 13 <= len(d) <= 19 and pii.luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_plain_patterns():
    rnd = random.Random(1)
    bits = ["1", "23", "456", "255", "4539578763621486", "4539 5787 6362 1486", ".", "..", " ", "-", "@", "a", "b.c", "é", "+", "+1", "(", ")", "\n", "x@y.z", "%", "٣"]
    for _ in range(20_000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert base_spans(text) == plain(text), text
    long = "1" * 20_000 + " a" * 1000 + "@" * 500 + "x@y.z"
    assert base_spans(long) == plain(long)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    k = len(pii.LABELS)
    emit = rng.standard_normal((pii.FEATURES, k))
    field = pii.Field(emit, rng.standard_normal((k + 1, k)) + pii._allowed())
    for n in (1, 2, 4):
        x = rng.integers(0, pii.FEATURES, (n, 8))
        e = emit[x].sum(1)

        def score(path):
            return e[range(n), path].sum() + field.move[k, path[0]] + sum(field.move[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product(range(k), repeat=n), key=lambda p: score(list(p)))
        assert field.decode([x, x[:1]])[0].tolist() == list(best)


def test_field_learns_and_adds(frame, spark):
    rnd = random.Random(3)
    docs = []
    for i in range(150):
        phone = f"+1 ({rnd.randint(200, 999)}) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"
        mail = f"user{rnd.randint(1, 99)}@mail{i % 7}.example.com"
        docs.append((i, f"call me {phone} or write {mail} from {rnd.randint(1, 250)}.{rnd.randint(1, 250)}.3.4 in {rnd.randint(1900, 2020)} ok"))
    docs += [(500, None), (501, ""), (None, docs[0][1]), docs[1], (502, "call me (415) 555-2671 x or 8.8.8.8 " * 3), (503, "ID 12 " * 30_000)]
    got = personal_data(frame(docs, "doc_id long, text string")).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        base = plain(texts[r["doc_id"]] or "")
        spell = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(spell.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[0] == k for x in base) for k in KINDS]
        assert set(filter(None, spell.split(","))) <= set(filter(None, r["spans"].split(",")))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[500]["spans"] == by_id[501]["spans"] == by_id[503]["spans"] == ""
    assert personal_data(frame(docs, "doc_id long, text string").limit(0)).count() == 0


def test_training_fits_its_table(spark):
    texts = [f"tel +1 (555) 123-{n} and a{n}@b.com then {n}" for n in range(1000, 1200)]
    table = pii.labelled_runs(spark.createDataFrame([(t,) for t in texts], "text string"))
    model = pii.fit(table)
    rows = [(r["tokens"], r["labels"]) for r in table.collect()]
    paths = model.decode([pii.features(t) for t, _ in rows])
    right = sum(p.tolist() == list(l) for p, (_, l) in zip(paths, rows))
    assert right >= 0.95 * len(rows)
