import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from conftest import SF

from tidemark.llm import piece_encoding
from tidemark.llm.queries import QUERIES

SIGNS = ["a", "e", "th", "in", " ", "  ", "   ", "\n", "\t", "1", "é", "ß", "日本", "😀", "▁", "▁▁", "\x00", "<s>", "<0x41>", "</s>",
         "İ", "́", "한", "ing", "tion", "�", "x" * 7, " " * 17]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_encoding.default_path())


@pytest.fixture(scope="module")
def own():
    return piece_encoding.pieces(piece_encoding.default_path())


def rows(ids, counts):
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def texts(library, n, seed):
    rnd = random.Random(seed)
    names = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.get_piece_size())]
    kinds = [
        lambda: "".join(rnd.choices(SIGNS, k=rnd.randint(0, 40))),
        lambda: "".join(rnd.choices(names, k=rnd.randint(0, 20))),
        lambda: "".join(rnd.choices("etaoinshrdlu ", k=rnd.randint(0, 200))),
        lambda: "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x80, 0x3000), rnd.randrange(0x1F300, 0x1FAFF)])) for _ in range(40)),
        lambda: " " * rnd.randint(0, 70) + rnd.choice(names) + " " * rnd.randint(0, 40),
    ]
    return [rnd.choice(kinds)() for _ in range(n)]


def test_ids_and_text_are_the_librarys(own, library):
    made = ["", " ", "a", *texts(library, 6000, 1)]
    ids, counts = own.encode(made)
    want = library.encode(made, add_eos=True)
    assert rows(ids, counts) == want
    assert own.decode(ids, counts) == library.decode(want)


def test_long_words(own, library):
    rnd = random.Random(2)
    for text in ("a" * 200_000, " " * 50_000, "".join(rnd.choices("etaoinshrdlu", k=30_000)), "ab" * 50_000, "中文" * 20_000):
        assert own.encode([text])[0].tolist() == library.encode(text, add_eos=True)


def test_decode_of_any_ids(own, library):
    rnd = random.Random(3)
    for _ in range(2000):
        row = [rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), rnd.randrange(3), rnd.randrange(259, 300)]) for _ in range(rnd.randint(1, 12))]
        assert own.decode(np.array(row), np.array([len(row)])) == library.decode([row]), row


def test_forgetting_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(piece_encoding, "CACHE", 50)
    made = texts(library, 200, 4)
    for k in range(0, 200, 20):
        assert rows(*own.encode(made[k : k + 20])) == library.encode(made[k : k + 20], add_eos=True)


def test_ranks_of_one_score_and_symbols_without_a_piece(library):
    """A small vocabulary in which a new symbol outranks the merge that made it."""
    own = piece_encoding.Pieces(piece_encoding.default_path())
    names = {"a": 10, "b": 11, "c": 12, "bc": 13, "abc": 14, "ca": 15}
    score = {13: 5, 14: 1, 15: 5}  # rank: abc first, bc and ca share one
    pairs = sorted((names[n[:k]], names[n[k:]], names[n], score[names[n]]) for n in ("bc", "abc", "ca") for k in range(1, len(n)) if n[:k] in names and n[k:] in names)
    left, right, own.made, own.rank = np.array(pairs, np.int64).T.copy()
    own.keys = left * own.width + right
    own._slots()
    for shared in (False, True):
        own.shared = np.full(10, shared)
        own.seen = {}
        rnd = random.Random(6)
        for _ in range(500):
            word = [rnd.choice([10, 11, 12]) for _ in range(rnd.randint(1, 12))]
            want = list(word)
            while True:  # one merge at a time: best rank, then leftmost
                found = [(own._one(x, y), i) for i, (x, y) in enumerate(zip(want, want[1:]))]
                found = min(((r, i, m) for (r, m), i in found if m >= 0), default=None)
                if found is None:
                    break
                want[found[1] : found[1] + 2] = [found[2]]
            assert own.merge(np.array(word), np.array([len(word)]))[0].tolist() == want


def test_edges(frame, library):
    made = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "  x"), (4, "\x00é" * 500)]
    found = piece_encoding.encode(frame(made, "doc_id long, text string"), with_decoded=True).collect()
    want = sorted((str(d), library.encode(t or "", add_eos=True), library.decode(library.encode(t or ""))) for d, t in made)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in found) == want
    assert piece_encoding.encode(frame([], "doc_id long, text string")).count() == 0
    ids = frame([(1, [22557, 2], "old"), (2, [], "old"), (3, None, None), (4, [3 + 200, None], "x")], "k long, ids array<long>, decoded string", clash=True)
    assert {r.k: r.decoded for r in piece_encoding.decode(ids).collect()} == {1: "Hello", 2: "", 3: "", 4: "� ⁇ "}


def test_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = QUERIES["op12_sentencepiece"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode(docs[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
