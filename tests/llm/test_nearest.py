import numpy as np

from tidemark.llm.nearest import nearest


def exact(rows, asked, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float)
    out = {}
    for q in {i for i, _ in asked} & set(ok):
        near = [(-(ok[q] @ v) / (np.linalg.norm(ok[q]) * np.linalg.norm(v)), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def compare(frame, rows, asked, **how):
    ddl = "vec_id long, embedding array<float>"
    got = {}
    for r in nearest(frame(rows, ddl), frame(asked, ddl), **how).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(rows, asked, how.get("k", 5))
    return {q: sorted(v) for q, v in got.items()}, want


def test_recall_on_clusters(frame):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 32))
    rows = [(i, (centres[i % 12] + 0.5 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(3000)]
    got, want = compare(frame, rows, rows[::20], share=0.2)
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)


def test_edge_cases_are_exact_when_all_is_compared(frame, spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(12)]  # equal vectors
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 0.0, 0.0, 1.0]),
             (205, [float("inf"), 0.0, 0.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (3, rows[3][1])]
    asked = [r for r in rows if r[0] is not None and (r[0] % 5 == 0 or r[0] > 100)]
    got, want = compare(frame, rows, asked, share=1.0)
    assert set(got) == {q for q in want if want[q]}
    for q, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, len(near) + 1))
        assert np.allclose([s for _, _, s in near], [s for _, s in want[q]])
        # Scores that tie in the last bit may come in either order.
        sure = [i for i, (v, s) in enumerate(want[q]) if all(j == i or abs(s - t) > 1e-9 for j, (_, t) in enumerate(want[q][:-1]))]
        if len(sure) == len(want[q]):
            assert [v for _, v, _ in near][:-1] == [v for v, _ in want[q]][:-1]
    assert [v for _, v, _ in got[105]] == [100, 101, 102, 103, 104]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(empty, empty).count() == 0


def test_very_small_and_large_components(frame):
    ddl = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(4)
    plain = [rng.standard_normal(6) for _ in range(40)]
    sizes = [1e-170, 1.0, 1e200, 5e-310]
    rows = [(i, (v * sizes[i % 4]).tolist()) for i, v in enumerate(plain)]
    got = nearest(frame(rows, ddl), frame(rows[:8], ddl), share=1.0).collect()
    assert len(got) == 40
    for r in got:
        a, b = plain[r["query_id"]], plain[r["vec_id"]]
        assert abs(r["score"] - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-9
