import numpy as np
import pytest
from pyspark.sql import functions as F

from brinefold.llm import ann


def brute(rows, asked, k=5):
    sound = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in sound if asked(i)}):
        for v in [v for i, v in sound if i == q]:
            near = {}
            for i, x in sound:
                if i != q:
                    near[i] = max(near.get(i, -2), float(v @ x / (np.sqrt(v @ v) * np.sqrt(x @ x))))
            out[q] = sorted(near.items(), key=lambda p: (-round(p[1], 12), p[0]))[:k]
    return out


def collected(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def same(got, want):
    assert got.keys() == {q for q, near in want.items() if near}
    for q, near in want.items():
        assert [(n, i) for n, i, _ in got.get(q, [])] == [(n, i) for n, (i, _) in enumerate(near, 1)], q
        assert np.allclose([s for _, _, s in got.get(q, [])], [s for _, s in near], atol=1e-12)


def test_edge_cases(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 200, 7)] + [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (50, [3.0, 2.0, 1.0]), (50, [3.0, 2.0, 1.0]), (100, [-1.0, 0.0, 0.5]), (None, [1.0, 1.0, 1.0]), (8, [2.0, 4.0, 6.5]), (9, [-3.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "clash", 0) for i, v in rows], "vec_id long, embedding array<float>, cls string, part int")
    same(collected(ann.search(frame, F.col("id") % 50 == 0)), brute([(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], lambda i: i % 50 == 0))


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in ann.search(frame, F.col("id") == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert ann.search(frame.limit(1), F.col("id") >= 0).count() == 0
    empty = ann.search(frame.limit(0), F.col("id") == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("chunk", [ann.CHUNK, 50])
def test_recall_with_a_hot_vector(spark, chunk):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 16))
    x = (centres[rng.integers(0, 40, 3000)] + 0.5 * rng.standard_normal((3000, 16))).astype(np.float32)
    x[rng.random(3000) < 0.3] = x[0]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = collected(ann.search(frame, F.col("id") % 50 == 0, chunk=chunk))
    want = brute([(i, v.tolist()) for i, v in enumerate(x)], lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want]
    assert sum(hits) >= 0.9 * 5 * len(want)
    hot = [q for q in want if (x[q] == x[0]).all()]
    assert hot and all([(i, round(s, 12)) for _, i, s in got[q]] == [(i, round(s, 12)) for i, s in want[q]] for q in hot)


def test_parts_are_balanced_and_router_learns():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((16, 24))
    x = centres[rng.integers(0, 16, 2000)] + 0.3 * rng.standard_normal((2000, 24))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = ann.neighbour_graph(unit, 8)
    part = ann.balanced_parts(graph, 3)
    sizes = np.bincount(part)
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1
    assert (part[graph] == part[:, None]).mean() > 0.8
    index = ann.Index(ann.fit(unit, 8), {})
    assert (index.leaf(unit) == part).mean() > 0.7 and (index.order(unit)[:, 0] == index.leaf(unit)).all()


@pytest.mark.parametrize("noise", [0.5, 2.0])
def test_recall_beyond_the_sample_with_parts_cut_again(spark, noise):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 16))
    x = centres[rng.integers(0, 60, 6000)] + noise * rng.standard_normal((6000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sizes = {"sample": 1000, "leaf_rows": 100}
    classes = frame.select(F.col("vec_id").alias("cls"), F.col("embedding").alias("v"))
    index, held = ann.build(classes, 6000, **sizes)
    assert index.top.parts == 4 and index.leaves == 64 and len(held) == 200
    leaf = index.leaf(ann.units(x))
    placed = spark.createDataFrame([(i, v.tolist(), int(p)) for i, (v, p) in enumerate(zip(x, leaf))], "cls long, v array<double>, part long")
    assert ann.calibrate(index, placed, held, ann.TARGET) <= (16 if noise < 1 else 63)
    got = collected(ann.search(frame, F.col("id") % 50 == 0, **sizes))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    want = {q: set(np.argsort(-near[q])[:5].tolist()) for q in range(0, 6000, 50)}
    assert got.keys() == want.keys()
    assert sum(len({i for _, i, _ in got[q]} & want[q]) for q in want) >= 0.9 * 5 * len(want)


def test_very_large_and_very_small_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 2e-200]), (2, [-1e300, 1e300]), (3, [1e200, 0.0]), (4, [5e-324, 5e-324])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collected(ann.search(frame, F.col("id") == 0))
    assert [i for _, i, _ in got[0]] == [4, 1, 3, 2]
    assert np.allclose([s for _, _, s in got[0]], [1, 3 / 10**0.5, 0.5**0.5, 0], atol=1e-12)
