import numpy as np
import pytest

from tessera.llm import ann as A


def exact(ids, vectors, query, k):
    score = vectors @ vectors[ids.index(query)]
    order = sorted((-s, i) for s, i in zip(score.tolist(), ids) if i != query)[:k]
    return [(i, -s) for s, i in order]


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(8, 24))
    # Different lengths: the largest product is not the smallest angle.
    vectors = (centres[draw.integers(8, size=1500)] + 0.6 * draw.normal(size=(1500, 24))) * draw.uniform(0.5, 2, size=(1500, 1))
    vectors = vectors.astype(np.float32).astype(np.float64)
    ids = list(range(1500))
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, label int")
    got = {}
    for r in A.nearest(rows, k=20).collect():
        got.setdefault(r["query_id"], []).append(r)
    assert sorted(got) == ids[::20]
    hit = 0
    for q, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        for r in found:
            assert r["score"] == pytest.approx(float(vectors[q] @ vectors[r["vec_id"]]), rel=1e-12)
        hit += len({i for i, _ in exact(ids, vectors, q, 20)} & {r["vec_id"] for r in found})
    assert hit / (20 * len(got)) >= 0.9


def test_copies_ties_and_unusable_rows(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(i, same) for i in range(100)] + [(200, [3.0, 0.0, 0.0]), (201, [0.0, 0.0, 0.0]), (202, None), (203, [1.0, None, 1.0]),
                                              (204, [float("nan"), 1.0, 1.0]), (205, [float("inf"), 1.0, 1.0]), (206, []), (207, [1.0, 1.0]),
                                              (None, same), (5, same), (220, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS node", "2 AS query", "'x' AS vec", "0 AS sim")
    got = {}
    for r in A.nearest(df, k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 20, 40, 60, 80, 200, 220}
    first = [v for _, v, _ in sorted(got[0])]
    assert first == [220, *range(1, 20)]  # the longest vector, then the copies in order of their ids
    assert [v for _, v, _ in sorted(got[40])] == [220, *range(0, 19)]
    assert [v for _, v, _ in sorted(got[200])][:2] == [220, 0]
    assert [s for _, _, s in sorted(got[220])][:2] == [45.0, 45.0]


def test_small_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert A.nearest(spark.createDataFrame([], schema)).count() == 0
    assert A.nearest(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    three = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [-1.0, 0.0])], schema)
    assert [tuple(r) for r in A.nearest(three).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]


def test_very_long_vectors_set_no_scale(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(10, 16))
    x = centres[draw.integers(10, size=1200)] + 0.5 * draw.normal(size=(1200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= 1e4
    x[500] *= 1e30
    x[900:910] *= 1e-20
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in A.nearest(rows, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    ids = list(range(1200))
    hit = sum(len({i for i, _ in exact(ids, x, q, 20)} & found) for q, found in got.items())
    assert sorted(got) == ids[::20] and hit / (20 * len(got)) >= 0.95


def test_lengths_beyond_the_range_of_squares(spark):
    rows = [(0, [1e200, 1e200]), (1, [-1e200, 1e200]), (20, [3e-200, 1e-200]), (3, [1.0, 1.0]), (4, [-1.0, 0.5])]
    got = {}
    for r in A.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert got == {0: {1: 3, 2: 20}, 20: {1: 0, 2: 3}}
