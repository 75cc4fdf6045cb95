import numpy as np

from tessera.llm import innerproduct as P


def brute(rows, k, mod):
    """All products with Python integers."""
    kept = [(n, i, [int(np.floor(256 * float(x))) for x in v]) for n, (i, v) in enumerate(rows)]
    out = []
    for n, i, v in kept:
        if i is None or i % mod:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for m, j, w in kept if m != n)[:k]
        out += [(i, r + 1, None if none else j, -s if -2 ** 63 <= -s < 2 ** 63 else None) for r, (s, none, j, _) in enumerate(found)]
    return sorted(out, key=str)


def ranked(df, k=5, mod=50):
    from pyspark.sql import functions as F
    return sorted((tuple(r) for r in P.top_products(df, k, F.col("vec_id") % mod == 0).collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>"


def test_against_brute_force_over_many_cells(spark, monkeypatch):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(6, 10))
    x = (centres[draw.integers(6, size=900)] + 0.5 * draw.normal(size=(900, 10))) * draw.uniform(0.01, 0.3, size=(900, 1))
    same = x[17].tolist()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, same) for i in range(300)] + [(20, same), (20, same), (None, same), (3000, [0.0] * 10)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS cell", "2 AS kind", "'x' AS row", "3 AS length", "4 AS asked", "5 AS least").repartition(5)
    monkeypatch.setattr(P, "CELL_BYTES", 40 * 10 * 8)
    for k in (1, 5):
        assert ranked(df, k, 20) == brute(rows, k, 20)


def test_equal_scores_and_negative_scores(spark, monkeypatch):
    monkeypatch.setattr(P, "CELL_BYTES", 8 * 2 * 8)
    # Only products below zero for query 0; many ties.
    rows = [(0, [1.0, 0.0])] + [(i, [-1.0 - (i % 3), 0.0]) for i in range(1, 60)]
    assert ranked(spark.createDataFrame(rows, SCHEMA), 5, 100) == brute(rows, 5, 100)


def test_any_size_of_components(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(120, 6))
    x[7] *= 1e15
    x[50] *= 1e150
    x[90] *= 1e-9
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert ranked(spark.createDataFrame(rows, SCHEMA), 5, 10) == brute(rows, 5, 10)


def test_unusable_rows_small_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [1.0]), (6, []), (7, [0.5, 0.5]), (50, [0.0, 0.0])]
    assert ranked(spark.createDataFrame(rows, SCHEMA)) == brute([rows[0], rows[7], rows[8]], 5, 50)
    assert ranked(spark.createDataFrame([], SCHEMA)) == []
    assert ranked(spark.createDataFrame([(0, [1.0])], SCHEMA)) == []
    assert ranked(spark.createDataFrame([(0, []), (1, [])], SCHEMA)) == [(0, 1, 1, 0)]


def test_bounds_drop_most_pairs():
    draw = np.random.default_rng(1)
    # Most of the length lies in few directions.
    x = np.floor(256 * draw.normal(size=(4000, 32)) * np.geomspace(1, 0.01, 32) @ np.linalg.qr(draw.normal(size=(32, 32)))[0])
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    cell = P.Cell(np.arange(4000), list(range(4000)), x, turn)
    scores = x[:20] @ x.T
    least = [int(np.sort(np.delete(s, i))[-5]) for i, s in enumerate(scores)]
    work = {}
    got = cell.search(np.arange(20), x[:20], least, 5, work)
    assert sorted(s for i, _, s in got if i == 3) == sorted(int(v) for v in np.sort(np.delete(scores[3], 3))[-5:])
    assert work[12] < 0.5 * work[4] and work["exact"] < 0.02 * 20 * 4000
