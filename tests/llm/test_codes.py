import hashlib

import numpy as np

from tessera.llm import codes as C


def plain(rows, parts, entries, rounds):
    """Every assignment in full, with Python integers."""
    kept = [(i, label, [int(np.floor(256 * float(x))) for x in v]) for i, v, label in rows]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    w = len(kept[0][2]) // parts
    books = [[r[2][p * w:(p + 1) * w] for r in first] for p in range(parts)]

    def nearest(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in book]
        return min(zip(d, range(len(d))))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, _, v in kept:
                x = v[p * w:(p + 1) * w]
                own.setdefault(nearest(x, books[p])[1], []).append(x)
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, per_label = [], {}
    for i, label, v in kept:
        found = [nearest(v[p * w:(p + 1) * w], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, per_label[label], sha) for i, c, e, label in out), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_against_full_assignment(spark):
    draw = np.random.default_rng(1)
    # Few different values: many ties, many copies.
    vectors = (draw.integers(-3, 4, size=(400, 8)) / 100).tolist()
    rows = [(i, v, None if i % 7 == 0 else i % 3) for i, v in enumerate(vectors)] + [(3, vectors[3], 1), (3, vectors[4], 1), (None, vectors[5], None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS code", "2 AS near", "'x' AS vec", "3 AS of").repartition(4)
    for rounds in (0, 1, 2, 4):
        got = sorted((tuple(r) for r in C.code_report(df, parts=4, entries=9, rounds=rounds).collect()), key=str)
        assert got == plain(rows, 4, 9, rounds), rounds


def test_any_size_of_components(spark):
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(60, 4))
    vectors[5] *= 1e12
    vectors[40] *= 1e30
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    got = sorted((tuple(r) for r in C.code_report(spark.createDataFrame(rows, SCHEMA), parts=2, entries=8).collect()), key=str)
    want = plain(rows, 2, 8, 2)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[4] == w[4]
        assert g[2] == (w[2] if w[2] < 2 ** 63 else None)
        assert g[3] == (w[3] if w[3] < 2 ** 63 else None)


def test_only_moved_entries_are_compared(monkeypatch):
    draw = np.random.default_rng(3)
    x = draw.integers(-50, 50, size=(300, 3)).astype(float)
    old = x[:20].copy()
    code, near = C.assign(x, old)
    new = old.copy()
    new[[2, 11]] += 5
    moved = (new != old).any(axis=1)
    seen = []
    plain_distances = C.distances
    monkeypatch.setattr(C, "distances", lambda a, b: seen.append((len(a), len(b))) or plain_distances(a, b))
    again = C.reassign(x, new, moved, code, near)
    monkeypatch.undo()
    want = C.assign(x, new)
    assert again[0].tolist() == want[0].tolist() and again[1].tolist() == want[1].tolist()
    assert sorted(seen) == sorted([(int(moved[code].sum()), 20), (int((~moved[code]).sum()), 2)])


def test_unusable_rows_small_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0, 3.0], 1), (1, None, 1), (2, [1.0, None, 1.0], 1), (3, [float("nan"), 1.0, 1.0], None), (4, [float("inf"), 0.0, 0.0], 2),
            (5, [1.0], 1), (6, [], 2), (7, [1.0, 2.0, 3.5], None)]
    got = {r["vec_id"]: r for r in C.code_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {0, 7} and got[0]["error"] == got[7]["error"] == 0
    assert got[0]["code"] == "00" * 16 and got[7]["code"] == "0000" + "01" + "00" * 13
    assert C.code_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.code_report(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


def test_decoding_gives_the_entries(spark):
    rows = [(i, [float(i % 5), float(i % 3)], 0) for i in range(30)]
    codes = C.fit_codes(C.integer_vectors(spark.createDataFrame(rows, SCHEMA)), parts=2, entries=20, rounds=3)
    back = {int(r["vec_id"]): list(r["vec"]) for r in C.decoded(codes).collect()}
    assert back == {i: [256.0 * x for x in v] for i, v, _ in rows}
