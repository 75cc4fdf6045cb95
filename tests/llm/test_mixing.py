import random
from collections import Counter, defaultdict

import pytest

from tessera.llm import mixing as M


def test_targets_stop_at_three_times_the_size():
    got = M.targets([("b", 100), (None, 5), ("a", 1000), ("c", 10)])
    # a weighs 1, b 2, c 3, null 1: c and null stop at 30 and 15, the rest is shared by a and b as 1 to 2,
    # where b stops at 300.
    assert got == pytest.approx({"c": 30.0, None: 15.0, "b": 300.0, "a": 770.0})
    assert sum(got.values()) == pytest.approx(1115)
    assert M.targets([]) == {} and M.targets([("a", 0)]) == {"a": 0.0}
    assert M.targets([("z", 7), ("é", 7)]) == pytest.approx({"z": 14 / 3, "é": 28 / 3})


def test_duel_keeps_words_and_expectation():
    draw = random.Random(1)
    for _ in range(200):
        s, t, a, b = draw.randrange(1, 50), draw.randrange(1, 50), draw.uniform(.01, .99), draw.uniform(.01, .99)
        low, high = M.duel(a, s, b, t, 0.0), M.duel(a, s, b, t, 1 - 1e-12)
        for x, y in (low, high):
            assert s * x + t * y == pytest.approx(s * a + t * b)
            assert min(abs(x), abs(x - 1), abs(y), abs(y - 1)) < 1e-9 and -1e-9 <= min(x, y) and max(x, y) <= 1 + 1e-9
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
        assert (low[0] * down + high[0] * up) / (up + down) == pytest.approx(a)


@pytest.mark.parametrize("bucket_rows, fan", [(4096, 64), (16, 2)])
def test_taken_words_meet_the_targets(spark, monkeypatch, bucket_rows, fan):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(M, "FAN", fan)
    draw = random.Random(2)
    rows = [(k, f"s{k % 5}" if k % 3 else "hot", "w " * draw.randrange(0, 30)) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.mix(docs).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1500))
    source = {r[0]: r[1] for r in rows}
    taken, size = defaultdict(int), Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    target = M.targets(list(size.items()))
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s])
    assert all(abs(taken[s] - target[s]) <= 30 for s in size)  # one document at most
    again = M.mix(docs.repartition(7)).collect()  # reruns agree, however the rows lie
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_copies_come_near_their_expectation(spark):
    rows = [(k, "a" if k % 2 else "b", "w " * (1 + k % 9)) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sums = Counter()
    for r in M.mix(docs).collect():
        sums[(r["doc_id"] % 2, r["size"])] += r["taken"] / r["size"] - r["target"] / r["source_size"]
    counts = Counter((k % 2, 1 + k % 9) for k in range(2000))
    assert all(abs(v) <= 5 * counts[k] ** 0.5 for k, v in sums.items())


def spark_rows(df, rows):
    return df.sparkSession.createDataFrame(rows, "doc_id long, source string, text string")


def test_messy_and_empty_tables(spark, messy, no_docs):
    got = M.mix(messy).collect()
    assert len(got) == messy.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert M.mix(no_docs).count() == 0
    large = spark_rows(messy, [(2 ** 53 + 1, "a", "x y"), (None, "a", "x y z"), (-2 ** 62 - 1, None, "x")])
    assert {r["doc_id"] for r in M.mix(large).collect()} == {2 ** 53 + 1, None, -2 ** 62 - 1}
    out = M.mixed_documents(messy)
    assert out.columns == messy.columns
    empty = [r for r in out.collect() if not (r["text"] or "").split()]
    assert len(empty) == 4  # wordless rows stay, once each
    assert M.mixed_documents(no_docs).count() == 0
