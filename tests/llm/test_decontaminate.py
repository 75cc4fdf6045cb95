import random

import numpy as np
import pytest

from tessera.llm import decontaminate as D

ITEMS = [(k, [f"i{k}w{j}" if j % 3 else f"c{j % 7}" for j in range(n)]) for k, n in enumerate((5, 8, 15, 20, 33, 60))]


@pytest.fixture(scope="module")
def index():
    return D.Index(ITEMS + [(90, ["too", "short"]), (91, [])])


def changed(words, edits, draw):
    words = list(words)
    for _ in range(edits):
        at, kind = draw.randrange(len(words)), draw.randrange(3)
        if kind == 0:
            words[at] = "zz"
        elif kind == 1:
            words.insert(at, "qq")
        else:
            del words[at]
    return words


def distance(item, text):
    """Least edits between the item and any stretch of the text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_fitting_distance_is_exact():
    draw = np.random.default_rng(1)
    items, texts = draw.integers(1, 5, size=(300, 9)), draw.integers(0, 5, size=(300, 14))
    cost, start, end = D.fitting_distance(items, texts)
    for k in range(300):
        assert cost[k] == distance(items[k].tolist(), texts[k].tolist())
        assert distance(items[k].tolist(), texts[k, start[k]:end[k]].tolist()) == cost[k]


def test_recall_at_the_largest_number_of_edits(index):
    draw = random.Random(4)
    hit = total = 0
    for trial in range(400):
        number, words = draw.choice(ITEMS[2:])
        text = ["pre"] * draw.randrange(30) + changed(words, D.allowed_edits(len(words), D.SIMILARITY), draw) + ["post"] * draw.randrange(30)
        found = index.find([" ".join(text)])[0]
        hit += any(m[0] == number for m in found)
        total += 1
    assert hit / total >= 0.97


def test_matches_are_exactly_verified(index):
    draw = random.Random(5)
    texts = []
    for _ in range(200):
        number, words = draw.choice(ITEMS)
        texts.append(" ".join(["pre"] * 3 + changed(words, draw.randrange(len(words) // 2 + 1), draw) + ["post"] * 3))
    for text, found in zip(texts, index.find(texts)):
        for number, start, end, edits, similarity in found:
            item = dict(ITEMS)[number]
            words = D.words_of(text)
            assert edits == distance(item, words[start:end]) <= D.allowed_edits(len(item), D.SIMILARITY)
            assert similarity == 1 - edits / len(item) >= D.SIMILARITY - 1e-9
        for number, item in ITEMS:  # verbatim and case-changed items are always found
            if " ".join(item) in text:
                assert any(m[0] == number for m in found)


def test_whole_texts_borders_and_odd_input(index):
    item = " ".join(ITEMS[4][1])
    far = "x " * 100_000
    texts = [None, "", " ", item, item.upper() + "!", far + item, item[: len(item) // 2], f"{item} {item}", "too short", item.replace(" ", ", ")]
    found = index.find(texts)
    assert [bool(f) for f in found] == [False, False, False, True, True, True, False, True, True, True]
    assert found[5][0][1] == 100_000
    assert [(m[0], m[1]) for m in found[7]] == [(4, 0), (4, 33)] and found[8] == [(90, 0, 2, 0, 1.0)]
    # An item cut by the border of two texts is in neither of them.
    words = ITEMS[5][1]
    assert index.find([" ".join(words[:30]), " ".join(words[30:])]) == [[], []]
    assert D.Index([]).find(["a b c d e f"]) == [[]]


def test_blocks_and_tables(spark, messy, no_docs, monkeypatch):
    items = [(k, " ".join(w)) for k, w in ITEMS] + [(None, "the cat sat on the mat"), (7, None), (8, "the cat sat on the mat")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, D.leaks(messy, benchmark).collect()), key=str)
    assert sorted({(r[0], r[1]) for r in whole}, key=str) == [(0, 8), (0, None), (1, 8), (1, None)]
    assert len(whole) == 6  # the repeated row matches as well
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    assert len(list(D.index_blocks(benchmark))) > 1
    assert sorted(map(tuple, D.leaks(messy, benchmark).collect()), key=str) == whole
    assert D.leaks(no_docs, benchmark).count() == 0
    assert D.leaks(messy, benchmark.limit(0)).count() == 0


def test_long_items_are_found_in_bounded_steps():
    words = [f"w{k % 977}x{k % 13}" for k in range(1200)]
    index = D.Index([(1, words)])
    text = ["pre"] * 500 + words[:600] + ["zz"] * 5 + words[600:] + ["post"]
    assert D._step(1800) < D.WINDOW_STEP
    found = index.find([" ".join(text)])[0]
    assert [(m[0], m[1], m[3]) for m in found] == [(1, 500, 5)]


def test_short_items_and_scripts_without_spaces_against_plain_search():
    draw = random.Random(8)
    vocabulary = ["a", "b", "c", "dd", "e5", "_x"]
    items = [(k, [draw.choice(vocabulary) for _ in range(draw.randint(1, 4))]) for k in range(25)]
    index = D.Index(items)
    texts = [" ".join(draw.choice([*vocabulary, "zz"]) for _ in range(draw.randint(0, 30))) for _ in range(80)]
    for text, found in zip(texts, index.find(texts)):
        words = text.split()
        want = [(k, at, at + len(w), 0, 1.0) for k, w in items for at in range(len(words)) if words[at:at + len(w)] == w]
        assert sorted(found) == sorted(want)
    # Twelve characters are twelve words; one edit of them is allowed, three are not.
    chinese = "人工智能模型评测数据集合"
    index = D.Index([(1, D.words_of(chinese)), (2, D.words_of("สวัสดี")), (3, D.words_of("你好"))])
    one, three = chinese.replace("模", "某"), chinese.replace("模型评", "某某某")
    found = index.find([f"前文{chinese}后文", f"x {one}", three, "กล่าวสวัสดีครับ", "他说你好，你好", chinese[:6]])
    assert [[m[0] for m in f] for f in found] == [[1], [1], [], [2], [3, 3], []]
    assert found[0][0][1:4] == (2, 14, 0) and found[1][0][3] == 1


def test_every_place_of_an_item_is_returned():
    index = D.Index(ITEMS)
    item = ITEMS[2][1]
    text = item + ["zz"] * 4 + changed(item, 2, random.Random(1)) + ["yy"] + item
    places = [m for m in index.find([" ".join(text)])[0] if m[0] == 2]
    assert [m[3] for m in places] == [0, distance(item, text[places[1][1]:places[1][2]]), 0] and len(places) == 3
    assert all(a[2] <= b[1] for a, b in zip(places, places[1:]))


def test_a_recall_that_is_not_reached_is_an_error(monkeypatch):
    monkeypatch.setattr(D, "REPEATS", (2, 3))
    with pytest.raises(ValueError, match="repetitions do not reach"):
        D.Index(ITEMS)


def test_stage_with_several_blocks(spark, messy, monkeypatch):
    items = [(k, " ".join(w)) for k, w in ITEMS] + [(8, "the cat sat on the mat"), (9, "1234 5678")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = D.clean(messy, benchmark).select("doc_id").collect()
    monkeypatch.setattr(D, "BLOCK_BYTES", 200)
    several = D.clean(messy, benchmark)
    assert several.columns == messy.columns and sorted(map(str, several.select("doc_id").collect())) == sorted(map(str, one))
    assert len(one) == messy.count() - 4
