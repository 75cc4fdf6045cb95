import random

import pytest

from tessera.llm import tokens as K
from tessera.llm.common import tokenizer_path

NAME = "word_bpe_49k.json"
ODD = ["a", "aa", "ha", "é", "é", " ", "'s", "'RE", "'", "!!", "1", "23", "ß", "Σ", "σ", " ", "中", "文", "\U0001f600",
       "<|endoftext|>", "<|end", "İ", "\x1c", "\x85", "​", "the", "ing", "ñ", "\r\n", "K", "ſ", "ﬁ", "﻿", "́"]


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenizer_path(NAME))
    return K.PrefixCounter(tokenizer_path(NAME)), lambda s: len(library.encode(s, add_special_tokens=False).ids)


def test_counts_equal_the_library(both):
    ours, theirs = both
    draw = random.Random(3)
    for _ in range(3000):
        s = "".join(draw.choice(ODD) for _ in range(draw.randrange(15)))
        assert ours.count(s) == theirs(s), s
    for _ in range(500):
        s = "".join(draw.choice(["a", "h", "n", "th", "in", "on"]) for _ in range(draw.randrange(1, 25)))
        assert ours.count(s) == theirs(s), s
    assert ours.count(None) == ours.count("") == ours.count(" \n\t") == 0


def test_every_prefix_is_exact(both):
    ours, theirs = both
    for text in ("The quick-brown foxes' tails aren't 42% longer!!", "Müller's Straße: été, naïve — don’t", "unbelievableness<|endoftext|>again and"):
        table = ours.stored(text)
        for p in range(len(text) + 1):
            assert ours.at_prefix(text, p, table) == theirs(text[:p]), text[:p]
        for word in text.split():
            mapped = ours._mapped(word.lower())
            last, count = ours.prefixes(mapped)
            if mapped.isalpha() and mapped.isascii():
                assert [ours.closed(mapped, last, count, k) for k in range(1, len(mapped) + 1)] == [theirs(word[:k]) for k in range(1, len(word) + 1)]


def test_budget_questions_need_no_encoding(both):
    ours, theirs = both
    text = "several words of different length " * 20
    table = ours.stored(text)
    for budget in (0, 1, 7, 50, 10_000):
        cut = ours.fitting(table, budget)
        assert theirs(text[:cut]) <= budget
        assert cut >= len(text.rstrip()) or theirs(text[:cut + 12]) > budget


def test_memories_start_anew(both, monkeypatch):
    ours, theirs = both
    monkeypatch.setattr(K, "MAX_WORDS", 5)
    monkeypatch.setattr(K, "MAX_PAIRS", 5)
    texts = ["some words that are many more than five in all", "and others that follow after them", None]
    ours.words.clear()
    assert ours.counts(texts) == [theirs(t or "") for t in texts]


def test_messy_and_empty_tables(spark, both, messy, no_docs):
    _, theirs = both
    got = K.count_tokens(messy, limit=20).collect()
    texts = {r["doc_id"]: r["text"] for r in messy.collect() if r["doc_id"] is not None}
    assert len(got) == messy.count()
    for r in got:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]] or ""
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), theirs(t), theirs(t) > 20)
            assert theirs(t[:r["fit_chars"]]) <= 20
    assert K.count_tokens(no_docs).count() == 0
    stored = K.prefix_table(messy, NAME).filter("doc_id = 0").first()
    assert stored["tokens"] == [1, 2, 3, 4, 5, 6] and stored["ends"][-1] == 22


def test_budgets_cut_inside_words(both):
    ours, theirs = both
    draw = random.Random(5)
    runs = ["".join(draw.choice("etaoinshrdlu") for _ in range(3_000)), "".join(draw.choice("中文天地人大小上下") for _ in range(1_200))]
    for text in [*runs, "e\u0301te\u0301 " * 40, "one <|endoftext|> two"]:
        table = ours.stored(text)
        for budget in (1, 2, 3, 50, 400):
            cut = ours.fitting(table, budget)
            assert cut == ours.fit(text, budget) and theirs(text[:cut]) <= budget
            if theirs(text) > budget:
                assert theirs(text[:cut + 2]) > budget or text[cut:cut + 2].isspace() or text[cut:cut + 1] == " "
    for run in runs:
        assert ours.fitting(ours.stored(run), 400) > 100


def test_stored_counts_answer_every_prefix(both):
    ours, theirs = both
    draw = random.Random(4)
    for _ in range(400):
        text = "".join(draw.choice(ODD) for _ in range(draw.randrange(10)))
        table = ours.stored(text)
        for p in range(len(text) + 1):
            assert ours.at_prefix(text, p, table) == theirs(text[:p]), (text, p)
        for budget in (1, 2, 4):
            fits = [p for p in range(len(text) + 1) if theirs(text[:p]) <= budget]
            cut = ours.fitting(table, budget)
            assert theirs(text[:cut]) <= budget and cut <= max(fits)


def test_answers_encode_nothing(both, monkeypatch):
    ours, theirs = both
    text = "unbelievableness " * 3 + "x" * 500
    table, expected = ours.stored(text), [theirs(text[:p]) for p in range(len(text) + 1)]
    for name in ("pieces", "of_piece", "learn", "extend"):
        monkeypatch.setattr(ours, name, None)
    assert [ours.at_prefix(text, p, table) for p in range(len(text) + 1)] == expected


def test_summaries_are_counts_and_fits(both):
    ours, theirs = both
    draw = random.Random(5)
    texts = ["".join(draw.choice([*ODD, "don't", "unbelievable", "Über", " "]) for _ in range(draw.randrange(40))) for _ in range(400)] + [None, "", "a b"]
    for budget in (0, 1, 5, 17):
        for text, (n, fit) in zip(texts, ours.summaries(texts, budget)):
            assert n == theirs(text or "")
            assert fit == (len(text or "") if n <= budget else ours.fit(text, budget)), (text, budget)


def test_a_fit_looks_at_no_word_after_it(both, monkeypatch):
    ours, _ = both
    seen = []
    places = K.PrefixCounter._places
    monkeypatch.setattr(K.PrefixCounter, "_places", staticmethod(lambda words, whole: seen.append(len(words)) or places(words, whole)))
    text = "some words of a long text " * 5000
    (n, fit), = ours.summaries([text], 20)
    assert n > 20 and fit == ours.fit(text, 20) and seen[0] <= 21


def test_ascii_words_are_the_pattern_s(both):
    ours, _ = both
    draw = random.Random(9)
    for _ in range(2000):
        s = "".join(draw.choice([chr(draw.randrange(128)), "'s", "'LL", "don't", "12", " "]) for _ in range(20))
        assert ours.ascii.findall(s.lower()) == ours.pattern.findall(s.lower())
    assert K._ascii_pattern(r"\p{Lu}+|[\p{L}]+") is None and K._ascii_pattern(r"\p{L}+") is None
