import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import crosstoken as C
from tessera.llm.common import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))


def brute(texts, libraries):
    """Every pair of tokens compared by its byte range; ids from the libraries on whole texts."""
    a, b = libraries
    alphabet = {v: k for k, v in C._byte_alphabet().items()}
    undo = {v: k for k, v in alphabet.items()}
    docs = []
    for t in texts:
        docs.append(None)
        if not t:
            continue
        ai = a.encode(" " + t, add_special_tokens=False).ids
        bi = b.encode(t)
        ab = [bytes(undo[c] for c in a.id_to_token(i)) for i in ai]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in bi]
        if b"".join(ab) != (" " + t).encode() or b"".join(bb) != (" " + t).encode():
            continue

        def spans(parts):
            out, at = [], 0
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            return out
        sa, sb = spans(ab), spans(bb)
        links = [(ai[i], bi[j]) for i, (s, e) in enumerate(sa) for j, (u, v) in enumerate(sb) if s < v and u < e]
        common = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for c in common:
            groups.append(",".join(str(k) for k, (s, e) in zip(ai, sa) if low < e <= c) + "|"
                          + ",".join(str(k) for k, (s, e) in zip(bi, sb) if low < e <= c))
            low = c
        docs[-1] = (len(ai), len(bi), len(groups), links, ";".join(groups))
    count = Counter(pair for d in docs if d for pair in d[3])
    most = {}
    for (_, k), n in count.items():
        most[k] = max(most.get(k, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_g, links, text = d
            out.append((n_a, n_b, n_g, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
                        hashlib.sha256(text.encode()).hexdigest()))
    return out


ODD = ["a", " ", "  ", "a  b ", " lead", "tail   ", "\n\n x\t\ty", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ has the mark", "zürich 東京 قلب 🙂👍🏽",
       "é ﬁ   ​‍", "\x00 nul \x7f", "don't we'll I'M 1234567 3.14", "中文没有空格的一段文字", "a" * 700, " " * 300 + "x", "x" + " " * 300, "ab " * 200]


def test_against_brute_force(spark, libraries):
    draw = random.Random(3)
    texts = ODD + [None, ""] + ["".join(draw.choice(["the ", "of", " ", "é", "ß", "\n", "42", "漢", "🙂", "tion", "ing", ".", "  "]) for _ in range(draw.randint(1, 60)))
                                for _ in range(120)]
    texts += [texts[0], texts[30], texts[30]]
    want = brute(texts, libraries)
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_a string").selectExpr(
        "*", "1 AS row", "2 AS block", "3 AS part", "4 AS kind").repartition(3)
    # Small blocks and windows: texts lie in several of them.
    for window in (5, C.WINDOW):
        got = sorted(tuple(r) for r in C.align_documents(rows, A, B, ranges=3, window=window, block_links=500).collect())
        assert got == [(i, *w) for i, w in enumerate(want)]


def test_words_give_the_library_s_ids(libraries):
    a, b = libraries
    draw = random.Random(5)
    pool = [chr(c) for c in (*range(32, 127), 0xe9, 0x4e2d, 0x1f642, 0x301, 0x3000, 0xa0, 0x2028, 0x9, 0xa)] + [" "] * 30
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(1, 40))) for _ in range(3000)] + [t for t in ODD if "▁" not in t]
    ids, same = C.PieceSide(B).encode(texts)
    assert all(same)
    assert [i.tolist() for i in ids] == b.encode(texts)
    ids, same = C.ByteSide(A).encode(texts)
    assert all(same)
    assert [i.tolist() for i in ids] == [e.ids for e in a.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_gallop_and_windows():
    draw = np.random.default_rng(0)
    for n, m in ((1, 1), (5, 400), (300, 300), (1000, 20)):
        hay = np.sort(draw.choice(5000, size=n, replace=False))
        needles = np.sort(draw.integers(0, hay[-1] + 1, size=m))
        assert C.gallop(needles, hay).tolist() == np.searchsorted(hay, needles).tolist()


def test_messy_and_empty(spark, messy, no_docs, libraries):
    got = C.align_documents(messy, A, B).collect()
    assert len(got) == messy.count()
    texts = [r["text"] for r in messy.orderBy("doc_id").collect()]
    short = [t for t in texts if t is None or len(t) < 1000]
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[2]["n_links"] == by_id[3]["n_links"] == 0 and by_id[2]["groups_sha256"] == ""
    assert by_id[5]["n_links"] > 60_000 and by_id[6]["n_a"] > 1000 and short
    assert C.align_documents(no_docs, A, B).count() == 0


def test_overlaps_of_a_text():
    found = C.overlaps("hello world", A, B)
    assert [f[0] for f in found] == sorted(f[0] for f in found)
    assert sum(f[3] for f in found) == len(" hello world")
    assert C.overlaps("", A, B) == []
