"""Toxicity: weighted lexicon, Aho-Corasick over folded text, length normalisation, exception phrases.

Text is folded first (compatibility forms, accents, homoglyphs, digit and symbol substitutions), so
that ``1d10t`` and a Cyrillic look-alike match the plain spelling. The lexicon holds whole words and
word-initial stems with a weight; an automaton finds all of them in one pass over the whole text.
Hits inside an exception phrase do not count. The score is ``x / (x + c)`` with ``x`` the summed
weight per hundred words, hence between 0 and 1.

Defined results: a null or empty text has no words and scores 0; ties and repeated rows score alike;
only ``doc_id`` and ``text`` are read, so other columns never clash. With no usable labels (empty
tables, one class only) the learned lexicon is empty and every score is 0.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, fit_sample, persist, prepare

THRESHOLD = 0.3
#: Bound of the labelled rows the lexicon and its scale are fitted on (a hash sample beyond it).
MAX_FIT_ROWS = 40_000
STEMS = (4, 5, 6)
#: Rejected documents a term must come up in, whatever the size of the tables.
LEAST_SEEN = 3
#: Standard errors taken off a term's log odds, and what must be left.
CAUTION = 2.5
LEAST_ODDS = 0.5
#: Hits by stronger terms after which a rejected document is no evidence for weaker ones.
EXPLAINED = 2
#: A phrase is an exception if chance would leave it without a rejected document less often than this.
CHANCE = 0.001
#: Terms a task counts before it hands them on.
HELD_TERMS = 200_000

# Look-alike letters of other scripts and the Latin letter each is read as.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ß": "ss", "ø": "o", "đ": "d",
    "ł": "l", "æ": "ae", "œ": "oe",
}
# Digits and symbols used for letters.
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
                 "!": "i", "|": "i", "+": "t", "€": "e"}

_HOMOGLYPH_TABLE = str.maketrans(HOMOGLYPHS | {"l": "i"} | dict.fromkeys("­​‌‍⁠﻿"))
_HOMOGLYPH_TABLE[ord("ł")] = _HOMOGLYPH_TABLE[ord("ӏ")] = "i"
_ASCII_TABLE = str.maketrans({"l": "i"})
_SUBST_TABLE = str.maketrans(SUBSTITUTIONS)
# Whole tokens with a substitute in them; starting at token borders alone keeps very long tokens linear.
_SUBST_TOKEN = re.compile(r"(?<!\S)[^\s0134578@$!|+€]*[0134578@$!|+€]\S*")
_MARKS = re.compile("[̀-ͯ]+")
_WORD = re.compile(r"[^\W_]+")
_LETTER = re.compile(r"[^\W\d_]")


def _unsubstitute(match: re.Match) -> str:
    token = match.group()
    core = token.strip("!?.,;:|+'\"()[]{}<>")
    if not core or not _LETTER.search(core):
        return token
    return core.translate(_SUBST_TABLE)


def fold_words(text: str | None) -> list[str]:
    """The folded words of ``text``; ``i`` and ``l`` share one symbol because ``1`` stands for both."""
    if not text:
        return []
    if text.isascii():
        out = text.lower()
        table = _ASCII_TABLE
    else:
        out = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
        table = _HOMOGLYPH_TABLE
    out = _SUBST_TOKEN.sub(_unsubstitute, out)
    return _WORD.findall(out.translate(table))


@dataclass
class Lexicon:
    """Folded terms with weights: ``words`` match whole words, ``stems`` the start of a word."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    scale: float = 1.0

    def automaton(self):
        import ahocorasick
        machine = ahocorasick.Automaton()
        entries: dict[str, tuple[float, int]] = {}
        for term, weight in self.stems.items():
            entries[f" {term}"] = (weight, len(term) + 1)
        for term, weight in self.words.items():
            entries[f" {term} "] = (weight, len(term) + 2)
        for phrase in self.exceptions:
            key = f" {' '.join(fold_words(phrase))} "
            entries[key] = (-1.0, len(key))
        for key, value in entries.items():
            machine.add_word(key, value)
        if entries:
            machine.make_automaton()
        return machine


def lexicon_of(terms: dict[str, float], stems: dict[str, float] | None = None,
               exceptions: tuple[str, ...] = (), scale: float = 1.0) -> Lexicon:
    """A lexicon from plainly written terms."""
    plain = lambda d: {"".join(fold_words(t)): w for t, w in (d or {}).items() if fold_words(t)}
    return Lexicon(plain(terms), plain(stems), tuple(exceptions), scale)


def weight_of(words: list[str], machine) -> tuple[float, int]:
    """Summed weight and number of hits: one per word, the heaviest term that matches it."""
    if not words or not len(machine):
        return 0.0, 0
    hits: dict[int, float] = {}
    allowed: list[tuple[int, int]] = []
    for end, (weight, size) in machine.iter(f" {' '.join(words)} "):
        start = end - size + 1
        if weight < 0:
            allowed.append((start, end))
        elif weight > hits.get(start, 0.0):
            hits[start] = weight
    if allowed and hits:
        last = -1
        merged: list[list[int]] = []
        for start, end in sorted(allowed):
            if merged and start <= last:
                merged[-1][1] = last = max(last, end)
            else:
                merged.append([start, end])
                last = end
        starts = [m[0] for m in merged]
        for at in list(hits):
            k = bisect_right(starts, at) - 1
            if k >= 0 and at < merged[k][1]:
                del hits[at]
    return sum(hits.values()), len(hits)


def density(weight: float, n_words: int) -> float:
    """Weight per hundred words; ten more words are assumed, so that a single hit in a tiny text is damped."""
    return 100.0 * weight / (n_words + 10)


def score_of(text: str | None, lexicon: Lexicon, machine) -> float:
    words = fold_words(text)
    weight, _ = weight_of(words, machine)
    x = density(weight, len(words))
    return x / (x + lexicon.scale)


def toxicity_score(text: Column, lexicon: Lexicon) -> Column:
    """The score of a text column as an Arrow-batched expression; other columns stay in the JVM."""
    @F.pandas_udf("double")
    def run(batches: "Iterator[pd.Series]") -> "Iterator[pd.Series]":
        machine = lexicon.automaton()
        for texts in batches:
            yield pd.Series([score_of(t, lexicon, machine) for t in texts], dtype="float64")
    return run(text)


def _terms(words: list[str]) -> set[str]:
    """Whole words as `` w `` and stems as `` s``."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        for k in STEMS:
            if len(w) > k:
                out.add(f" {w[:k]}")
    return out


def _outside(words: list[str], phrases: frozenset[str]) -> list[str]:
    """The words that are in none of the two-word ``phrases``."""
    inside = {k + n for k, pair in enumerate(zip(words, words[1:])) if " ".join(pair) in phrases for n in (0, 1)}
    return [w for k, w in enumerate(words) if k not in inside]


def _count_terms(train: DataFrame, known: list[str] | None, phrases: frozenset[str] = frozenset()) -> DataFrame:
    """(term, df, bad): documents of ``train`` with each term and the rejected ones of them; only ``known``
    terms if given, and only outside ``phrases``. Without a column ``toxic`` no document is rejected."""
    wanted = frozenset(known) if known is not None else None
    toxic = F.col("toxic") if "toxic" in train.columns else F.lit(0)

    def table(df: Counter[str], bad: Counter[str]) -> pd.DataFrame:
        return pd.DataFrame({"term": list(df), "df": pd.Series(list(df.values()), dtype="int64"),
                             "bad": pd.Series([bad[t] for t in df], dtype="int64")})

    def count(batches):
        df: Counter[str] = Counter()
        bad: Counter[str] = Counter()
        for batch in batches:
            for text, rejected in zip(batch["text"], batch["toxic"]):
                words = fold_words(text)
                terms = _terms(_outside(words, phrases) if phrases else words)
                if wanted is not None:
                    terms &= wanted
                df.update(terms)
                if rejected:
                    bad.update(terms)
            if len(df) > HELD_TERMS:
                yield table(df, bad)
                df.clear()
                bad.clear()
        if df:
            yield table(df, bad)

    return (train.select("text", toxic.alias("toxic")).mapInPandas(count, "term string, df long, bad long")
                 .groupBy("term").agg(F.sum("df").alias("df"), F.sum("bad").alias("bad")))


def _sure(bad: Column, clean: Column, n_bad: int, n_clean: int) -> Column:
    """A lower bound of a term's log odds; of rates, not counts, so that the share of rejected documents
    among the labelled ones plays no part."""
    odds = ((bad + 0.5) / (n_bad + 1)) / ((clean + 0.5) / (n_clean + 1))
    return F.log(odds) - CAUTION * F.sqrt(1 / (bad + 0.5) + 1 / (clean + 0.5))


def _exceptions(train: DataFrame, shares: dict[str, float]) -> frozenset[str]:
    """Two-word phrases around a term seen in several accepted texts and in no rejected one.

    ``shares`` gives for each term the share of accepted documents among those that hold it: how often a
    document with the phrase would be accepted if the phrase told nothing.
    """
    def phrases(batches):
        known: dict[str, float] = {}

        def share(word: str) -> float:
            """The largest share of the terms that match ``word``; 0 if none does."""
            if word not in known:
                if len(known) > HELD_TERMS:
                    known.clear()
                known[word] = max(shares.get(f" {word} ", 0.0), *(shares.get(f" {word[:n]}", 0.0) if len(word) > n else 0.0 for n in STEMS))
            return known[word]

        def table() -> pd.DataFrame:
            return pd.DataFrame({"phrase": list(counts), "share": pd.Series([max(map(share, p.split(" "))) for p in counts], dtype="float64"),
                                 "clean": pd.Series([c for c, _ in counts.values()], dtype="int64"),
                                 "bad": pd.Series([b for _, b in counts.values()], dtype="int64")})

        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = fold_words(text)
                hits = [share(w) > 0 for w in words]
                for p in {f"{words[k]} {words[k + 1]}" for k in range(len(words) - 1) if hits[k] or hits[k + 1]}:
                    counts.setdefault(p, [0, 0])[toxic] += 1
            if len(counts) > HELD_TERMS:
                yield table()
                counts.clear()
        if counts:
            yield table()

    found = (train.select("text", "toxic").mapInPandas(phrases, "phrase string, share double, clean long, bad long")
                  .groupBy("phrase").agg(F.max("share").alias("share"), F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
                  .filter("clean >= 3 AND bad = 0").filter(F.col("clean") * F.log("share") <= math.log(CHANCE)))
    return frozenset(r["phrase"] for r in found.collect())


def _unexplained(bad: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """The terms, from strong to weak, that ``LEAST_SEEN`` rejected documents need: such as hold fewer than
    ``EXPLAINED`` stronger ones. Chance finds and what copies of a document share go; a term that only few
    documents have stays if nothing else marks them. ``bad`` is part of the bounded sample.
    """
    # Of equally strong terms whole words go first, then longer stems.
    order = sorted(weights, key=lambda t: (-weights[t], not t.endswith(" "), -len(t), t))
    number = {t: k for k, t in enumerate(order)}

    def held(batches):
        for batch in batches:
            yield pd.DataFrame({"terms": [sorted(number[t] for t in _terms(fold_words(x)) if t in number) for x in batch["text"]]})

    where: list[list[int]] = [[] for _ in order]
    rows = bad.select("text").mapInPandas(held, "terms array<int>").collect()
    for doc, row in enumerate(rows):
        for k in row["terms"]:
            where[k].append(doc)
    hits = [0] * len(rows)
    kept = {}
    for k, term in enumerate(order):
        if sum(hits[doc] < EXPLAINED for doc in where[k]) >= LEAST_SEEN:
            kept[term] = weights[term]
            for doc in where[k]:
                hits[doc] += 1
    return kept


def learn_lexicon(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> Lexicon:
    """Learn terms, weights, exception phrases and the scale from labelled rows.

    Rows whose crc32(doc_id) mod 4 is 2 never take part. At most about ``max_rows`` labelled rows,
    chosen by a hash, are read; the sample is written once and used by each step. A document with
    both labels is left out. Terms: in ``LEAST_SEEN`` rejected documents or more, with a lower bound of
    the log odds above ``LEAST_ODDS``; nothing depends on the share of all rejected documents, so that the
    terms of a small language count like others. Terms that only come up beside stronger ones are left
    out. The bound is the weight, so that terms seen in few documents weigh little.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
                   .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
                   .filter("toxic = most").select("doc_id", "toxic")
                   .filter(crc_mod(F.col("doc_id"), 4) != 2))
    n_rows = known.count()
    if not n_rows:
        return Lexicon()
    chosen = known.filter(fit_sample(known, F.lit(True), max_rows, n_rows, 1))
    # The chosen labels are bounded by max_rows: their broadcast keeps the texts where they are.
    train = persist(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "op1-train")
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_bad, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_bad or not n_clean:
        return Lexicon()
    bad, clean = F.col("bad"), F.col("clean")
    # All terms are judged where they are counted; only those that pass come to the driver. Terms of high
    # odds are looked at for exceptions first, however many accepted documents hold them; what decides
    # and weighs is the bound outside the exceptions.
    def judged(counts: DataFrame, least: float) -> list:
        return (counts.withColumn("clean", F.col("df") - bad).filter(bad >= LEAST_SEEN)
                      .withColumn("sure", _sure(bad, clean, n_bad, n_clean)).filter(F.col("sure") > least).orderBy("term").collect())

    seen = judged(_count_terms(train, None), 0.0)
    # Terms that no accepted document holds need no exception.
    shares = {r["term"]: r["clean"] / r["df"] for r in seen if r["clean"]}
    phrases = _exceptions(train, shares) if shares else frozenset()
    if phrases:
        seen = judged(_count_terms(train, [r["term"] for r in seen], phrases), LEAST_ODDS)
    seen = [r for r in seen if r["sure"] > LEAST_ODDS]
    df_bad = {r["term"]: r["bad"] for r in seen}
    df_clean = {r["term"]: r["clean"] for r in seen}
    weights = _unexplained(train.filter("toxic = 1"), {r["term"]: r["sure"] for r in seen}) if seen else {}
    # A stem that a longer one explains as well is dropped.
    ordered = sorted(weights)
    for term in sorted(weights, key=len):
        longer = (t for t in ordered[bisect_right(ordered, term):bisect_right(ordered, term + "\U0010ffff")] if t in weights)
        if any(df_bad[t] >= 0.9 * df_bad[term] and df_clean[t] < df_clean[term] for t in longer):
            del weights[term]
    if not weights:
        return Lexicon()
    lexicon = Lexicon({t[1:-1]: w for t, w in weights.items() if t.endswith(" ")},
                      {t[1:]: w for t, w in weights.items() if not t.endswith(" ")})
    machine = lexicon.automaton()
    lexicon.exceptions = tuple(sorted(p for p in phrases if weight_of(p.split(" "), machine)[1]))
    lexicon.scale = _fit_scale(train, lexicon)
    return lexicon


def _fit_scale(train: DataFrame, lexicon: Lexicon) -> float:
    """The scale that puts the best cut between both classes at the decision threshold."""
    def bins(batches):
        machine = lexicon.automaton()
        counts: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = fold_words(text)
                x = density(weight_of(words, machine)[0], len(words))
                counts[(max(-40, round(8 * math.log2(x))) if x > 0 else -100, int(toxic))] += 1
        if not counts:
            return
        yield pd.DataFrame({"bin": pd.Series([b for b, _ in counts], dtype="int32"),
                            "toxic": pd.Series([y for _, y in counts], dtype="int32"),
                            "n": pd.Series(list(counts.values()), dtype="int64")})

    rows = (train.select("text", "toxic").mapInPandas(bins, "bin int, toxic int, n long")
                 .groupBy("bin", "toxic").agg(F.sum("n").alias("n")).collect())
    n_bad, n_clean = (sum(r["n"] for r in rows if r["toxic"] == y) for y in (1, 0))
    # Error per cut between two bins; of equally good cuts the middle one.
    lost = []
    for cut in range(-40, 121):
        missed = sum(r["n"] for r in rows if r["toxic"] == 1 and r["bin"] < cut)
        wrong = sum(r["n"] for r in rows if r["toxic"] == 0 and r["bin"] >= cut)
        lost.append((missed / n_bad + 2 * wrong / n_clean, cut))
    best = min(lost)[0]
    cuts = [cut for e, cut in lost if e == best]
    x = 2 ** ((cuts[len(cuts) // 2] - 0.5) / 8)
    return x * (1 - THRESHOLD) / THRESHOLD


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    prepare(docs.sparkSession)
    return (docs.select("doc_id", "text")
                .select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
                        toxicity_score(F.col("text"), lexicon).alias("score"))
                .select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
