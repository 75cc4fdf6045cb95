"""Benchmark decontamination: CGK random-walk embedding, bit-sampling LSH, exact edit verification.

A document is contaminated by an item if some passage of it is within ``floor((1 - similarity) x
words)`` word edits (insert, delete, replace) of the item; words are lower-cased runs of letters,
digits and underscores, and single characters in scripts written without spaces. Items of fewer than
``MIN_WORDS`` words, which allow no edit, are looked up as they are. For the others windows of the item's size are taken at every word of the whole text. The
CGK embedding walks over a window, writing the current word at each step and moving on where a
random bit of (step, word) says so: texts within a small edit distance then agree in many places.
Sampling a few places gives a key; this is repeated, with fresh random bits, until the measured
chance of one shared key reaches the target recall at the largest allowed number of edits (an index that
can't is an error). Whatever meets on a key is verified by the exact edit distance.

Before embedding, windows that cannot match are left out by the q-gram lemma: within k edits, at
least ``words - 1 - 2k`` of the item's adjacent word pairs are kept. This loses nothing.

The benchmark is the stated query set: it is read in blocks of bounded size, and each block's index
goes to the tasks in a pass of its own, so that the driver and a task hold one block at a time. Documents are
not shuffled. Of an item every place is returned that overlaps no closer one. Defined results: null and empty texts
match nothing and are matched by nothing, as do texts without words; items with equal words all match; repeated
rows match alike; a null item_id is reported as null.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare, tmp_name

SIMILARITY = 0.8
TARGET_RECALL = 0.995
#: Shorter items allow no edit: they are looked up as they are.
MIN_WORDS = 5
#: Places sampled for one key.
PLACES = 2
#: Repetitions tried in turn; each size takes as many as the target needs (measured when the index is built).
REPEATS = (64, 256, 1024)
#: Text bytes of the items in one index block: bounds what a task and the driver hold.
BLOCK_BYTES = 8 << 20
#: Windows embedded or verified in one step.
WINDOW_STEP = 4096
#: Words of all windows of a step together: long items are worked on a few windows at a time.
WINDOW_CELLS = 1 << 20
MATCHES = "array<struct<item_id:bigint,start_word:int,end_word:int,edits:int,similarity:double>>"
_WORD = re.compile(r"\w+")
# Scripts written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han); each character is a word.
_SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SPACELESS_CHAR = re.compile(f"[{_SPACELESS}]")
_WORD_OR_CHAR = re.compile(f"[{_SPACELESS}]|[^\\W{_SPACELESS}]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores; single characters in scripts without spaces."""
    if not text:
        return []
    lower = text.lower()
    return (_WORD if lower.isascii() or not _SPACELESS_CHAR.search(lower) else _WORD_OR_CHAR).findall(lower)


def allowed_edits(n_words: int, similarity: float) -> int:
    return math.floor((1 - similarity) * n_words + 1e-9)


def _step(width: int) -> int:
    return max(1, min(WINDOW_STEP, WINDOW_CELLS // max(1, width)))


def _mix(a: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of the values with a seed."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Walks:
    """All repetitions for one window size: their sampled places, and the random bits of their walks."""

    def __init__(self, size: int, repeats: int):
        # A walk passes a word in two steps on average: later places would be past the end.
        steps = max(PLACES, int(1.8 * size))
        places, odds = [], []
        for repeat in range(repeats):
            draw = np.random.default_rng((size, repeat))
            places.append(np.sort(draw.choice(steps, PLACES, replace=False)))
            odds.append(draw.integers(1 << 62, size=steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        self.places = np.stack(places)
        #: The walk's bit for (step, word) is the top bit of the word's number times an odd random number.
        self.odds = np.stack(odds, axis=1)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Keys (window x repetition) of windows (rows of word numbers); all walks step together."""
        n, width = windows.shape
        flat = np.concatenate((windows + 2, np.ones((n, 1), dtype=np.int64)), axis=1).astype(np.uint64).ravel()
        at = np.zeros((n, len(self.places)), dtype=np.int64)
        row = (np.arange(n) * (width + 1))[:, None]
        key = np.broadcast_to(_mix(np.arange(len(self.places)), 0), at.shape).copy()
        for step in range(int(self.places.max()) + 1):
            symbol = flat.take(row + at)
            sampled = np.flatnonzero((self.places == step).any(axis=1))
            if len(sampled):
                key[:, sampled] = _mix(key[:, sampled] ^ symbol[:, sampled], step + 1)
            at += ((symbol * self.odds[step]) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, width, out=at)
        return key


def fitting_distance(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of rows, the least edits between the item and any stretch of the text, and that stretch
    (start, end). All pairs are worked on together, one item word at a time."""
    n, width = texts.shape
    unit = np.int64(1) << 32
    column = np.arange(width + 1, dtype=np.int64)
    # Cost in the high bits; in the low bits the start, larger (closer) ones first.
    row = np.broadcast_to(unit - 1 - column, (n, width + 1)).copy()
    for i in range(items.shape[1]):
        step = row + unit
        diagonal = row[:, :-1] + np.where(texts == items[:, i:i + 1], 0, unit)
        step[:, 1:] = np.minimum(step[:, 1:], diagonal)
        row = np.minimum.accumulate(step - column * unit, axis=1) + column * unit
    end = np.argmin(row, axis=1)
    best = row[np.arange(n), end]
    return best // unit, unit - 1 - best % unit, end


class Index:
    """One block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, list[str]]], similarity: float = SIMILARITY,
                 target_recall: float = TARGET_RECALL):
        self.similarity = similarity
        kept = [(i, w) for i, w in items if len(w) >= MIN_WORDS]
        brief = [(i, w) for i, w in items if 0 < len(w) < MIN_WORDS]
        self.vocab = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(w for _, w in (*kept, *brief))), 1)}
        self.brief_ids = [i for i, _ in brief]
        self.brief: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({len(w) for _, w in brief}):
            own = np.array([k for k, (_, w) in enumerate(brief) if len(w) == size])
            rows = np.array([[self.vocab[x] for x in brief[k][1]] for k in own.tolist()], dtype=np.int64)
            key = self._brief_key(rows[:, j] for j in range(size))
            order = np.argsort(key, kind="stable")
            self.brief[size] = key[order], own[order], rows[order]
        self.ids = [i for i, _ in kept]
        self.base = len(self.vocab) + 1
        self.by_size: dict[int, np.ndarray] = {}
        numbers: dict[int, list[int]] = {}
        for k, (_, w) in enumerate(kept):
            numbers.setdefault(len(w), []).append(k)
        words = [np.array([self.vocab[x] for x in w], dtype=np.int64) for _, w in kept]
        self.owners = {size: np.array(own) for size, own in sorted(numbers.items())}
        self.by_size = {size: np.stack([words[k] for k in own]) for size, own in self.owners.items()}
        pairs = [w[:-1] * self.base + w[1:] for w in words]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
        self.pairs_of_size = {size: np.append(np.isin(self.pairs, (m[:, :-1] * self.base + m[:, 1:]).ravel()), False)
                              for size, m in self.by_size.items()}
        bits = max(16, min(26, int(math.log2(max(1, len(self.pairs)))) + 6))
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[self._slot(self.pairs)] = True
        # Sizes are screened in brackets: the longest window and the weakest demand hold for all of a bracket.
        self.brackets: list[list[int]] = []
        for size in self.by_size:
            if self.brackets and size <= 1.25 * self.brackets[-1][0]:
                self.brackets[-1].append(size)
            else:
                self.brackets.append([size])
        self.walks = {size: self._calibrated(size, target_recall) for size in self.by_size}
        self.keys = {}
        for size, walks in self.walks.items():  # all repetitions in one sorted array, with the item of each key
            keys = walks.keys(self.by_size[size])
            order = np.argsort(keys, axis=None, kind="stable")
            self.keys[size] = keys.ravel()[order], order // keys.shape[1]

    @staticmethod
    def _brief_key(columns) -> np.ndarray:
        """A hash of rows of word numbers, given column by column."""
        key = None
        for column in columns:
            key = _mix(column, 1) if key is None else _mix(key ^ column.astype(np.uint64), 2)
        return key

    def _find_brief(self, words: np.ndarray, starts: np.ndarray, found: list) -> None:
        """Every place of an item of fewer than ``MIN_WORDS`` words."""
        for size, (keys, own, rows) in self.brief.items():
            n = len(words) - size + 1
            if n < 1:
                continue
            key = self._brief_key(words[j:n + j] for j in range(size))
            low, high = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
            for at in np.flatnonzero(high > low).tolist():
                d = int(np.searchsorted(starts, at, side="right")) - 1
                if at + size > starts[d + 1]:
                    continue  # over the end of its text
                for k in range(int(low[at]), int(high[at])):
                    if (rows[k] == words[at:at + size]).all():
                        begin = int(at - starts[d])
                        found[d].append((self.brief_ids[int(own[k])], begin, begin + size, 0, 1.0))

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _calibrated(self, size: int, target: float) -> Walks:
        """As many repetitions as reach the target for items changed by the largest allowed number of edits."""
        draw = np.random.default_rng(size)
        edits = allowed_edits(size, self.similarity)
        item = self.by_size[size]
        item = item[draw.integers(len(item), size=max(50, min(200, 20_000 // size)))]
        width = size + edits
        changed = np.full((len(item), width), 0, dtype=np.int64)
        for k, row in enumerate(item.tolist()):
            for _ in range(edits):
                at, kind = int(draw.integers(len(row))), int(draw.integers(3))
                if kind == 0:
                    row[at] = 0
                elif kind == 1:
                    row.insert(at, 0)
                else:
                    del row[at]
            changed[k, :len(row)] = row[:width]
        for repeats in REPEATS:
            walks = Walks(size, repeats)
            met = np.cumsum(walks.keys(item) == walks.keys(changed), axis=1) > 0
            reached = met.mean(axis=0) >= target
            if reached.any():
                return Walks(size, max(4, int(np.argmax(reached)) + 1))
        raise ValueError(f"{REPEATS[-1]} repetitions do not reach a recall of {target} for items of {size} words")

    def need(self, size: int) -> int:
        return max(1, size - 1 - 2 * allowed_edits(size, self.similarity))

    def find(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text its matches: (item_id, start_word, end_word, edits, similarity), every place that does not
        overlap a closer (or, as close, earlier) one of the same item."""
        if not self.by_size and not self.brief:
            return [[] for _ in texts]
        get = self.vocab.get
        parts = [list(map(get, words_of(t), repeat(0))) for t in texts]
        starts = np.cumsum([0, *(len(p) for p in parts)])
        words = np.fromiter(chain.from_iterable(parts), dtype=np.int64, count=int(starts[-1]))
        out: list[list[tuple]] = [[] for _ in texts]
        self._find_brief(words, starts, out)
        for exact, per_item in zip(out, self._find_long(words, starts, len(texts))):
            for k in sorted(per_item):
                places: list[tuple] = []
                for match in sorted(per_item[k], key=lambda m: (m[2], m[0], m[1])):
                    if all(match[1] <= p[0] or p[1] <= match[0] for p in places):
                        places.append(match)
                exact += [(self.ids[k], *m) for m in sorted(places)]
        return out

    def _find_long(self, words: np.ndarray, starts: np.ndarray, n_texts: int) -> list[dict[int, set]]:
        found: list[dict[int, set]] = [{} for _ in range(n_texts)]
        if len(words) < 2 or not self.by_size:
            return found
        pair = words[:-1] * self.base + words[1:]
        known = self.table[self._slot(pair)]
        # Number of each known pair among the items' pairs; the last number stands for none.
        slots = np.full(len(pair), len(self.pairs), dtype=np.int32)
        on = np.flatnonzero(known)
        slot = np.minimum(np.searchsorted(self.pairs, pair[on]), len(self.pairs) - 1)
        slots[on] = np.where(self.pairs[slot] == pair[on], slot, len(self.pairs))
        total = np.concatenate(([0], np.cumsum(slots < len(self.pairs), dtype=np.int32)))
        longest = max(self.by_size) + allowed_edits(max(self.by_size), self.similarity)
        total = np.concatenate((total, np.full(longest, total[-1])))
        for bracket in self.brackets:
            reach = max(s + allowed_edits(s, self.similarity) for s in bracket) - 1
            least = min(self.need(s) for s in bracket)
            at = np.flatnonzero(total[reach:reach + len(pair)] - total[:len(pair)] >= least)
            step = _step(reach)
            for lo in range(0, len(at), step):
                for size in bracket:
                    self._match(size, at[lo:lo + step], words, slots, starts, found)
        return found

    def _gather(self, words: np.ndarray, at: np.ndarray, width: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rows of ``width`` words from ``at`` on; places outside the text are 0."""
        place = at[:, None] + np.arange(width)
        inside = (place < end[:, None]) & (place >= first[:, None])
        return np.where(inside, words[np.clip(place, 0, len(words) - 1)], 0)

    def _match(self, size, at, words, slots, starts, found) -> None:
        edits = allowed_edits(size, self.similarity)
        width = size + edits
        doc = np.searchsorted(starts, at, side="right") - 1
        end = starts[doc + 1]
        # Word pairs of items of this very size; pairs over a text's end only let more windows through.
        place = np.minimum(at[:, None] + np.arange(width - 1), len(slots) - 1)
        live = np.flatnonzero(self.pairs_of_size[size][slots[place]].sum(axis=1) >= self.need(size))
        if not len(live):
            return
        at, doc, end = at[live], doc[live], end[live]
        windows = self._gather(words, at, width, starts[doc], end)
        keys, item_of = self.keys[size]
        key = self.walks[size].keys(windows)
        low = np.searchsorted(keys, key.ravel())
        met = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == key.ravel())
        many = np.searchsorted(keys, key.ravel()[met], side="right") - low[met]
        window = np.repeat(met // key.shape[1], many)
        place = np.repeat(low[met], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.unique(window * len(self.owners[size]) + item_of[place])
        step = _step(width + 2 * edits)
        for lo in range(0, len(pairs), step):
            w, item = np.divmod(pairs[lo:lo + step], len(self.owners[size]))
            first = np.maximum(at[w] - edits, starts[doc[w]])
            text = self._gather(words, first, width + 2 * edits, starts[doc[w]], end[w])
            cost, begin, stop = fitting_distance(self.by_size[size][item], text)
            for k in np.flatnonzero(cost <= edits).tolist():
                d = int(doc[w[k]])
                start = int(first[k] + begin[k] - starts[d])
                match = (start, int(first[k] + stop[k] - starts[d]), int(cost[k]), 1 - int(cost[k]) / size)
                number = int(self.owners[size][item[k]])
                found[d].setdefault(number, set()).add(match)


def index_blocks(benchmark: DataFrame, similarity: float = SIMILARITY, target_recall: float = TARGET_RECALL) -> Iterator[Index]:
    """The benchmark as index blocks of bounded size, each collected when it is asked for; at least one."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = sorted(((r["item_id"], r["text"]) for r in items.filter(block == k).collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Index([(i, words_of(t)) for i, t in rows], similarity, target_recall)


def matches_column(text: Column, index: Index) -> Column:
    """All matches of a whole text with one block, as an array of structs."""
    @F.pandas_udf(MATCHES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            names = ("item_id", "start_word", "end_word", "edits", "similarity")
            yield pd.Series([[dict(zip(names, m)) for m in found] for found in index.find(texts.tolist())])
    return run(text)


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, edits, similarity): each place of an item in a document.

    One written pass over the documents per index block: the driver and a task hold one block at a time.
    """
    prepare(docs.sparkSession)
    out = None
    for index in index_blocks(benchmark, similarity):
        found = docs.select("doc_id", "text").select("doc_id", F.inline(matches_column(F.col("text"), index)))
        found = persist(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no item: one written pass per block over what the blocks before have left."""
    prepare(docs.sparkSession)
    found = tmp_name(docs, "leaks")
    blocks, left = iter(index_blocks(benchmark, similarity)), docs
    index = next(blocks)
    while index is not None:
        left = left.withColumn(found, matches_column(F.col("text"), index)).filter(F.size(found) == 0).drop(found)
        index = next(blocks, None)
        if index is not None:
            left = persist(left, "leaks-left")
    return left
