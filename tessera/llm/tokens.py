"""Token counts by prefix dynamic programming over a word-end BPE vocabulary.

For each prefix of a word the last token of its encoding is stored together with the number of
tokens: a token that ends at position k follows the encoding of the prefix before it exactly when
no merge across that border would have come earlier than the merges inside both tokens, and only
one token satisfies this. So one pass gives the exact count at every prefix, and whole texts follow
by summing over words. Truncation ("how much fits in n tokens") and budget questions ("how many
tokens are in the first p characters") are answered from the stored counts, without encoding again.

Text is split into words as the tokenizer file says (normalisation, word pattern, special strings);
characters on which the library's rules and ours differ are left to the library's own splitter.

Defined results: a null or empty text has 0 bytes and 0 tokens; white space counts no token;
repeated rows count alike; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, tokenizer_path

#: Words and token pairs remembered per worker; both memories start anew when full.
MAX_WORDS = 200_000
MAX_PAIRS = 400_000
NEVER = 1 << 60
#: Columns of a text's stored table.
STORED = ("ends", "tokens", "first", "final", "counts")
#: Texts whose new words are counted together.
GROUP = 512


def _byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _letters_first(pattern: str) -> str:
    """The same word pattern with its letter run tried first, if all earlier choices begin with an apostrophe."""
    choices = pattern.split("|")
    run = next((k for k, c in enumerate(choices) if c in (r"[\p{L}]+", r"\p{L}+")), 0)
    return "|".join([choices[run], *choices[:run], *choices[run + 1:]]) if all(
        c.startswith("'") for c in choices[:run]) else pattern


def _ascii_pattern(pattern: str) -> re.Pattern | None:
    """The same lower-case word pattern for ASCII texts, in the faster module; None if it names other classes than
    letters, digits and white space, or names these outside of brackets."""
    if "\\" in re.sub(r"\\p\{[LN]\}|\\s", "", pattern) or "\\" in re.sub(r"\[[^\]]*\]", "", pattern):
        return None
    # The two modules differ on which control characters are white space.
    return re.compile(pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", r" \t-\r"))


class PrefixCounter:
    """Exact token counts at every prefix for one tokenizer file (BPE with an end-of-word suffix)."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        ids = self.vocab
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)}
        self.made = {ids[a + b]: (ids[a], ids[b], r) for r, (a, b) in reversed([*enumerate(merges)])}
        self.symbols = {i: self._chars(t) for t, i in ids.items()}
        self.table = {b: s for b, s in enumerate(_byte_symbols())}
        self.pairs: dict[int, bool] = {}
        self.sound: dict[int, bool] = {}
        self.left: dict[int, tuple] = {}
        self.right: dict[int, tuple] = {}
        self.words: dict[str, int] = {}
        self.inner: dict[str, list[int] | None] = {}
        # A character with those that normalisation may join to it.
        self.segment = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+|(?s:.)[\p{M}\u1160-\u11ff]*")
        self.joining = regex.compile(r"[\p{M}\u1160-\u11ff]")
        self.ends = self._suffix_tree()
        self.library = Tokenizer.from_file(path)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(_letters_first(split))
        self.ascii = _ascii_pattern(_letters_first(split))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        self.plain = {chr(c) for c in range(128) if self._agree(chr(c))}
        self.odd: set[str] = {chr(c) for c in range(128)} - self.plain

    # Words of a text.

    def _normal(self, text: str) -> str:
        return unicodedata.normalize("NFC", text).lower()

    def _agree(self, char: str) -> bool:
        """Whether our splitting of a text with ``char`` is the library's."""
        if char in "Σ":  # lower case depends on what follows
            return False
        sample = f"a{char}1 {char}{char}b"
        theirs = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(sample))]
        return [self._mapped(p) for p in self.pattern.findall(self._normal(sample))] == theirs

    def _mapped(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isalnum() else piece.encode("utf-8").decode("latin-1").translate(self.table)

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        chars = set(text)
        for c in chars - self.plain - self.odd:
            (self.plain if self._agree(c) else self.odd).add(c)
        if chars & self.odd:
            back = {s: b for b, s in self.table.items()}
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(back[c] for c in p).decode("utf-8", "replace") for p, _ in split]
        if self.ascii and text.isascii():
            return self.ascii.findall(text.lower())
        return self.pattern.findall(self._normal(text))

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """(part, is special string) in order."""
        at = 0
        for m in self.special.finditer(text) if self.special and "<" in text else ():
            if m.start() > at:
                yield text[at:m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    # Tokens of a word.

    def _chars(self, token: str) -> list[str]:
        body = token.removesuffix(self.suffix) if self.suffix else token
        chars = list(body)
        if len(body) < len(token) and chars:
            chars[-1] += self.suffix
        return chars

    def _spine(self, token: int, right: bool) -> tuple:
        """The symbols on a token's border from large to small, each with the merge that uses it up."""
        known = self.right if right else self.left
        if token not in known:
            out, at, used = [], token, NEVER
            while True:
                out.append((at, used))
                if at not in self.made:
                    break
                a, b, used = self.made[at]
                at = b if right else a
            known[token] = tuple(out)
        return known[token]

    def fits(self, first: int, second: int) -> bool:
        """Whether encoding the two tokens' joint text gives just these two."""
        key = first << 32 | second
        out = self.pairs.get(key)
        if out is None:
            rank = self.rank
            # A merge over the border wins if both its symbols still stand then; of equal merges the left one.
            out = not any((r := rank.get((a, b))) is not None and r < used_a and r <= used_b
                          for a, used_a in self._spine(first, True) for b, used_b in self._spine(second, False))
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            self.pairs[key] = out
        return out

    def _sound(self, token: int) -> bool:
        """Whether the token's own text encodes to the token alone: a merge of two sound tokens
        that meet at its rank and not before."""
        out = self.sound.get(token)
        if out is None:
            if token not in self.made:
                out = len(self.symbols[token]) == 1
            else:
                a, b, made = self.made[token]
                earlier = any((r := self.rank.get((x, y))) is not None and r < used_x and r <= used_y and (x, y) != (a, b)
                              and r < made for x, used_x in self._spine(a, True) for y, used_y in self._spine(b, False))
                out = self._sound(a) and self._sound(b) and not earlier
            self.sound[token] = out
        return out

    def _suffix_tree(self) -> dict:
        """Sound tokens read from their last character backwards; a node's token is under "open" (inside a
        word) or "closed" (at a word's end)."""
        root: dict = {}
        for token, number in self.vocab.items():
            if self._sound(number):
                body = token.removesuffix(self.suffix) if self.suffix else token
                node = root
                for char in reversed(body):
                    node = node.setdefault(char, {})
                if body == token:
                    node["open"] = number
                if body != token or not self.suffix:
                    node["closed"] = number
        return root

    def _ending(self, word: str, k: int, kind: str) -> list[tuple[int, int]]:
        """(start, token) of the tokens that end at ``k``, the shortest first."""
        node, j, out = self.ends, k, []
        while j:
            j -= 1
            node = node.get(word[j])
            if node is None:
                break
            token = node.get(kind)
            if token is not None:
                out.append((j, token))
        return out

    def extend(self, word: str, last: list[int], count: list[int], upto: int) -> None:
        """Store last token and token count of every prefix up to length ``upto``, each read as the start
        of a longer word; what is stored already stays."""
        pairs, fits, root = self.pairs, self.fits, self.ends
        for k in range(len(last), upto + 1):
            # As _ending, which is too dear to call here.
            node, found = root, []
            for j in range(k - 1, -1, -1):
                node = node.get(word[j])
                if node is None:
                    break
                if "open" in node:
                    found.append((j, node["open"]))
            for j, token in reversed(found):
                if not j or (ok := pairs.get(last[j] << 32 | token)) or (ok is None and fits(last[j], token)):
                    last.append(token)
                    count.append(count[j] + 1)
                    break
            else:
                raise ValueError(f"no token ends at {k} in {word!r}")

    def prefixes(self, word: str) -> tuple[list[int], list[int]]:
        """Last token and token count of every prefix of a mapped word."""
        last, count = [-1], [0]
        self.extend(word, last, count, len(word))
        return last, count

    def closed(self, word: str, last: list[int], count: list[int], k: int | None = None) -> int:
        """Tokens of the first ``k`` characters read as a whole word, from the stored shorter prefixes."""
        k = len(word) if k is None else k
        for j, token in reversed(self._ending(word, k, "closed")):
            if not j or self.fits(last[j], token):
                return count[j] + 1
        if k:
            raise ValueError(f"no token ends {word[:k]!r}")
        return 0

    def learn(self, pieces: set[str]) -> None:
        """Count the pieces not met before. In sorted order a word goes on from the prefixes that it
        shares with the word before."""
        if len(self.words) + len(pieces) > MAX_WORDS:
            self.words.clear()
        before, last, count = "", [-1], [0]
        for word, piece in sorted((self._mapped(p), p) for p in pieces):
            shared, most = 0, min(len(before), len(word), len(last) - 1)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], count[shared + 1:]
            self.extend(word, last, count, len(word) - 1)
            self.words[piece] = self.closed(word, last, count)
            before = word

    def of_piece(self, piece: str) -> int:
        if piece not in self.words:
            self.learn({piece})
        return self.words[piece]

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text; the new words of all of them are learned together."""
        return [n for n, _ in self.summaries(texts, NEVER)]

    def summaries(self, texts: list[str | None], budget: int) -> list[tuple[int, int]]:
        """(tokens, code points of the longest prefix with at most ``budget`` tokens) of each whole text; a text within
        the budget fits whole. The new words of all of them are learned together."""
        split = []
        for text in texts:
            parts = [None if special else self.pieces(part) for part, special in self.parts(text or "")]
            split.append(parts)
        fresh = {w for parts in split for words in parts if words for w in words} - self.words.keys()
        if fresh:
            if len(self.words) + len(fresh) > MAX_WORDS:
                self.words.clear()
                fresh = {w for parts in split for words in parts if words for w in words}
            self.learn(fresh)
        get = self.words.__getitem__
        totals = [sum(1 if words is None else sum(map(get, words)) for words in parts) for parts in split]
        # Where the budget ends is noted before anything else is learned, which may start the memory anew.
        starts = [self._start(parts[0], budget) if n > budget and len(parts) == 1 and parts[0] else None for n, parts in zip(totals, split)]
        return [(n, len(text or "") if n <= budget else self.fit(text, budget, start)) for n, text, start in zip(totals, texts, starts)]

    def _start(self, words: list[str], budget: int) -> tuple[list[str], int]:
        """The words up to the one that goes over the budget, and the tokens before that one."""
        before = 0
        for k, word in enumerate(words):
            n = self.words[word]
            if before + n > budget:
                return words[:k + 1], before
            before += n
        raise ValueError("the words are within the budget")

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]

    @staticmethod
    def _places(words: list[str], whole: str) -> Iterator[tuple[str, int, int]]:
        """(word, start, end) in the normalised part, in order."""
        seek = 0
        for w in words:
            at = max(whole.find(w, seek), seek)
            seek = at + len(w)
            yield w, at, seek

    def _aligned(self, part: str) -> tuple[list[tuple[str, int, int]], list[int] | None]:
        """(word, start, end in the normalised part) in order, and the offset in ``part`` of each normalised offset:
        -1 where none is; None if all are the same, empty if they cannot be told."""
        words = self.pieces(part)
        normal = self._normal if not set(part) & self.odd else self.library.normalizer.normalize_str
        whole = normal(part)
        found = list(self._places(words, whole))
        if len(whole) == len(part) and unicodedata.is_normalized("NFC", part):
            return found, None
        # Characters that join the one before are normalised with it; there is no cut inside.
        known: dict[str, str] = {}
        where, made, at = [0], [], 0
        for seg in self.segment.findall(part):
            if seg not in known:
                known[seg] = normal(seg)
            at += len(seg)
            made.append(known[seg])
            if known[seg]:
                where += [-1] * (len(known[seg]) - 1) + [at]
            else:
                where[-1] = at
        if "".join(made) != whole:
            return found, []
        return found, where

    def _inside(self, word: str) -> list[int]:
        """Tokens of the first 1, 2, … characters of a word, each read as a whole text; from one pass over it."""
        if word not in self.inner:
            if len(self.inner) >= MAX_WORDS:
                self.inner.clear()
            if word.startswith("'"):  # a contraction's start is more than one word
                self.inner[word] = [sum(map(self.of_piece, self.pieces(word[:k]))) for k in range(1, len(word) + 1)] if len(word) <= 3 else None
            if self.inner.get(word) is None:
                mapped = self._mapped(word)
                last, count = [-1], [0]
                self.extend(mapped, last, count, len(mapped) - 1)
                self.inner[word] = [self.closed(mapped, last, count, k) for k in accumulate(len(c.encode("utf-8")) for c in word)]
        return self.inner[word]

    def _cells(self, text: str | None) -> Iterator[tuple[int, int, Callable[[], list[tuple[int, int]]]]]:
        """(end, tokens, cuts) of each word and special string; ``cuts()`` gives (offset, tokens of the cell up
        to there) for the offsets inside. All offsets are code points of the text."""
        at, before = 0, None
        for part, special in self.parts(text or ""):
            if special:
                touched = before[:2] if before and before[2] == at else (at, 0)

                def cuts(at=at, part=part, touched=touched):
                    # A cut special string is plain text, and goes on the word that it touches.
                    return [(at + k, self.count(text[touched[0]:at + k]) - touched[1]) for k in range(1, len(part))]
                yield at + len(part), 1, cuts
                before = None
            else:
                words, where = self._aligned(part)
                if where == []:
                    # Each prefix is counted by itself.
                    yield at + len(part), self.count(part), lambda at=at, part=part: [
                        (at + k, self.count(part[:k])) for k in range(1, len(part))]
                    before, at = (at, self.count(part), at + len(part)), at + len(part)
                    continue
                group: list[tuple[str, int, int]] = []
                for word, a, b in words:
                    group.append((word, a, b))
                    if where is not None and where[b] < 0:
                        continue  # it ends inside a character's normalised form, where no cut is
                    def cuts(at=at, group=tuple(group), where=where):
                        out, total = [], 0
                        for word, a, _ in group:
                            for q, n in enumerate(self._inside(word)[:-1], a + 1):
                                if where is None or where[q] >= 0:
                                    out.append((at + (q if where is None else where[q]), total + n))
                            total += self.of_piece(word)
                        return out
                    start, end = (group[0][1], b) if where is None else (max(where[:group[0][1] + 1]), where[b])
                    n = sum(self.of_piece(w) for w, _, _ in group)
                    yield at + end, n, cuts
                    before, group = (at + start, n, at + end), []
            at += len(part)

    def stored(self, text: str | None) -> tuple[list[int], ...]:
        """The stored table of a text: for each word its end (code points of the text) and the tokens up to there;
        then the count of tokens at every prefix, as runs of prefixes with the same count: first and last length, count."""
        ends, tokens, first, final, counts, total = [], [], [0], [0], [0], 0
        for end, n, cuts in self._cells(text):
            for cut, inner in [*cuts(), (end, n)]:
                if total + inner != counts[-1]:
                    first.append(cut)
                    final.append(cut)
                    counts.append(total + inner)
                final[-1] = cut
            total += n
            ends.append(end)
            tokens.append(total)
        return ends, tokens, first, final, counts

    def at_prefix(self, text: str, chars: int, table: tuple[list[int], ...] | None = None) -> int:
        """Tokens of ``text[:chars]``, read from the stored table; only where the cut parts characters that
        normalisation joins, the cut word is counted anew."""
        ends, tokens, first, _, counts = table or self.stored(text)
        if 0 < chars < len(text) and self.joining.match(text, chars):
            k = max(0, bisect_right(ends, chars - 1) - 1)  # a word earlier: without its mark a letter may end a contraction
            return (tokens[k - 1] if k else 0) + self.count(text[ends[k - 1] if k else 0:chars])
        return counts[bisect_right(first, chars) - 1]

    def fitting(self, table: tuple[list[int], ...], budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens, without white space after it."""
        ends, tokens, first, final, counts = table
        k = bisect_right(tokens, budget)
        # Inside the word that goes over, more characters can be fewer tokens: the last run that fits counts.
        j = bisect_right(first, ends[k]) if k < len(ends) else len(first)
        return next((final[i] for i in range(j - 1, -1, -1) if counts[i] <= budget), 0)

    def fit(self, text: str | None, budget: int, start: tuple[list[str], int] | None = None) -> int:
        """``fitting`` for one budget: only the word that goes over is looked into. ``start`` (``_start`` of a text that
        is one part) saves looking at the words after it, where normalisation moves no character."""
        if start and not set(text) & self.odd and unicodedata.is_normalized("NFC", text):
            whole = self._normal(text)
            if len(whole) == len(text):
                words, total = start
                placed = list(self._places(words, whole))
                word, at, _ = placed[-1]
                return max([placed[-2][2] if len(placed) > 1 else 0,
                            *(cut for cut, n in enumerate(self._inside(word)[:-1], at + 1) if total + n <= budget)])
        best = total = 0
        for end, n, cuts in self._cells(text):
            if total + n > budget:
                return max([best, *(cut for cut, inner in cuts() if total + inner <= budget)])
            best, total = end, total + n
        return best


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of a tokenizer file, made once per worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def token_summary(text: Column, name: str, budget: int) -> Column:
    """struct(n_tokens, fit_chars): the whole count, and what of the text fits in ``budget`` tokens."""
    @F.pandas_udf("n_tokens long, fit_chars long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(tokenizer_path(name))
        for texts in batches:
            texts = texts.tolist()
            found = [s for at in range(0, len(texts), GROUP) for s in c.summaries(texts[at:at + GROUP], budget)]
            counts, fit = ([s[k] for s in found] for k in (0, 1))
            yield pd.DataFrame({"n_tokens": pd.Series(counts, dtype="int64"), "fit_chars": pd.Series(fit, dtype="int64")})
    return run(text)


def prefix_table(docs: DataFrame, name: str) -> DataFrame:
    """(doc_id, ends, tokens, first, final, counts): the stored counts of every row, for later budget and truncation questions."""
    prepare(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} array<int>" for c in STORED))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = counter(tokenizer_path(name))
        for texts in batches:
            rows = [c.stored(t) for t in texts]
            yield pd.DataFrame({c: [r[k] for r in rows] for k, c in enumerate(STORED)})
    return docs.select("doc_id", run(F.col("text")).alias("p")).select("doc_id", *(f"p.{c}" for c in STORED))


def count_tokens(docs: DataFrame, name: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) for every row of ``docs``."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                                                token_summary(F.col("text"), name, limit).alias("s"))
    return rows.select("doc_id", "n_bytes", F.col("s.n_tokens").alias("n_tokens"),
                       (F.col("s.n_tokens") > limit).alias("over_limit"), F.col("s.fit_chars").alias("fit_chars"))
