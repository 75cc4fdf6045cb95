"""Cross-tokenizer alignment: galloping intersection of the two tokenizers' byte ends.

A text is encoded twice: a space and the text by a byte-level BPE (A), the text by a sentencepiece
model that adds that space (B). Both cut the same bytes, so each side is an ascending list of end
offsets. Each end of the shorter list is looked up in the longer one: an exponential search from the
place of an earlier end, then a binary search in the range it leaves. Ends found on both sides cut
the tokens into groups. The rank of an end among the other side's ends tells which tokens overlap:
token i of the shorter side overlaps the longer side's tokens from the number of ends up to i's start
to the number of ends below i's end.

How often an id pair is linked is a count over the corpus. Texts are encoded once; the links of about
``BLOCK_LINKS`` are held as numbers of the block's distinct pairs and written with the block's counts.
The counts are added up by ranges of pairs (a hash deals them, so no range is hot; a range's distinct
pairs are bounded by the product of the vocabularies over the number of ranges), the totals go back to
the blocks that have the pair, and the blocks' links become one short row per document. Of all counts only
each B id's highest reaches the driver: one number per entry of B's vocabulary.

Memory: texts are aligned in windows of ``WINDOW`` tokens that end at a common end, so that a long text
costs its ids and ends (about 60 bytes per token) and no more; its links may lie in several blocks.

Defined results: texts that are null or empty, or whose joined A or B bytes are not those of a space and
the text, have no tokens: zeros and an empty ``groups_sha256``. Repeated rows and rows without doc_id are
rows like any other, and count. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare, tokenizer_path

#: Tokens of the shorter side aligned at a time.
WINDOW = 1 << 18
#: Ends that share one starting place of the exponential search.
STRIDE = 8
#: Links of which the pairs are numbered and counted together.
BLOCK_LINKS = 4_000_000
#: Links and pairs per written row: bounds an Arrow batch.
LINK_ROW, PAIR_ROW = 1 << 16, 1 << 14
#: Characters of different words whose pieces a worker remembers.
MEMO_CHARS = 4 << 20
#: Input bytes per range of pairs.
RANGE_BYTES = 64 << 20


# ---- the two sides -------------------------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """Character → byte of the byte-level alphabet: printable bytes stand for themselves, the others
    follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class ByteSide:
    """A byte-level BPE of a ``tokenizers`` file. Special strings in texts are plain text.

    If the file's merges come in the order of the ids they make, and it splits by the public pattern,
    ``tiktoken`` gives the same ids several times faster (tests compare them); else the library itself is used.
    """

    def __init__(self, name: str):
        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], _byte_alphabet()
        special = {t["id"]: t["content"] for t in spec.get("added_tokens", ())}
        self.size = max([*vocab.values(), *special]) + 1
        self.pieces = [b""] * self.size
        ranks = {}
        for token, k in vocab.items():
            if k not in special:
                self.pieces[k] = bytes(alphabet[c] for c in token)
                ranks[self.pieces[k]] = k
        for k, token in special.items():
            self.pieces[k] = token.encode()
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int32)
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        made = [vocab[m.replace(" ", "", 1)] for m in merges]
        splits = spec.get("pre_tokenizer") or {}
        plain = (splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and not splits.get("add_prefix_space")
                 and not spec.get("normalizer") and not spec["model"].get("ignore_merges"))
        self._fast = self._slow = None
        if plain and made == sorted(made):
            import tiktoken
            from public_tokenizers import PATTERN
            self._fast = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(path)
            self._slow.encode_special_tokens = True

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of a space and each text, and whether their bytes are those of it."""
        given = [" " + t for t in texts]
        if self._fast is not None:
            ids = [self._fast.encode_to_numpy(g, disallowed_special=()).astype(np.int32) for g in given]
            # Tokens are slices of the text in order: nothing is missing if the lengths add up.
            return ids, [int(self.lengths[i].sum()) == len(g.encode()) for i, g in zip(ids, given)]
        found = [e.ids for e in self._slow.encode_batch_fast(given, add_special_tokens=False)]
        same = [b"".join(map(self.pieces.__getitem__, i)) == g.encode() for i, g in zip(found, given)]
        return [np.array(i, dtype=np.int32) for i in found], same


class PieceSide:
    """A sentencepiece model that adds one space. U+2581 in a piece is a space, <0xHH> a byte.

    If it changes no characters and no piece goes on behind a space, the words of a text (with the spaces
    before them) are encoded on their own, each once per worker while it is remembered.
    """

    def __init__(self, name: str):
        import sentencepiece
        path = tokenizer_path(name)
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        names = [self._model.id_to_piece(k) for k in range(self.size)]
        self.pieces = [bytes([int(p[3:5], 16)]) if self._model.is_byte(k) else p.replace("▁", " ").encode()
                       for k, p in enumerate(names)]
        self.lengths = np.array([len(p) for p in self.pieces], dtype=np.int32)
        self._space = self._model.piece_to_id("▁")
        self._by_word = self._keeps_characters(path) and not any(re.search("[^▁]▁", p) for p in names)
        self._spaced = re.compile(" +[^ ]*").findall
        self._forget()

    @staticmethod
    def _keeps_characters(path: str) -> bool:
        try:
            from sentencepiece import sentencepiece_model_pb2 as layout
        except ImportError:  # without protobuf the model's settings can't be read: whole texts are encoded
            return False
        model = layout.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        return (rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
                and not rules.normalization_rule_tsv and not model.trainer_spec.treat_whitespace_as_suffix)

    def _forget(self) -> None:
        # A single space at the end is the only word that the model alone would not see.
        self._known, self._chars = {"": 0}, 0
        self._ids, self._count, self._same = np.array([self._space], dtype=np.int32), np.array([1]), np.array([True])

    def _learn(self, words: list[str]) -> None:
        found = self._model.encode(words, num_threads=1)
        same = [b"".join(map(self.pieces.__getitem__, i)) == b" " + w.encode() for i, w in zip(found, words)]
        self._known.update(zip(words, itertools.count(len(self._count))))
        self._chars += sum(map(len, words))
        total = sum(map(len, found))
        self._ids = np.concatenate((self._ids, np.fromiter(itertools.chain.from_iterable(found), dtype=np.int32, count=total)))
        self._count = np.concatenate((self._count, np.fromiter(map(len, found), dtype=np.int64, count=len(found))))
        self._same = np.concatenate((self._same, np.array(same, dtype=bool)))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether their bytes are those of a space and the text."""
        if not self._by_word:
            found = self._model.encode(texts, num_threads=1)
            same = [b"".join(map(self.pieces.__getitem__, i)) == b" " + t.encode() for i, t in zip(found, texts)]
            return [np.array(i, dtype=np.int32) for i in found], same
        if self._chars > MEMO_CHARS:
            self._forget()
        words = []
        for t in texts:
            parts = t.split(" ")
            # More than one space in a row belongs to the word behind it.
            words.append([w[1:] for w in self._spaced(" " + t)] if "" in parts else parts)
        known = self._known
        fresh = [w for w in set(itertools.chain.from_iterable(words)) if w not in known]
        if fresh:
            self._learn(fresh)
        out, fine, start = [], [], np.cumsum(self._count) - self._count
        for parts in words:
            k = np.fromiter(map(known.__getitem__, parts), dtype=np.int64, count=len(parts))
            n = self._count[k]
            at = np.repeat(start[k] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out.append(self._ids[at])
            fine.append(bool(self._same[k].all()))
        return out, fine


_SIDES: dict[tuple[str, str], ByteSide | PieceSide] = {}


def side(name: str, kind: type) -> ByteSide | PieceSide:
    """The worker's own encoder of a file."""
    if (name, kind.__name__) not in _SIDES:
        _SIDES[(name, kind.__name__)] = kind(name)
    return _SIDES[(name, kind.__name__)]


# ---- one alignment -------------------------------------------------------------------------------

def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """For each needle the number of smaller entries of ``hay``; both ascending, the last of ``hay`` no smaller than any needle.

    Every ``STRIDE``-th needle is placed first, in the same way. The others start at its place: steps double
    until an entry is no smaller, then the range left is halved.
    """
    if len(needles) > STRIDE:
        low = np.repeat(gallop(needles[::STRIDE], hay), STRIDE)[:len(needles)]
    else:
        low = np.zeros(len(needles), dtype=np.int64)
    going = np.flatnonzero(hay[low] < needles)
    below, above, step = low[going], low[going], 1   # hay[below] < needle; above is still to be found
    start, want, left = below.copy(), needles[going], np.arange(len(going))
    while len(left):
        at = np.minimum(start[left] + step, len(hay) - 1)
        smaller = hay[at] < want[left]
        above[left] = at
        left = left[smaller]
        below[left] = at[smaller]
        step *= 2
    left = np.flatnonzero(above - below > 1)
    while len(left):
        middle = (below[left] + above[left]) >> 1
        smaller = hay[middle] < want[left]
        below[left] = np.where(smaller, middle, below[left])
        above[left] = np.where(smaller, above[left], middle)
        left = left[above[left] - below[left] > 1]
    low[going] = above
    return low


def aligned(a_ends: np.ndarray, b_ends: np.ndarray, window: int = WINDOW) -> Iterator[tuple]:
    """The alignment in windows (a from, a to, b from, b to, link a, link b, cut a, cut b).

    Both end lists end at the same offset. Links are overlapping (a, b) token numbers in order; cuts are
    the numbers of the tokens with common ends. A window ends at a common end.
    """
    swapped = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if swapped else (a_ends, b_ends)
    at = base = 0
    while at < len(short):
        size = window
        while True:
            part = short[at:at + size]
            rank = gallop(part, long[base:]) + base
            both = long[rank] == part
            if both.any():
                break
            size *= 2  # the last end is common
        n = int(np.flatnonzero(both)[-1]) + 1
        rank, both = rank[:n], both[:n]
        first = np.concatenate(([base], (rank + both)[:-1]))
        many = rank - first + 1
        near = np.repeat(np.arange(at, at + n), many)
        far = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(near))
        mine = np.flatnonzero(both)
        own, other = (at, at + n), (base, int(rank[-1]) + 1)
        if swapped:
            yield (*other, *own, far, near, rank[mine], mine + at)
        else:
            yield (*own, *other, near, far, mine + at, rank[mine])
        at, base = own[1], other[1]


class GroupText:
    """The groups of texts as ``a1,a2|b1;a3|b2,b3``, hashed as they come."""

    def __init__(self, a_size: int, b_size: int):
        self._words = [f"{k}{end}" for k in range(a_size) for end in ",|"] + [f"{k}{end}" for k in range(b_size) for end in ",;"]
        self._b_from = 2 * a_size

    def codes(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Both sides' tokens of a window, group by group; ``cut_*`` are the last tokens of the groups."""
        out = np.empty(len(a) + len(b), dtype=np.int64)
        for ids, cut, other, base, ahead in ((a, cut_a, cut_b, 0, False), (b, cut_b, cut_a, self._b_from, True)):
            last = np.zeros(len(ids), dtype=np.int64)
            last[cut] = 1
            group = np.cumsum(last) - last
            # A's tokens come behind the B tokens of earlier groups, B's behind A's of their own as well.
            before = other + 1 if ahead else np.concatenate(([0], other[:-1] + 1))
            out[np.arange(len(ids)) + before[group]] = base + 2 * ids + last
        return out

    def text(self, codes: np.ndarray) -> str:
        return "".join(itemgetter(*codes.tolist())(self._words))


# ---- blocks of links -----------------------------------------------------------------------------

def _packed(*arrays: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpacked(body: bytes, *kinds: str) -> list[np.ndarray]:
    """Equally long arrays of these types."""
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(body)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, dtype=k, count=n, offset=at))
        at += n * np.dtype(k).itemsize
    return out


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)


ENCODED = ("kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "block long, part long, n_pairs long, rows binary, links binary, pairs binary")
_FIELDS = [f.strip().split()[0] for f in ENCODED.split(",")]
DOC, LINKS, PAIRS = 0, 1, 2


class _Blocks:
    """Gathers links and gives, block by block, rows of links and rows of counted pairs."""

    def __init__(self, first: int, ranges: int):
        self.block, self.ranges = first, ranges
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows, self.many, self.held = [], [], [], 0

    def add(self, keys: np.ndarray, rows: np.ndarray, many: np.ndarray) -> None:
        self.keys.append(keys)
        self.rows.append(rows)
        self.many.append(many)
        self.held += len(keys)

    def flush(self) -> Iterator[dict]:
        if not self.held:
            return
        keys, rows, many = np.concatenate(self.keys), np.concatenate(self.rows), np.concatenate(self.many)
        code, pairs = pd.factorize(keys)
        count = np.bincount(code, minlength=len(pairs))
        each = np.repeat(rows, many)
        for at in range(0, len(code), LINK_ROW):
            own, n = np.unique(each[at:at + LINK_ROW], return_counts=True)  # rows come in ascending order
            yield {"kind": LINKS, "block": self.block, "n_pairs": len(pairs), "rows": _packed(own.astype("<i8"), n.astype("<i8")),
                   "links": _packed(code[at:at + LINK_ROW].astype("<u4"))}
        part = _range_of(pairs, self.ranges)
        order = np.lexsort((pairs, part))
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        for some in np.split(order, cuts):
            for at in range(0, len(some), PAIR_ROW):
                k = some[at:at + PAIR_ROW]
                yield {"kind": PAIRS, "block": self.block, "part": int(part[k[0]]), "n_pairs": len(pairs),
                       "pairs": _packed(pairs[k].astype("<i8"), count[k].astype("<i8"), k.astype("<u4"))}
        self.block += 1
        self._clear()


def _encode_batch(ids: np.ndarray, texts: list, a: ByteSide, b: PieceSide, words: GroupText, blocks: _Blocks, first_row: int,
                  window: int, block_links: int) -> Iterator[dict]:
    """Document rows of a batch, and the blocks it fills."""
    given = [k for k, t in enumerate(texts) if t]
    a_ids, a_same = a.encode([texts[k] for k in given])
    b_ids, b_same = b.encode([texts[k] for k in given])
    fine = [j for j in range(len(given)) if a_same[j] and b_same[j]]
    rows = {k: {"kind": DOC, "row": first_row + k, "doc_id": ids[k], "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
            for k in range(len(texts))}
    if fine:
        n_a, n_b = np.array([len(a_ids[j]) for j in fine]), np.array([len(b_ids[j]) for j in fine])
        a_all, b_all = np.concatenate([a_ids[j] for j in fine]), np.concatenate([b_ids[j] for j in fine])
        # Texts have as many bytes on either side, so all of them are one alignment: their ends are common ends.
        a_ends, b_ends = np.cumsum(a.lengths[a_all], dtype=np.int64), np.cumsum(b.lengths[b_all], dtype=np.int64)
        a_last, b_last = np.cumsum(n_a), np.cumsum(n_b)
        n_groups, n_links, hashes = np.zeros(len(fine), dtype=np.int64), np.zeros(len(fine), dtype=np.int64), {}
        number = np.array([given[j] for j in fine]) + first_row
        for a0, a1, b0, b1, link_a, link_b, cut_a, cut_b in aligned(a_ends, b_ends, window):
            d0, d1 = np.searchsorted(a_last, (a0, a1 - 1), side="right")
            docs = np.arange(d0, d1 + 1)
            many = np.diff(np.searchsorted(link_a, a_last[d0:d1], side="left"), prepend=0, append=len(link_a))
            n_links[docs] += many
            n_groups[docs] += np.diff(np.searchsorted(cut_a, a_last[d0:d1], side="left"), prepend=0, append=len(cut_a))
            blocks.add(a_all[link_a].astype(np.int64) * b.size + b_all[link_b], number[docs], many)
            if blocks.held >= block_links:
                yield from blocks.flush()
            codes, at = words.codes(a_all[a0:a1], b_all[b0:b1], cut_a - a0, cut_b - b0), 0
            for d in docs.tolist():
                to = min(int(a_last[d]), a1) - a0 + min(int(b_last[d]), b1) - b0
                text, done = words.text(codes[at:to]), a_last[d] <= a1
                hashes.setdefault(d, hashlib.sha256()).update((text[:-1] if done else text).encode())
                at = to
        for d, j in enumerate(fine):
            rows[given[j]] |= {"n_a": int(n_a[d]), "n_b": int(n_b[d]), "n_groups": int(n_groups[d]), "n_links": int(n_links[d]),
                               "groups_sha256": hashes[d].hexdigest()}
    yield from rows.values()


def encoded(docs: DataFrame, a_name: str, b_name: str, ranges: int, window: int = WINDOW, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One written table of document rows, rows of links and rows of counted pairs (``kind``)."""
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId() << 40
        a, b = side(a_name, ByteSide), side(b_name, PieceSide)
        words, blocks, row = GroupText(a.size, b.size), _Blocks(task, ranges), task
        for batch in batches:
            ids = [None if i is None or i != i else int(i) for i in batch["doc_id"].tolist()]
            yield from _frames(_encode_batch(ids, batch["text"].tolist(), a, b, words, blocks, row, window, block_links))
            row += len(batch)
        yield from _frames(blocks.flush())

    # Ids travel as text: a null among integers would turn them into floats.
    some = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return persist(some.mapInPandas(run, ENCODED), "crosstoken-encoded")


def _frames(rows: Iterator[dict], most: int = 256) -> Iterator[pd.DataFrame]:
    while some := list(itertools.islice(rows, most)):
        frame = pd.DataFrame(some, columns=_FIELDS, dtype=object)
        yield frame.astype({c: "Int64" for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "block", "part", "n_pairs")})


# ---- counts over the corpus ----------------------------------------------------------------------

def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first)


def _by_key(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[int, Iterator]]:
    """(key, rows) of a stream sorted by ``key``; rows are read as they come."""
    rows = (r for batch in batches for r in batch.itertuples(index=False))
    return itertools.groupby(rows, key=lambda r: getattr(r, key))


def pair_totals(pairs: DataFrame) -> DataFrame:
    """(part, body): each range's pairs in ascending order with their counts over the corpus, in rows of ``PAIR_ROW``."""
    def run(batches):
        for part, rows in _by_key(batches, "part"):
            keys, counts, held = [], [], 0
            for r in rows:
                key, n, _ = _unpacked(r.pairs, "<i8", "<i8", "<u4")
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > 4 * max(len(keys[0]), 1 << 18):  # what is held stays within a multiple of the distinct pairs
                    key, n = _added(keys, counts)
                    keys, counts, held = [key], [n], len(key)
            key, n = _added(keys, counts)
            for at in range(0, len(key), PAIR_ROW):
                yield pd.DataFrame({"part": [part], "body": [_packed(key[at:at + PAIR_ROW].astype("<i8"), n[at:at + PAIR_ROW].astype("<i8"))]})

    return persist(pairs.select("part", "pairs").repartition("part").sortWithinPartitions("part").mapInPandas(run, "part long, body binary"),
                   "crosstoken-totals")


def highest_by_id(totals: DataFrame, b_size: int) -> np.ndarray:
    """The highest count of a pair of each B id: one number per entry of the vocabulary."""
    def run(batches):
        most = np.zeros(b_size, dtype=np.int64)
        for batch in batches:
            for body in batch["body"]:
                key, n = _unpacked(body, "<i8", "<i8")
                np.maximum.at(most, key % b_size, n)
        seen = np.flatnonzero(most)
        yield pd.DataFrame({"b": seen, "n": most[seen]})

    out = np.zeros(b_size, dtype=np.int64)
    for r in totals.select("body").mapInPandas(run, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out


def _answers(pairs: DataFrame, totals: DataFrame, most: np.ndarray) -> DataFrame:
    """(block, n_pairs, body): for the pairs of a block (by their numbers) the totals and whether they are the B id's highest."""
    b_size = len(most)

    def run(batches):
        for _, rows in _by_key(batches, "part"):
            keys, counts = [], []
            key = None
            for r in rows:
                if r.asked == 0:
                    k, n = _unpacked(r.body, "<i8", "<i8")
                    keys.append(k)
                    counts.append(n)
                    continue
                if key is None:
                    key, count = _added(keys, counts)
                own, _, number = _unpacked(r.body, "<i8", "<i8", "<u4")
                n = count[np.searchsorted(key, own)]
                best = (n == most[own % b_size]).astype("<u1")
                yield pd.DataFrame({"block": [r.block], "n_pairs": [r.n_pairs], "body": [_packed(number, n.astype("<i8"), best)]})

    both = (totals.select("part", F.lit(0).alias("asked"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("n_pairs"), "body")
                  .unionByName(pairs.select("part", F.lit(1).alias("asked"), "block", "n_pairs", F.col("pairs").alias("body"))))
    return (both.repartition("part").sortWithinPartitions("part", "asked")
                .mapInPandas(run, "block long, n_pairs long, body binary"))


def link_sums(links: DataFrame, answers: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of each row's links; a row whose links lie in several blocks comes once for each."""
    def run(batches):
        for _, rows in _by_key(batches, "block"):
            count = best = None
            for r in rows:
                if count is None:
                    count, best = np.zeros(r.n_pairs, dtype=np.int64), np.zeros(r.n_pairs, dtype=np.int64)
                if r.asked == 0:
                    number, n, top = _unpacked(r.body, "<u4", "<i8", "<u1")
                    count[number], best[number] = n, top
                    continue
                code, = _unpacked(r.body, "<u4")
                own, many = _unpacked(r.rows, "<i8", "<i8")
                first = np.cumsum(many) - many
                yield pd.DataFrame({"row": own, "n_best": np.add.reduceat(best[code], first), "count_sum": np.add.reduceat(count[code], first)})

    none = F.lit(None).cast("binary").alias("rows")
    both = (answers.select("block", F.lit(0).alias("asked"), "n_pairs", none, "body")
                   .unionByName(links.select("block", F.lit(1).alias("asked"), "n_pairs", "rows", F.col("links").alias("body"))))
    return (both.repartition("block").sortWithinPartitions("block", "asked")
                .mapInPandas(run, "row long, n_best long, count_sum long"))


def _ranges(docs: DataFrame) -> int:
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(64, min(4096, size // RANGE_BYTES))


def align_documents(docs: DataFrame, a_name: str, b_name: str, ranges: int | None = None, window: int = WINDOW,
                    block_links: int = BLOCK_LINKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    prepare(docs.sparkSession)
    rows = encoded(docs, a_name, b_name, ranges or _ranges(docs), window, block_links)
    pairs = rows.filter(F.col("kind") == PAIRS).select("block", "part", "n_pairs", "pairs")
    totals = pair_totals(pairs)
    most = highest_by_id(totals, side(b_name, PieceSide).size)
    sums = link_sums(rows.filter(F.col("kind") == LINKS).select("block", "n_pairs", "rows", "links"), _answers(pairs, totals, most))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = rows.filter(F.col("kind") == DOC).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    none = F.lit(0).cast("long")
    return own.join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
                                                F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")


def overlaps(text: str, a_name: str, b_name: str) -> list[tuple[int, int, int, int]]:
    """The overlap ranges of one text: (group, a id, b id, shared bytes) of every link, for a closer look."""
    a, b = side(a_name, ByteSide), side(b_name, PieceSide)
    (a_ids,), (a_same,) = a.encode([text]) if text else ([None], [False])
    (b_ids,), (b_same,) = b.encode([text]) if text else ([None], [False])
    if not (a_same and b_same):
        return []
    a_ends, b_ends = np.cumsum(a.lengths[a_ids], dtype=np.int64), np.cumsum(b.lengths[b_ids], dtype=np.int64)
    out, group = [], 0
    for *_, link_a, link_b, cut_a, _ in aligned(a_ends, b_ends):
        where = np.searchsorted(cut_a, link_a, side="left") + group
        shared = np.minimum(a_ends[link_a], b_ends[link_b]) - np.maximum((a_ends - a.lengths[a_ids])[link_a], (b_ends - b.lengths[b_ids])[link_b])
        out += zip(where.tolist(), a_ids[link_a].tolist(), b_ids[link_b].tolist(), shared.tolist())
        group += len(cut_a)
    return out
