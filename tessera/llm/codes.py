"""Vector codes: one small codebook per part of the vector, fitted by active-entry Lloyd rounds.

Components become integers, floor(256 x). A vector is cut into equal consecutive parts; each part has a
codebook of its own. A round assigns every part to its nearest entry and moves each entry to the floor
of its parts' mean. Each row keeps its parts' entries and exact squared distances. In the next round a
part whose own entry did not move compares only the entries that did with the distance it has (all other
distances are what they were); a part whose entry moved looks at the whole codebook. Ties go to the lower
index either way: a moved entry replaces an equal one only if its index is lower.

The rounds are narrow passes over the rows, each written to the shared folder with its entries and
distances. What leaves a task for an update is one sum per entry and component, added up within the task;
what reaches the driver and travels back is the codebooks, ``entries`` times the vector's length.

Integers are exact at any size: they are held as doubles (floor(256 x) of a double is one) where all
sums of a part stay below 2^53, and as Python integers elsewhere. Sums travel in limbs of 32 bits.

Defined results: rows whose vector is null or holds null or non-finite components (also after the
factor 256) are left out; so are vectors of another length than most (the longer one, of equally
frequent). A length that is no multiple of the number of parts counts as filled up with zeros. Ties in the
smallest ids go by the vector; a null id comes last; repeated rows are rows like any other. With
fewer rows than entries the codebooks have as many entries as rows. An error beyond 64 bits is null, and
so is a label's sum that has one or is one. An empty table gives an empty result. Only ``vec_id``,
``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_EXACT = 2.0 ** 53
_LONGEST = (1 << 63) - 1
#: Rows compared with a codebook at a time.
_ROWS = 4096


def integer_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vec): floor(scale * x) of the usable vectors, as array<double>."""
    vec = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select("vec_id", "label", vec.alias("vec")).filter(F.coalesce(fine, F.lit(False)))
    # floor() of a double is a long and stops at its ends: larger doubles are integers already.
    whole = F.transform("vec", lambda x: F.when(F.abs(x) < F.lit(_EXACT), F.floor(x).cast("double")).otherwise(x))
    return rows.select("vec_id", "label", whole.alias("vec"))


def usual_length(rows: DataFrame) -> int:
    """The most frequent vector length; the longer one, of equally frequent."""
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def _fits(*arrays: np.ndarray) -> bool:
    """Whether squared distances between rows of these arrays are exact in double precision."""
    most = sum(float(np.abs(a).max(initial=0.0)) for a in arrays)
    return arrays[0].shape[-1] * most * most < _EXACT


def _whole(a: np.ndarray) -> np.ndarray:
    """The same integers as Python integers."""
    return np.array([int(x) for x in a.ravel()], dtype=object).reshape(a.shape)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows by entries): doubles where they are exact, else Python integers."""
    if not _fits(x, book):
        x, book = _whole(x), _whole(book)
    out = np.zeros((len(x), len(book)), dtype=x.dtype)
    for k in range(x.shape[1]):
        diff = x[:, k, None] - book[None, :, k]
        out += diff * diff
    return out


def assign(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lowest, of equally near) and its distance."""
    code, near = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=object)
    for at in range(0, len(x), _ROWS):
        d = distances(x[at:at + _ROWS], book)
        c = np.argmin(d, axis=1)
        code[at:at + _ROWS] = c
        near[at:at + _ROWS] = [int(v) for v in d[np.arange(len(c)), c]]
    return code, near


def reassign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``assign``, knowing the entries and distances before the entries ``moved`` moved."""
    code, near = code.copy(), near.copy()
    fresh = np.flatnonzero(moved)
    if not len(fresh):
        return code, near
    lost = moved[code]
    again = np.flatnonzero(lost)
    code[again], near[again] = assign(x[again], book)
    kept = np.flatnonzero(~lost)
    c, d = assign(x[kept], book[fresh])
    c = fresh[c]
    better = (d < near[kept]) | ((d == near[kept]) & (c < code[kept]))
    code[kept[better]], near[kept[better]] = c[better], d[better]
    return code, near


def _stored(near: np.ndarray) -> list[str]:
    """Distances of a row as text: they may be of any size."""
    return [",".join(map(str, row)) for row in near]


def _pass(rows: DataFrame, parts: int, width: int, books: list[np.ndarray], moved: list[np.ndarray] | None) -> DataFrame:
    """One assignment, written: (vec_id, label, vec, code, near)."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = np.zeros((len(batch), parts * width))
            given = np.stack(batch["vec"].to_numpy()) if len(batch["vec"].iloc[0]) else x[:, :0]
            x[:, :given.shape[1]] = given
            codes, nears = np.empty((len(batch), parts), dtype=np.uint16), np.empty((len(batch), parts), dtype=object)
            if moved is not None:
                before = np.frombuffer(b"".join(batch["code"]), dtype="<u2").reshape(len(batch), parts).astype(np.int64)
                stored = np.array([[int(d) for d in s.split(",")] for s in batch["near"]], dtype=object)
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width]
                if moved is None:
                    codes[:, p], nears[:, p] = assign(part, books[p])
                else:
                    codes[:, p], nears[:, p] = reassign(part, books[p], moved[p], before[:, p], stored[:, p])
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "vec": batch["vec"],
                                "code": [c.astype("<u2").tobytes() for c in codes], "near": pd.Series(_stored(nears), dtype=object)})

    # Ids and labels travel as text: a null among integers would turn them into floats.
    return persist(rows.mapInPandas(run, "vec_id string, label string, vec array<double>, code binary, near string"), "codes-round")


def _sums(rows: DataFrame, parts: int, width: int, entries: int) -> DataFrame:
    """(entry, place, limb, total, n): sums of the components at ``place`` of the parts assigned to an entry."""
    def run(batches):
        totals, counts = np.zeros((entries, parts * width), dtype=object), np.zeros((entries, parts), dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x = np.zeros((len(batch), parts * width))
            given = np.stack(batch["vec"].to_numpy()) if len(batch["vec"].iloc[0]) else x[:, :0]
            x[:, :given.shape[1]] = given
            code = np.frombuffer(b"".join(batch["code"]), dtype="<u2").reshape(len(batch), parts)
            exact = len(batch) * float(np.abs(x).max(initial=0.0)) < _EXACT
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width]
                counts[:, p] += np.bincount(code[:, p], minlength=entries)
                if exact:
                    for k in range(width):
                        added = np.bincount(code[:, p], weights=part[:, k], minlength=entries)
                        totals[:, p * width + k] += [int(v) for v in added]
                else:
                    np.add.at(totals[:, p * width:(p + 1) * width], code[:, p], _whole(part))
        out = []
        for e, place in zip(*np.nonzero(np.repeat(counts, width, axis=1))) if width else ():
            value, n = int(totals[e, place]), int(counts[e, place // width])
            sign, value, limb = (1 if value >= 0 else -1), abs(value), 0
            while value or not limb:
                out.append((e, place, limb, sign * (value & 0xFFFFFFFF), n if not limb else 0))
                value, limb = value >> 32, limb + 1
        yield pd.DataFrame(out, columns=["entry", "place", "limb", "total", "n"]).astype(np.int64)

    return (rows.select("vec", "code").mapInPandas(run, "entry int, place int, limb int, total long, n long")
                .groupBy("entry", "place", "limb").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


def _moved_to(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one update; unused entries stay."""
    parts, (entries, width) = len(books), books[0].shape
    total, count = {}, {}
    for r in _sums(rows, parts, width, entries).collect():  # the codebooks' size, whatever the number of rows
        at = (r["entry"], r["place"])
        total[at] = total.get(at, 0) + (r["total"] << (32 * r["limb"]))
        count[at] = count.get(at, 0) + r["n"]
    out = [_whole(b) for b in books]
    for (e, place), n in count.items():
        out[place // width][e, place % width] = total[(e, place)] // n
    return [_held(b) for b in out]


def _held(book: np.ndarray) -> np.ndarray:
    """Python integers as doubles, if those hold them exactly."""
    small = all(abs(int(v)) < 2 ** 53 for v in book.ravel())
    return book.astype(np.float64) if small else book


class Codes:
    """``books`` (one entries-by-width array per part) and ``rows`` (vec_id, label, vec, code, near)."""

    def __init__(self, books: list[np.ndarray], rows: DataFrame):
        self.books, self.rows = books, rows

    @property
    def digest(self) -> str:
        """sha256 of all components by part, entry and position, as decimal numbers joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.ravel()).encode()).hexdigest()


def fit_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codes | None:
    """Codebooks and codes of (vec_id, label, vec) rows; None if there is no row."""
    d = usual_length(vectors)
    rows = persist(vectors.filter(F.size("vec") == d), "codes-vectors")
    width = -(-d // parts)
    # The first entries: a bounded number of rows, the smallest ids.
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries).collect()
    if not first:
        return None
    start = np.zeros((len(first), parts * width))
    if d:
        start[:, :d] = [r["vec"] for r in first]
    books = [start[:, p * width:(p + 1) * width].copy() for p in range(parts)]
    state = _pass(rows.select(F.col("vec_id").cast("string").alias("vec_id"), F.col("label").cast("string").alias("label"), "vec"),
                  parts, width, books, None)
    for _ in range(rounds):
        after = _moved_to(state, books)
        moved = [np.array([[int(v) for v in a] != [int(v) for v in b] for a, b in zip(new, old)], dtype=bool) for new, old in zip(after, books)]
        books = after
        state = _pass(state, parts, width, books, moved)
    return Codes(books, state)


def decoded(codes: Codes) -> DataFrame:
    """(vec_id, vec): what the codes stand for, in the integer components."""
    books = codes.books
    d_of = codes.rows.select("vec_id", "code", F.size("vec").alias("d"))

    def run(batches):
        for batch in batches:
            if len(batch):
                code = np.frombuffer(b"".join(batch["code"]), dtype="<u2").reshape(len(batch), len(books))
                out = np.concatenate([np.asarray(b, dtype=np.float64)[code[:, p]] for p, b in enumerate(books)], axis=1)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "vec": [v[:n] for v, n in zip(out, batch["d"])]})

    return d_of.mapInPandas(run, "vec_id string, vec array<double>")


def code_report(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is two hex digits: 1 to 256 entries")
    prepare(embeddings.sparkSession)
    vectors = integer_vectors(embeddings)
    id_type, label_type = vectors.schema["vec_id"].dataType, vectors.schema["label"].dataType
    codes = fit_codes(vectors, parts, entries, rounds)
    if codes is None:
        return vectors.limit(0).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                       F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))

    def finish(batches):
        for batch in batches:
            error = [sum(int(d) for d in s.split(",")) for s in batch["near"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"],
                                "code": pd.Series([np.frombuffer(c, dtype="<u2").astype(np.uint8).tobytes().hex() for c in batch["code"]], dtype=object),
                                "error": pd.Series([str(e) if e <= _LONGEST else None for e in error], dtype=object)})

    done = persist(codes.rows.select("vec_id", "label", "code", "near").mapInPandas(finish, "vec_id string, label string, code string, error string")
                   .select(F.col("vec_id").cast(id_type).alias("vec_id"), F.col("label").cast(label_type).alias("label"), "code",
                           F.col("error").cast("long").alias("error")), "codes-done")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count("error") == F.count("*")) & (total <= F.lit(str(_LONGEST)).cast("decimal(38,0)"))
    # Written before the join: a label that holds most rows can then be split.
    per_label = persist(done.groupBy(F.col("label").alias("of")).agg(F.when(fits, total).cast("long").alias("label_error")), "codes-labels")
    return (done.join(per_label, F.col("label").eqNullSafe(F.col("of")), "left")
                .select("vec_id", "code", "error", "label_error", F.lit(codes.digest).alias("codebooks_sha256")))


def _oracle() -> str:
    """The same rows in DuckDB's SQL, every assignment done in full."""
    steps = ["""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS x FROM kept, range(16) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 64)"""]
    for k in range(3):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, parts.p, e, x, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN book{k} AS b ON b.p = parts.p) GROUP BY r, p)""")
        if k < 2:
            steps.append(f"""
mean{k} AS MATERIALIZED (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT parts.p, e, i, sum(x[i]) AS s, count(*) AS n
    FROM parts JOIN near{k} AS a ON a.r = parts.r AND a.p = parts.p, range(1, len(x) + 1) AS t(i) GROUP BY parts.p, e, i)
  GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} AS b LEFT JOIN mean{k} AS m ON m.p = b.p AND m.e = b.e)""")
    return "WITH " + ",".join(steps) + """,
digest AS MATERIALIZED (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


ORACLE = _oracle()
