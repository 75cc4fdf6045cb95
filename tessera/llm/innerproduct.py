"""Exact top-k by inner product: vectors in order of length, rotated partial sums, Cauchy-Schwarz bounds.

Components become integers, floor(256 x), and scores are their exact inner products. The vectors'
second-moment matrix, added up by tasks, gives the rotation (the right singular vectors) that puts
most of a vector's length into its first coordinates. Rows are dealt by descending length into cells of
about ``CELL_BYTES``; the search takes the cells in rounds, the longest first, each round ``GROWTH`` times as
many as the one before. A query that has k scores goes on to a cell only if its length times the cell's longest can
reach the k-th score. Within a cell the products of the first rotated coordinates plus the lengths of
the two rests bound each score; pairs that can't reach the k-th score are dropped after each step, the others
are scored in integers. A pair whose bound equals the k-th score stays: a tie may have the smaller id.

Queries are marked by a condition and grow with the table, so they are rows of the same distributed
join: each goes, by number, to the cells of the round that it still needs. A task holds one cell
and streams the queries. Dealing rows by length, then by a hash of the row, cuts equal lengths
like any others, so a vector that a third of the rows share fills cells of the usual size.

Defined results: vectors that are null or hold null or non-finite components (also after the factor
256) take no part, nor do vectors of another length than most (the longer one, of equally frequent);
empty and zero vectors score 0. Rows are told apart by row: a query's own row is no candidate, another row with its
id is, and each query row has ranks of its own. Ties go to the smaller id, null ids last. A score beyond 64 bits
ranks by its exact value and is returned as null. Fewer candidates than k are all returned. An empty table gives an
empty result. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare

SCALE = 256
#: Bytes of vectors in a cell, as doubles.
CELL_BYTES = 4 << 20
#: Each round takes so many times the cells of the one before.
GROWTH = 8
#: Shares of the coordinates that the bounds are taken over, in turn.
STEPS = (0.125, 0.375)
#: Queries compared with a cell at a time.
TOGETHER = 64
_EXACT = 2.0 ** 53


def usable(embeddings: DataFrame, is_query: Column) -> DataFrame:
    """(row, vec_id, asked, vec, length), written: integer components as doubles; ``row`` names a row, ``vec_id`` is text."""
    vec = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(SCALE)))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (embeddings.select(F.col("vec_id").cast("string").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asked"), vec.alias("vec"))
                      .filter(F.coalesce(fine, F.lit(False))))

    def measured(batches):
        for batch in batches:
            # Doubles of 2^53 and more are integers already.
            vecs = [np.floor(v) for v in batch["vec"]]
            longest = [float(np.abs(v).max(initial=0.0)) for v in vecs]
            batch["length"] = [m * float(np.sqrt(((v / m) ** 2).sum())) if m else 0.0 for v, m in zip(vecs, longest)]
            batch["vec"] = vecs
            yield batch

    rows = rows.mapInPandas(measured, "vec_id string, asked boolean, vec array<double>, length double")
    rows = persist(rows.withColumn("row", F.monotonically_increasing_id()), "ip-rows")
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def rotation(rows: DataFrame, d: int) -> np.ndarray:
    """The right singular vectors of all rows, largest first (d by d), from the sum of the rows' outer products."""
    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vec"].to_numpy())
                # Any orthogonal matrix is a right one; very long vectors only have to stay finite.
                x = x / max(1.0, float(np.abs(x).max(initial=0.0)) / 1e100)
                total += x.T @ x
        yield pd.DataFrame({"i": np.repeat(np.arange(d), d), "j": np.tile(np.arange(d), d), "v": total.ravel()})

    sums = rows.select("vec").mapInPandas(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    moment = np.zeros((d, d))
    for r in sums:
        moment[r["i"], r["j"]] = r["v"]
    top = float(np.abs(moment).max(initial=0.0))
    if not np.isfinite(top) or not top:
        return np.eye(d)
    return np.linalg.eigh((moment + moment.T) / (2 * top))[1][:, ::-1].copy()


def cells(rows: DataFrame, d: int) -> DataFrame:
    """(cell, row, vec_id, asked, vec, length), written: cell 0 has the longest vectors."""
    n = rows.count()
    many = max(1, -(-n * max(1, d) * 8 // CELL_BYTES))
    # Any order among equal lengths will do; this one cuts them like others.
    dealt = rows.repartitionByRange(many, F.desc("length"), F.xxhash64("vec_id", "row"))
    return persist(dealt.withColumn("cell", F.spark_partition_id()), "ip-cells")


def exact_products(q: np.ndarray, x: np.ndarray) -> list[int]:
    """Integer inner products of row pairs."""
    if q.shape[1] * float(np.abs(q).max(initial=0.0)) * float(np.abs(x).max(initial=0.0)) < _EXACT:
        return [int(v) for v in np.einsum("ij,ij->i", q, x)]
    return [sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q, x)]


class Cell:
    """The vectors of one cell, rotated, with the lengths of what the steps leave out."""

    def __init__(self, rows: np.ndarray, ids: list, vectors: np.ndarray, turn: np.ndarray):
        self.rows, self.ids, self.vectors, self.turn = rows, ids, vectors, turn
        self.scale = max(1.0, float(np.abs(vectors).max(initial=0.0)))
        self.rotated = (vectors / self.scale) @ turn
        d = vectors.shape[1]
        self.cuts = [0, *dict.fromkeys(min(d, max(1, round(s * d))) for s in STEPS if d), d]
        self.rests = [np.sqrt((self.rotated[:, c:] ** 2).sum(axis=1)) for c in self.cuts]

    def search(self, rows: np.ndarray, queries: np.ndarray, least: list, k: int, work: dict | None = None) -> list[tuple]:
        """(query place, candidate place, score): per query the best ``k`` in this cell that reach ``least`` (None: no score yet)."""
        scale = max(1.0, float(np.abs(queries).max(initial=0.0)))
        turned = (queries / scale) @ self.turn
        rests = [np.sqrt((turned[:, c:] ** 2).sum(axis=1)) for c in self.cuts]
        floor = np.array([-np.inf if v is None else float(v) for v in least]) / scale / self.scale
        # Rounding of the rotated sums; a bound that misses by less is no proof.
        slack = 1e-9 * rests[0][:, None] * self.rests[0][None, :] + 1e-300 + 1e-9 * np.abs(np.where(np.isfinite(floor), floor, 0.0))[:, None]
        open_ = (rests[0][:, None] * self.rests[0][None, :] + slack >= floor[:, None]) & (rows[:, None] != self.rows[None, :])
        a, b = np.nonzero(open_)
        partial = np.zeros(len(a))
        for lo, hi, rest_q, rest_x in zip(self.cuts, self.cuts[1:], rests[1:], self.rests[1:]):
            if work is not None:
                work[hi] = work.get(hi, 0) + len(a)
            if len(a) > 0.25 * open_.size:  # most pairs are open: one product of the blocks, then the open ones
                partial += (turned[:, lo:hi] @ self.rotated[:, lo:hi].T)[a, b]
            else:
                partial += np.einsum("ij,ij->i", turned[a, lo:hi], self.rotated[b, lo:hi])
            keep = partial + rest_q[a] * rest_x[b] + slack[a, b] >= floor[a]
            a, b, partial = a[keep], b[keep], partial[keep]
        # What is left is close to its score: of these only the k best can count, with ties by the rounding.
        keep = self._near_best(a, partial, slack[a, b], k, len(rows))
        a, b = a[keep], b[keep]
        if work is not None:
            work["exact"] = work.get("exact", 0) + len(a)
        out = []
        for at in range(0, len(a), 1 << 16):
            part = slice(at, at + (1 << 16))
            scores = exact_products(queries[a[part]], self.vectors[b[part]])
            out += zip(a[part].tolist(), b[part].tolist(), scores)
        best: dict[int, list] = {}
        for i, j, s in out:
            best.setdefault(i, []).append((-s, self.ids[j] is None, self.ids[j] or 0, j))
        return [(i, j, -s) for i, found in best.items() for s, _, _, j in sorted(found)[:k]
                if least[i] is None or -s >= least[i]]

    @staticmethod
    def _near_best(a: np.ndarray, partial: np.ndarray, slack: np.ndarray, k: int, n: int) -> np.ndarray:
        """Pairs that can be among the k best of their query, by sums that are off by ``slack`` at most."""
        order = np.lexsort((-(partial - slack), a))
        first = np.searchsorted(a[order], np.arange(n))
        nth = np.minimum(first + k - 1, len(a) - 1)
        bar = np.full(n, -np.inf)
        if len(a):
            own = a[order][nth] == np.arange(n)
            bar[own] = (partial - slack)[order][nth[own]]
        return partial + slack >= bar[a]


def _matrix(vectors: list, d: int) -> np.ndarray:
    return np.stack(vectors).astype(np.float64) if len(vectors) and d else np.zeros((len(vectors), d))


#: What is found: ids and scores as text, as they may be null or of any size.
FOUND = "query_row string, query_id string, row string, vec_id string, score string"
_NAMES = [f.split()[0] for f in FOUND.split(", ")]


def _found_in(pairs: DataFrame, turn: np.ndarray, k: int) -> DataFrame:
    """Best candidates of each query and cell; ``pairs`` has a cell's candidates (kind 0) and its queries (kind 1)."""
    d = len(turn)

    def results(cell, asked):
        rows = np.array([r.row for r in asked])
        hits = cell.search(rows, _matrix([r.vec for r in asked], d), [None if r.least is None else int(r.least) for r in asked], k)
        return [(str(asked[i].row), asked[i].vec_id, str(cell.rows[j]), None if cell.ids[j] is None else str(cell.ids[j]), str(s)) for i, j, s in hits]

    def run(batches):
        held, asked, at, cell = [], [], None, None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.cell != at:
                    if asked:
                        out += results(cell, asked)
                    held, asked, at, cell = [], [], r.cell, None
                if r.kind == 0:
                    held.append(r)
                    continue
                if cell is None:
                    cell = Cell(np.array([h.row for h in held]), [None if h.vec_id is None else int(h.vec_id) for h in held],
                                _matrix([h.vec for h in held], d), turn)
                    held = []
                asked.append(r)
                if len(asked) == TOGETHER:
                    out += results(cell, asked)
                    asked = []
            if out:
                yield pd.DataFrame(out, columns=_NAMES, dtype=object)
        if asked:
            yield pd.DataFrame(results(cell, asked), columns=_NAMES, dtype=object)

    return (pairs.repartition("cell").sortWithinPartitions("cell", "kind", "row")
                 .mapInPandas(run, FOUND))


def _order() -> list[Column]:
    """Larger scores first, by their exact value (text of an integer of any size), then smaller ids."""
    negative = F.col("score").startswith("-")
    digits = F.ltrim(F.col("score"), F.lit("-"))
    # Without leading zeros, integers of one sign order by their number of digits, then by their digits.
    size = F.when(negative, -F.length(digits)).otherwise(F.length(digits))
    return [size.desc(), F.when(negative, None).otherwise(digits).desc(), F.when(negative, digits).asc(),
            F.col("vec_id").cast("decimal(38,0)").asc_nulls_last(), F.col("row").cast("long").asc()]


def top_products(embeddings: DataFrame, k: int = 5, is_query: Column | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows ``is_query`` marks, the ``k`` best other rows."""
    spark = embeddings.sparkSession
    prepare(spark)
    rows = usable(embeddings, F.col("vec_id") % 50 == 0 if is_query is None else is_query)
    id_type = embeddings.schema["vec_id"].dataType
    head = rows.select(F.size("vec").alias("d")).limit(1).collect()
    d = head[0]["d"] if head else 0
    turn = rotation(rows, d) if d else np.zeros((0, 0))
    table = cells(rows, d)
    place = persist(table.groupBy("cell").agg(F.max("length").alias("longest")), "ip-lengths")
    n_cells = (place.agg(F.max("cell")).first()[0] or 0) + 1
    queries = persist(table.filter("asked").select("row", "vec_id", "vec", "length"), "ip-queries")
    best = spark.createDataFrame([], FOUND)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(*_order()))
    first, many = 0, 1
    while first < n_cells:
        last = min(first + many, n_cells) - 1
        # The k-th score so far, where there are k; what can't reach it is not sent on.
        least = best.withColumn("rank", rank).filter(F.col("rank") == k).select(F.col("query_row").cast("long").alias("row"), F.col("score").alias("least"))
        asked = queries.join(least, "row", "left").withColumn("need", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))))
        sent = (asked.withColumn("cell", F.explode(F.sequence(F.lit(first), F.lit(last))))
                     .join(place, "cell").filter(F.col("length") * F.col("longest") * (1 + 1e-9) + 1e-9 >= F.col("need"))
                     .select("cell", F.lit(1).alias("kind"), "row", "vec_id", "vec", "least"))
        own = (table.filter(F.col("cell").between(first, last))
                    .select("cell", F.lit(0).alias("kind"), "row", "vec_id", "vec", F.lit(None).cast("string").alias("least")))
        found = _found_in(own.unionByName(sent), turn, k)
        best = persist(best.unionByName(found).withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank"), "ip-best")
        first, many = last + 1, many * GROWTH
    return (best.withColumn("rank", rank)
                .select(F.col("query_id").cast(id_type).alias("query_id"), "rank", F.col("vec_id").cast(id_type).alias("vec_id"),
                        F.col("score").try_cast("long").alias("score")))


ORACLE = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.vec_id AS vec_id, c.r AS r,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM kept AS q JOIN kept AS c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST, r) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""
