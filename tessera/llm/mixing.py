"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its weight's share of all words, stopped at ``MOST`` (3) times its size; what
is cut off is shared again by weight. Each document is then wanted target / source size times: a
whole number of copies plus a fraction, the same for all documents of the source. The fractions are
rounded in pairs: words are moved at random from one document to the other until one of the two is
all in or all out; the other goes on to the next pair. Moving words, not copies, keeps a source's
words exactly at its target until its last document, and every document keeps its own expectation.

Pairing runs as a reduction tree. Buckets of a source (a hash of the row, a few thousand rows each,
so that a hot source is many buckets) are streamed through in order of falling size with one
undecided row in memory; the one row each bucket leaves goes up the tree, ``FAN`` buckets at a
time, until one row per source is left, which a last draw decides.

Draws are hashes of the row and the seed: reruns agree, on any cluster. Defined results: a null or
wordless text has size 0 and takes nothing; a null source is a source of its own, sorted last; rows
equal in every column used are interchangeable; other columns are not read. The table of sources
(one row each) is the only thing the driver sees.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import persist, prepare, row_id_names, tmp_name, with_row_id, word_count

MOST = 3
WEIGHTS = (1, 2, 3)
BUCKET_ROWS = 4096
FAN = 64
#: Fractions this near to a whole number count as whole.
WHOLE = 1e-9


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> dict[str | None, float]:
    """Target of every source. Sources sort by code point, null last; weights repeat over them."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(order)}
    size = dict(order)
    out: dict[str | None, float] = {}
    rest, open_ = float(sum(size.values())), list(weight)
    while open_:
        share = rest / sum(weight[s] for s in open_)
        above = [s for s in open_ if share * weight[s] > most * size[s]]
        if not above:
            out.update({s: share * weight[s] for s in open_})
            break
        for s in above:
            out[s] = float(most * size[s])
            rest -= out[s]
        open_ = [s for s in open_ if s not in above]
        rest = max(0.0, rest)
    return out


def duel(a: float, s: int, b: float, t: int, draw: float) -> tuple[float, float]:
    """New fractions of two documents of ``s`` and ``t`` words: words move at random until one is 0 or 1.

    ``s * a + t * b`` stays; the chances of both directions keep each fraction's expectation.
    """
    up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
    if draw * (up + down) < down:  # from the second to the first
        return (1.0, b - up / t) if (1 - a) * s <= b * t else (a + up / s, 0.0)
    return (0.0, b + down / t) if a * s <= (1 - b) * t else (a - down / s, 1.0)


def _rounds(batches, group: tuple[str, str]):
    """Stream rows sorted by group; of each group all rows but one are decided.

    Rows: group columns, source_no, bucket, words, part (fraction), draw, and whatever else comes along.
    Yields them with ``up``: 1 or 0 for decided rows, null for a group's last one, whose new
    fraction is in ``part``.
    """
    held: dict | None = None
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_dict("records"):
            key = tuple(row[c] for c in group)
            if held is not None and held["key"] != key:
                out.append(held["row"])
                held = None
            row["up"] = None
            if row["part"] <= WHOLE or row["part"] >= 1 - WHOLE or row["words"] == 0:
                row["up"] = int(row["part"] >= 0.5) if row["words"] else 0
                out.append(row)
                continue
            if held is None:
                held = {"key": key, "row": row}
                continue
            first = held["row"]
            first["part"], row["part"] = duel(first["part"], first["words"], row["part"], row["words"], row["draw"])
            open_ = []
            for r in (first, row):
                if r["part"] <= WHOLE or r["part"] >= 1 - WHOLE:
                    r["up"] = int(r["part"] >= 0.5)
                    out.append(r)
                else:
                    open_.append(r)
            held = {"key": key, "row": open_[0]} if open_ else None
        if out:
            yield pd.DataFrame(out, columns=[*batch.columns, "up"]).astype({"up": "Int32"})
    if held is not None:
        row = held["row"]
        yield pd.DataFrame([row]).astype({"up": "Int32"})


def _decide(rows: DataFrame, group: tuple[str, str], name: str) -> DataFrame:
    """One level of the tree, written to the shared folder."""
    schema = T.StructType([*rows.schema.fields, T.StructField("up", T.IntegerType())])
    ordered = (rows.repartition(*group)
                   .sortWithinPartitions(*group, F.desc("words"), "draw", *[c for c in rows.columns if c not in {*group, "words", "draw"}]))
    return persist(ordered.mapInPandas(lambda batches: _rounds(batches, group), schema), name)


def _draw(seed: int, *columns: str) -> Column:
    """A number from 0 to 1 (exclusive) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) / F.lit(float(1 << 53))


def plan_mix(rows: DataFrame, carry: tuple[str, ...], seed: int = 9, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Copies of every row: ``rows`` has source, words, digest and the ``carry`` columns.

    Returns carry, words, source_size, target and copies (0 to ``most``).
    """
    spark = rows.sparkSession
    prepare(spark)
    kinds = dict(rows.dtypes)
    rows = persist(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("words").alias("size"), F.count("*").alias("n")).collect()
    target = targets([(r["source"], r["size"]) for r in sizes], weights, most)
    order = sorted(sizes, key=lambda r: (r["source"] is None, r["source"] or ""))
    plan = []
    for no, r in enumerate(order):
        wanted = target[r["source"]] / r["size"] if r["size"] else 0.0
        whole = math.floor(wanted + WHOLE)
        plan.append((no, r["source"], r["size"], target[r["source"]], whole, max(0.0, wanted - whole), math.ceil(r["n"] / BUCKET_ROWS)))
    plan_type = "source_no int, source string, source_size long, target double, whole int, part double, buckets int"
    of_source = spark.createDataFrame(plan, plan_type)
    # One row per source; sent to the tasks as long as that is small, else Spark joins it by shuffle.
    of_source = F.broadcast(of_source) if len(plan) <= 10_000 else of_source
    own = rows.withColumnRenamed("source", "own_source")
    keyed = (own.join(of_source, F.col("own_source").eqNullSafe(F.col("source")))
                .withColumn("draw", _draw(seed, "doc_id", "digest", "words"))
                .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest", "words", F.lit(seed + 1)), F.col("buckets")).cast("int"))
                # Carried columns travel as text: pandas would turn integers with nulls among them into floats.
                .select("source_no", "bucket", "words", "part", "draw", "digest", "source_size", "target", "whole",
                        *(F.col(c).cast("string").alias(c) for c in carry)))
    first = _decide(keyed, ("source_no", "bucket"), "mix-level")
    # The rows left over go up the tree.
    left = first.filter("up IS NULL").select("source_no", "bucket", F.col("bucket").alias("parent"), "words", "part", "draw")
    decided: DataFrame | None = None
    height = max([1, *(p[6] for p in plan)])
    while height > 1:
        height = math.ceil(height / FAN)
        step = left.withColumn("parent", F.floor(F.col("parent") / FAN).cast("int"))
        level = _decide(step, ("source_no", "parent"), "mix-level")
        done = level.filter("up IS NOT NULL").select("source_no", "bucket", "up")
        decided = done if decided is None else decided.unionByName(done)
        left = level.filter("up IS NULL").drop("up")
    last = left.select("source_no", "bucket", (F.col("part") > _draw(seed + 2, "source_no", "bucket", "words", "draw")).cast("int").alias("up"))
    decided = last if decided is None else decided.unionByName(last)
    open_rows = first.filter("up IS NULL").drop("up").join(decided, ["source_no", "bucket"])
    return (first.filter("up IS NOT NULL").unionByName(open_rows)
                 .select(*(F.col(c).cast(kinds[c]).alias(c) for c in carry), "words", "source_size", "target",
                         (F.col("whole") + F.col("up")).cast("long").alias("copies")))


def mix(docs: DataFrame, seed: int = 9) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    rows = docs.select("doc_id", "source", "text").select(
        "doc_id", "source", word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("digest"))
    return plan_mix(rows, ("doc_id",), seed).select(
        "doc_id", F.col("words").alias("size"), "source_size", "target", (F.col("words") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 9) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows without words are kept once."""
    ids, named = row_id_names(docs), with_row_id(docs)
    times, one = tmp_name(docs, "llm_copies"), tmp_name(docs, "llm_copy")
    rows = named.select("doc_id", "source", *ids, word_count(F.col("text")).alias("words"), F.xxhash64("text").alias("digest"))
    copies = (plan_mix(rows, ("doc_id", *ids), seed)
              .select(*ids, F.when(F.col("words") == 0, 1).otherwise(F.col("copies")).cast("int").alias(times))
              .filter(F.col(times) > 0))
    return (named.join(copies, list(ids))
                 .withColumn(one, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(*(F.col(f"`{c}`") for c in docs.columns)))
