"""Sharding by k-d tree partitioning (law ``bytes``: sizes near equal).

A node of the tree is a set of rows with a number of shards to be made of it. Every level splits
each open node along its widest dimension (the spread of the node's values, relative to the spread
over all rows) at the weighted quantile that gives each side its share of the bytes; a node's tie
on one value is split by the row's hash, so a hot value is no obstacle. The splits end at one shard,
which is the target size.

The quantile is found by distributed histograms: per level, all open nodes together, each round
counts bytes in ``BINS`` equal bins of the interval still in question, and the bin that holds the
quantile is the next interval. What reaches the driver is one row per node and bin, which depends
on the number of shards alone. Rows are short here (no texts) and written once.

Dimensions: text length in code points, source, language, doc_id; text values are ordered by a hash
into a number, nulls come first. Defined results: a null text has 8 bytes; repeated rows are spread
like any others; with fewer rows than shards some shards stay empty; an empty table gives an empty
result. Only the columns named are read, and missing dimensions are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import persist, row_id_names, tmp_name, with_row_id

SHARDS = 24
OVERHEAD = 8
DIMENSIONS = ("n_chars", "source", "lang", "doc_id")
BINS = 1024
#: A node's quantile is found when the interval holds less than this share of its bytes.
EXACT = 1e-4
#: Rows of one slot piece: slots are numbered piece by piece.
PIECE_ROWS = 20_000


def _as_number(column: Column, kind: str) -> Column:
    """A dimension as a double; text by a hash, null as the smallest."""
    number = F.pmod(F.xxhash64(column), F.lit(1 << 20)).cast("double") if kind == "string" else column.cast("double")
    return F.coalesce(F.when(F.isnan(number), None).otherwise(number), F.lit(-1.0))


def _rows(docs: DataFrame, carry: tuple[str, ...], dimensions: tuple[str, ...]) -> tuple[DataFrame, int]:
    """Short rows (*carry, size, text_crc32, row, at) and the number of dimensions; ``at`` is the row's
    place in every dimension, its tie breaker last."""
    kinds = dict(docs.dtypes)
    have = [d for d in dimensions if d == "n_chars" or d in kinds]
    columns = [_as_number(F.char_length("text"), "long") if d == "n_chars" else _as_number(F.col(d), kinds[d]) for d in have]
    size = (F.coalesce(F.octet_length("text").cast("long"), F.lit(0)) + OVERHEAD).cast("long")
    rows = docs.select(*carry, size.alias("size"), F.coalesce(F.crc32("text"), F.crc32(F.lit(""))).alias("text_crc32"),
                       F.array(*columns).alias("dims"))
    # Equal rows are told apart by their position in the written table.
    named = persist(rows.withColumn("row", F.monotonically_increasing_id()), "shard-rows")
    tie = F.shiftrightunsigned(F.xxhash64(*carry, "text_crc32", "size", "row"), 11) / F.lit(float(1 << 53))
    return named.select(*carry, "size", "text_crc32", "row", F.concat("dims", F.array(tie)).alias("at")), len(have)


def _small(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A table with one row per tree node: its size is the number of shards at most."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _descend(rows: DataFrame, splits: list[dict]) -> DataFrame:
    """Move every row from its node to the split's side; nodes without a split keep their rows."""
    table = _small(rows, [(s["node"], s["dim"], s["value"], s["tie"], s["left"], s["right"]) for s in splits],
                   "node int, dim int, value double, tie double, below int, above int")
    place = F.get("at", F.col("dim"))
    right = (place > F.col("value")) | ((place == F.col("value")) & (F.element_at("at", -1) >= F.col("tie")))
    moved = F.when(F.col("dim").isNull(), F.col("node")).when(right, F.col("above")).otherwise(F.col("below"))
    return rows.join(table, "node", "left").select(*[c for c in rows.columns if c != "node"], moved.alias("node"))


def _histogram(rows: DataFrame, open_: dict[int, dict]) -> dict[int, list]:
    """(bin, bytes, smallest, largest) per node over the interval of each; a held value keeps only its rows."""
    table = _small(rows, [(n, v["dim"], v["low"], v["high"], v["held"], v["value"]) for n, v in open_.items()],
                   "node int, dim int, low double, high double, held int, value double")
    place = F.get("at", F.col("dim"))
    share = F.floor((place - F.col("low")) / (F.col("high") - F.col("low")) * BINS).cast("int")
    inside = F.when(F.col("high") > F.col("low"), F.least(share, F.lit(BINS - 1))).otherwise(0)
    counted = (rows.join(table, "node")
                   .filter("held IS NULL OR at[held] = value")
                   .select("node", "size", place.alias("place"), "low", "high", inside.alias("bin"))
                   .filter("place BETWEEN low AND high")
                   .groupBy("node", "bin").agg(F.sum("size").alias("bytes"), F.min("place").alias("low"), F.max("place").alias("high")))
    out: dict[int, list] = {n: [] for n in open_}
    for r in counted.collect():
        out[r["node"]].append((r["bin"], r["bytes"], r["low"], r["high"]))
    return {n: sorted(v) for n, v in out.items()}


def _quantiles(rows: DataFrame, nodes: dict[int, dict], tie: int) -> dict[int, dict]:
    """The split of each node: rows at (value, tie) and above go right, so that ``left_bytes`` stay left."""
    found: dict[int, dict] = {}
    open_ = {n: {"dim": v["dim"], "low": v["low"], "high": v["high"], "held": None, "value": None, "passed": 0}
             for n, v in nodes.items()}
    while open_:
        following = {}
        bins_of = _histogram(rows, open_)
        for n, v in open_.items():
            want, passed = nodes[n]["left_bytes"], v["passed"]
            for _, size, least, most in bins_of[n]:
                if passed + size >= want:
                    break
                passed += size
            else:
                passed -= size
            nearer_end = abs(passed - want) > abs(passed + size - want)
            cut = math.nextafter(most, math.inf) if nearer_end else least
            small = size <= EXACT * nodes[n]["bytes"]
            if v["dim"] == tie and (small or most <= least):
                held = v["held"] is not None
                found[n] = {"dim": v["held"] if held else tie, "value": v["value"] if held else cut, "tie": cut if held else 0.0}
            elif v["dim"] != tie and most <= least:
                # One value holds the quantile: its rows are told apart by their tie breaker.
                following[n] = {"dim": tie, "low": 0.0, "high": 1.0, "held": v["dim"], "value": least, "passed": passed}
            elif small:
                found[n] = {"dim": v["dim"], "value": cut, "tie": 0.0}
            else:
                following[n] = {**v, "low": least, "high": most, "passed": passed}
        open_ = following
    return found


def _split_all(rows: DataFrame, n_dims: int, shards: int) -> DataFrame:
    """``rows`` with their shard: levels of splits until every node is one shard."""
    places = [F.get("at", F.lit(k)) for k in range(n_dims + 1)]
    extent = [f(p).alias(f"{name}{k}") for k, p in enumerate(places) for name, f in (("low", F.min), ("high", F.max))]
    whole = rows.agg(*extent).first()
    span = [max(1e-12, (whole[f"high{k}"] or 0.0) - (whole[f"low{k}"] or 0.0)) for k in range(n_dims)]
    rows = rows.withColumn("node", F.lit(0))
    open_, leaves, number = {0: (0, shards)}, {}, 1  # node: (first shard, shards)
    while open_:
        leaves.update({n: first for n, (first, many) in open_.items() if many == 1})
        open_ = {n: v for n, v in open_.items() if v[1] > 1}
        if not open_:
            break
        nodes = {}
        for r in rows.filter(F.col("node").isin(list(open_))).groupBy("node").agg(F.sum("size").alias("bytes"), *extent).collect():
            many = open_[r["node"]][1]
            wide = max(range(n_dims), key=lambda k: ((r[f"high{k}"] - r[f"low{k}"]) / span[k], -k), default=n_dims)
            nodes[r["node"]] = {"dim": wide, "low": r[f"low{wide}"], "high": r[f"high{wide}"], "bytes": r["bytes"],
                                "left_bytes": r["bytes"] * (many // 2) / many}
        following, splits = {}, []
        for n, cut in sorted(_quantiles(rows, nodes, n_dims).items()):
            first, many = open_[n]
            splits.append({"node": n, "left": number, "right": number + 1, **cut})
            following[number] = (first, many // 2)
            following[number + 1] = (first + many // 2, many - many // 2)
            number += 2
        if splits:
            rows = _descend(rows, splits)
        open_ = following
    of_leaf = _small(rows, [(n, first) for n, first in leaves.items()] or [(0, 0)], "node int, shard int")
    return rows.join(of_leaf, "node", "left").withColumn("shard", F.coalesce("shard", F.lit(0)))


def assign(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), shards: int = SHARDS,
           dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(*carry, size, text_crc32, shard, slot) of every row."""
    rows, n_dims = _rows(docs, carry, dimensions)
    placed = persist(_split_all(rows, n_dims, shards).select(*carry, "size", "text_crc32", "shard", "row",
                                                             F.element_at("at", -1).alias("tie")), "shard-placed")
    return _with_slots(placed).select(*carry, "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame) -> DataFrame:
    """Slots from 0 without gaps in every shard, numbered piece by piece so that no shard is one task's."""
    from pyspark.sql import Window
    n = placed.count()
    pieces = max(1, math.ceil(n / PIECE_ROWS))
    cut = placed.withColumn("piece", F.floor(F.col("tie") * pieces).cast("int"))
    counts = cut.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    before = counts.select("shard", "piece", (F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("before"))
    inner = cut.withColumn("inner", F.row_number().over(Window.partitionBy("shard", "piece").orderBy("tie", "row")))
    return inner.join(before, ["shard", "piece"]).withColumn("slot", (F.col("before") + F.col("inner") - 1).cast("long"))


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    return assign(docs, ("doc_id",), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with their shard and slot."""
    ids, named = row_id_names(docs), with_row_id(docs)
    shard, slot = tmp_name(docs, "llm_shard"), tmp_name(docs, "llm_slot")
    places = assign(named, ids, shards).select(*ids, F.col("shard").alias(shard), F.col("slot").alias(slot))
    taken = {c.lower() for c in docs.columns}
    names = ["shard" if "shard" not in taken else shard, "slot" if "slot" not in taken else slot]
    return named.join(places, list(ids)).select(*(F.col(f"`{c}`") for c in docs.columns), F.col(shard).alias(names[0]), F.col(slot).alias(names[1]))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write ``docs`` as one Parquet folder per shard, rows in slot order within each file."""
    out = sharded_documents(docs, shards)
    shard, slot = out.columns[-2:]
    # Rebalanced, so that a shard far larger than a task is written by several.
    out.hint("rebalance", F.col(shard)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
