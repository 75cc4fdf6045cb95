"""Approximate nearest neighbours by inner product: NN-descent graph, greedy graph search.

Vectors are dealt into zones by length, each half as long as the one before, so that one very long vector
sets no scale for the others. Within a zone they get one more component that gives all of them the same
length, so that a larger inner product is a smaller distance and the graph is a metric one; edges stay
within a zone, all zones are built and searched in the same jobs, and what they give is merged by exact
score. Equal vectors are one node; the copies come back when the answers are written out.

The graph starts from blocks of vectors around the same pivot and is improved in rounds: each node
introduces its neighbours (both directions, new ones to all) to each other, as a join of the edge table
with the vectors, and each node keeps the best ``DEGREE`` it has met. Rounds end when few edges change.
Sampling both directions to ``SAMPLE`` is part of the method and bounds what a node gathers, however
many nodes point to it. A query starts at its nearest pivots of every zone (and at itself, if it is a node)
and expands the best nodes it has seen, a few per round for all queries at once, until its best ``BEAM`` of each
zone are all expanded. Found candidates are scored again in double precision.

Every row is indexed; only the pivots are a sample (``MAX_PIVOTS`` per zone at most, by hash). Each round's
tables are written to the shared folder. Defined results: vectors that are null, empty, zero or hold
null or non-finite components, of another length than most, and rows without vec_id take no part; of
rows that share a vec_id the smallest vector counts; ties go to the smaller vec_id; with fewer
candidates all are returned; a score beyond the double
range is infinite, and 0 where infinities cancel out; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import persist, prepare

DEGREE = 56
SAMPLE = 20
BLOCK = 384
PIVOT_SHARE = 256
MAX_PIVOTS = 2048
#: Rounds end when fewer than this share of the edges is new.
SETTLED = 0.02
BEAM = 64
EXPAND = 16
ENTRIES = 4


def _matrix(column: pd.Series) -> np.ndarray:
    """Vectors stored as half-precision bytes, as rows."""
    return np.frombuffer(b"".join(column), dtype="<f2").reshape(len(column), -1).astype(np.float32)


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a stream sorted by ``key``; groups are short here by construction."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        keys = rest[key].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        start = 0
        for cut in cuts.tolist():
            yield rest.iloc[start:cut]
            start = cut
        rest = rest.iloc[start:]
    if rest is not None and len(rest):
        yield rest


def _collected(frames: Iterator[tuple[np.ndarray, ...]], names: list[str], rows: int = 100_000) -> Iterator[pd.DataFrame]:
    held, n = [], 0
    for f in frames:
        held.append(f)
        n += len(f[0])
        if n >= rows:
            yield pd.DataFrame({name: np.concatenate(c) for name, c in zip(names, zip(*held))})
            held, n = [], 0
    if held:
        yield pd.DataFrame({name: np.concatenate(c) for name, c in zip(names, zip(*held))})


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec): one usable vector per id, as array<double>."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    fine = (F.col("vec_id").isNotNull() & (F.size("vec") > 0)
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    rows = embeddings.select("vec_id", vec.alias("vec")).filter(F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    rows = rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _nodes(classes: DataFrame) -> DataFrame:
    """(node, zone, vec): the vector over its zone's greatest length, with the component that makes all lengths 1.

    Zone z has lengths over 2^-(z+1) and up to 2^-z of the longest. Half precision is enough to find candidates
    and halves what the rounds shuffle.
    """
    largest = F.aggregate("vec", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    # By the largest component first: squares of very long vectors overflow.
    sized = classes.select("node", "vec", largest.alias("most"))
    scaled = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + (x / F.col("most")) * (x / F.col("most"))))
    sized = persist(sized.withColumn("log", F.log2("most") + F.log2(scaled)), "ann-lengths")
    top = sized.agg(F.max("log")).first()[0] or 0.0
    zoned = sized.select("node", F.floor(F.lit(top) - F.col("log")).cast("int").alias("zone"), "vec")

    def pack(batches):
        for batch in batches:
            if len(batch):
                x, zone = np.stack(batch["vec"].to_numpy()), batch["zone"].to_numpy()
                # 2^-512 at a time: the factor itself may be out of the doubles' range.
                power = zone - top
                x = x * np.exp2(power / 2)[:, None] * np.exp2(power / 2)[:, None]
                extra = np.sqrt(np.maximum(1.0 - (x * x).sum(axis=1), 0.0))
                packed = np.concatenate((x, extra[:, None]), axis=1).astype("<f2")
                yield pd.DataFrame({"node": batch["node"], "zone": batch["zone"], "vec": [r.tobytes() for r in packed]})

    return persist(zoned.mapInPandas(pack, "node long, zone int, vec binary"), "ann-nodes")


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's best ``degree`` different neighbours; an edge known before is not new."""
    each = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.min("born").alias("born"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= degree).drop("rank")


class Pivots:
    """A bounded sample of each zone's nodes: zone → (first number of its pivots, node numbers, vectors)."""

    def __init__(self, rows: list):
        self.zones: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        by_zone: dict[int, list] = {}
        for r in rows:
            by_zone.setdefault(r["zone"], []).append(r)
        self.count = 0
        for zone, own in sorted(by_zone.items()):
            self.zones[zone] = (self.count, np.array([r["node"] for r in own]), _matrix([r["vec"] for r in own]))
            self.count += len(own)


def _pivots(nodes: DataFrame) -> Pivots:
    """By hash, one in ``PIVOT_SHARE`` and at most ``MAX_PIVOTS`` of each zone."""
    # A row per zone, and doubles have some 2,100 lengths that differ by a factor of two.
    sizes = F.broadcast(nodes.groupBy("zone").agg(F.count("*").alias("n")))
    many = F.greatest(F.lit(1), F.least(F.lit(MAX_PIVOTS), F.floor(F.col("n") / PIVOT_SHARE)))
    place = F.xxhash64("node", F.lit(7)) / F.lit(2.0 ** 64) + 0.5
    # A few times as many as wanted are ranked, whatever the zone's size.
    some = nodes.join(sizes, "zone").withColumn("place", place).filter((F.col("n") < 4 * PIVOT_SHARE) | (F.col("place") * F.col("n") < 4 * many))
    nth = F.row_number().over(Window.partitionBy("zone").orderBy("place", "node"))
    return Pivots(some.withColumn("nth", nth).filter(F.col("nth") <= many).select("zone", "node", "vec", "nth").orderBy("zone", "nth").collect())


def _first_edges(nodes: DataFrame, pivots: Pivots, degree: int) -> DataFrame:
    """Best neighbours within blocks of vectors that share one of their two nearest pivots, and within random blocks."""
    def place(batches):
        for batch in batches:
            for zone, own in batch.groupby("zone"):
                base, _, vectors = pivots.zones[zone]
                near = np.argsort(-(_matrix(own["vec"]) @ vectors.T), axis=1)[:, :2]
                for k in range(near.shape[1]):
                    yield pd.DataFrame({"pivot": base + near[:, k], "node": own["node"], "vec": own["vec"]})
                # One more cell has the whole zone: its random blocks tie the others together.
                yield pd.DataFrame({"pivot": pivots.count + zone, "node": own["node"], "vec": own["vec"]})

    placed = persist(nodes.mapInPandas(place, "pivot int, node long, vec binary"), "ann-placed")
    # A full cell is cut into blocks, so that no task meets a large one.
    cells = placed.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = (placed.join(F.broadcast(cells), "pivot")
                     .withColumn("block", F.pmod(F.xxhash64("node", "pivot"), F.col("blocks")).cast("int")))

    def meet(batches):
        def each():
            for group in _runs(batches, ["pivot", "block"]):
                x, ids = _matrix(group["vec"]), group["node"].to_numpy()
                if len(ids) < 2:
                    continue
                sim = x @ x.T
                np.fill_diagonal(sim, -np.inf)
                k = min(degree, len(ids) - 1)
                top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                yield np.repeat(ids, k), ids[top].ravel(), np.take_along_axis(sim, top, axis=1).ravel()
        yield from _collected(each(), ["src", "dst", "sim"])

    edges = (blocked.select("pivot", "block", "node", "vec").repartition("pivot", "block").sortWithinPartitions("pivot", "block", "node")
                    .mapInPandas(meet, "src long, dst long, sim float"))
    return _best(edges.withColumn("fresh", F.lit(1)).withColumn("born", F.lit(1)), degree)


def _round(nodes: DataFrame, edges: DataFrame, degree: int, seed: int) -> DataFrame:
    """One round: neighbours of a node meet each other; who is nearer than the worst kept neighbour is proposed."""
    both = edges.select(F.col("src").alias("host"), F.col("dst").alias("guest"), "fresh").unionByName(
        edges.select(F.col("dst").alias("host"), F.col("src").alias("guest"), "fresh"))
    rank = F.row_number().over(Window.partitionBy("host", "fresh").orderBy(F.xxhash64("host", "guest", F.lit(seed)), "guest"))
    guests = (both.groupBy("host", "guest").agg(F.max("fresh").alias("fresh")).withColumn("rank", rank)
                  .filter(F.col("rank") <= 2 * SAMPLE).drop("rank")
                  # A host without new guests has nothing to introduce.
                  .withColumn("any", F.max("fresh").over(Window.partitionBy("host"))).filter("any = 1").drop("any"))
    worst = edges.groupBy("src").agg(F.min("sim").alias("least"), F.count("*").alias("n"))
    known = nodes.join(worst, nodes["node"] == worst["src"], "left").select(
        F.col("node").alias("guest"), "vec", F.when(F.col("n") >= degree, F.col("least")).otherwise(F.lit(float("-inf"))).cast("float").alias("least"))
    # Written before it is joined: a vector that very many hosts know can then be split off.
    known = persist(known, "ann-known")

    def meet(batches):
        def each():
            for group in _runs(batches, ["host"]):
                fresh = group["fresh"].to_numpy() == 1
                if len(group) < 2 or not fresh.any():
                    continue
                x, ids, least = _matrix(group["vec"]), group["guest"].to_numpy(), group["least"].to_numpy()
                sim = x @ x.T
                better = (sim > least[:, None]) & (fresh[:, None] | fresh[None, :])
                np.fill_diagonal(better, False)
                a, b = np.nonzero(better)
                if len(a):
                    yield ids[a], ids[b], sim[a, b]
        yield from _collected(each(), ["src", "dst", "sim"])

    proposed = (guests.join(known, "guest").select("host", "guest", "fresh", "vec", "least")
                      .repartition("host").sortWithinPartitions("host", "guest").mapInPandas(meet, "src long, dst long, sim float"))
    # An edge whose ends have met is old from now on; what was not sampled stays new.
    met = guests.filter("fresh = 1").select(F.col("host").alias("src"), F.col("guest").alias("dst"), F.lit(1).alias("met"))
    aged = edges.join(met, ["src", "dst"], "left").select("src", "dst", "sim", F.when(F.col("met").isNull(), F.col("fresh")).otherwise(0).alias("fresh"),
                                                                F.lit(0).alias("born"))
    return _best(aged.unionByName(proposed.withColumn("fresh", F.lit(1)).withColumn("born", F.lit(1))), degree)


class Graph:
    """nodes (node, vec), neighbours (src, dst) and the entry pivots."""

    def __init__(self, nodes: DataFrame, neighbours: DataFrame, entries: Pivots):
        self.nodes, self.neighbours, self.entries = nodes, neighbours, entries


def build_graph(classes: DataFrame, degree: int = DEGREE) -> Graph | None:
    """NN-descent over (node, vec) with different vectors; None if there is none."""
    nodes = _nodes(classes)
    n = nodes.count()
    if not n:
        return None
    pivots = _pivots(nodes)
    edges = persist(_first_edges(nodes, pivots, degree), "ann-edges")
    # Kept neighbours only get nearer, so the rounds come to an end.
    for k in itertools.count():
        edges = persist(_round(nodes, edges, degree, k), "ann-edges")
        # Edges that came in this round; others may still be new to some hosts, as those sample.
        if edges.filter("born = 1").count() <= SETTLED * n * degree:
            break
    # Searching also walks edges backwards: from a node to the nearest referrers it does not point to itself.
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    back = (edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "sim").join(edges.select("src", "dst"), ["src", "dst"], "left_anti")
                 .withColumn("rank", rank).filter(F.col("rank") <= degree))
    return Graph(nodes, persist(edges.select("src", "dst").unionByName(back.select("src", "dst")), "ann-neighbours"), pivots)


def _scored(pairs: DataFrame, nodes: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, node, sim) for pairs (query, node)."""
    def score(batches):
        for batch in batches:
            if len(batch):
                sim = np.einsum("ij,ij->i", _matrix(batch["qvec"]), _matrix(batch["vec"]))
                yield pd.DataFrame({"query": batch["query"], "node": batch["node"], "sim": sim})

    return (pairs.join(nodes, "node").join(queries, "query").select("query", "node", "qvec", "vec")
                 .mapInPandas(score, "query long, node long, sim float"))


def search(graph: Graph, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """(query, node, sim): the best nodes found for queries (query, vec as array<double>, own: a node or null), in each zone.

    ``sim`` orders one query's nodes within a zone only.
    """
    pivots = graph.entries

    def start(batches):
        for batch in batches:
            if len(batch):
                x = np.stack(batch["vec"].to_numpy())
                # Only the order of one query's products matters: its own length is set to 1.
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                x = np.concatenate((x, np.zeros((len(x), 1))), axis=1).astype("<f2")
                for zone, (_, ids, vectors) in pivots.zones.items():
                    near = np.argsort(-(x.astype(np.float32) @ vectors.T), axis=1)[:, :ENTRIES]
                    yield pd.DataFrame({"query": batch["query"], "qvec": [r.tobytes() for r in x],
                                        "entries": [ids[e].tolist() + ([own[0]] if len(own) and own[1] == zone else [])
                                                    for e, own in zip(near, batch["own"])]})

    # The own node and its zone travel as an array: a null among integers would turn them into floats.
    zones = graph.nodes.select(F.col("node").alias("own"), "zone")
    own = F.when(F.col("zone").isNull(), F.array().cast("array<long>")).otherwise(F.array("own", F.col("zone").cast("long"))).alias("own")
    asked = queries.join(zones, "own", "left").select("query", "vec", own).mapInPandas(start, "query long, qvec binary, entries array<long>")
    # Each query walks each zone on its own, as products of different zones do not compare.
    placed = persist(asked.withColumn("walk", F.monotonically_increasing_id()), "ann-queries")
    vectors = placed.select(F.col("walk").alias("query"), "qvec")
    first = placed.select(F.col("walk").alias("query"), F.explode(F.array_distinct("entries")).alias("node"))
    found = persist(_scored(first, graph.nodes, vectors).withColumn("open", F.lit(1)), "ann-beam")
    while True:
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "node"))
        frontier = persist(found.filter("open = 1").withColumn("rank", rank).filter(F.col("rank") <= EXPAND).select("query", "node"), "ann-frontier")
        if frontier.isEmpty():
            break
        steps = (frontier.join(graph.neighbours, frontier["node"] == F.col("src")).select("query", F.col("dst").alias("node")).distinct()
                         .join(found.select("query", "node"), ["query", "node"], "left_anti"))
        walked = found.join(frontier.withColumn("now", F.lit(1)), ["query", "node"], "left").select(
            "query", "node", "sim", F.when(F.col("now") == 1, 0).otherwise(F.col("open")).alias("open"))
        every = walked.unionByName(_scored(steps, graph.nodes, vectors).withColumn("open", F.lit(1)))
        found = persist(every.withColumn("rank", rank).filter(F.col("rank") <= beam).drop("rank"), "ann-beam")
    walks = placed.select("walk", F.col("query").alias("of"))
    return (found.join(walks, F.col("query") == F.col("walk")).groupBy(F.col("of").alias("query"), "node").agg(F.max("sim").alias("sim")))


def nearest(embeddings: DataFrame, k: int = 20, is_query: Column | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows ``is_query`` marks, the ``k`` best other rows found."""
    prepare(embeddings.sparkSession)
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    rows = persist(usable(embeddings), "ann-rows")
    classes = persist(rows.groupBy("vec").agg(F.min("vec_id").alias("node")), "ann-classes")
    graph = build_graph(classes)
    asked = persist(rows.filter(is_query).join(classes, "vec").select("vec_id", "node"), "ann-asked")
    if graph is None:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    distinct = asked.select("node").distinct()
    queries = classes.join(distinct, "node").select(F.col("node").alias("query"), "vec", F.col("node").alias("own"))
    found = search(graph, queries)
    # Exact scores on the original vectors, in double precision.
    left = classes.select(F.col("node").alias("query"), F.col("vec").alias("a"))
    right = classes.select("node", F.col("vec").alias("b"))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = found.select("query", "node").join(right, "node").join(left, "query").select("query", "node", F.nanvl(dot, F.lit(0.0)).alias("score"))
    # Of a class of equal vectors only the smallest ids can be among the best; one more than k, as one may be the asker.
    rank_in = F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))
    members = (rows.join(classes, "vec").select("node", "vec_id").withColumn("nth", rank_in).filter(F.col("nth") <= k + 1).drop("nth"))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    answers = scored.join(members, "node").withColumn("nth", best).filter(F.col("nth") <= k + 1).select("query", "vec_id", "score")
    each = (asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(answers, "query")
                 .filter(F.col("query_id") != F.col("vec_id")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
