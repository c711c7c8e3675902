"""Approximate nearest neighbours: NN-descent and greedy graph search.

Equal vectors are one node. Random-projection trees, fitted on a bounded sample,
put all nodes into leaves; the nearest within leaves are the first neighbour
lists. Each round of NN-descent joins nodes with the vectors of their neighbours
and reverse neighbours, compares all that meet at a node with each other, and
keeps what is nearer than what a list had; rounds go on until few entries
change. A query walks the graph from its own node: it opens the nearest nodes
that it has not opened yet, ``BEAM`` at a time, and keeps the ``POOL`` nearest
nodes seen, until all of these are open.

The graph is a table of edges. What meets at a node comes to a worker as sorted
rows, so that memory holds some thousand of them, whatever the table's size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import stored

#: Neighbours of a node in its list, and reverse neighbours that the graph adds, the nearest first.
NEIGHBOURS = 32
REVERSE = 32
TREES = 12
LEAF = 1_024
#: Vectors that trees are fitted on, those with the smallest hash of the id.
SAMPLE = 8_192
#: NN-descent ends once a round changes no more than this share of the lists' entries.
CHANGED = 0.01
POOL = 192
BEAM = 64
#: Edges that are compared at once.
ROWS = 20_000
_STATE = "array<struct<d:double,id:long,open:boolean>>"


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``, v an array of doubles: rows whose vector is not null, zero or empty, and has finite components only. Shorter vectors end in zeros."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: F.coalesce((x == x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & good)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.select("vec_id", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v"))).alias("v"))


def classes(rows: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(id, v)`` of different vectors, id the smallest vec_id; and ``(vec_id, node)`` of the ``top`` smallest vec_ids of each."""
    nodes = rows.groupBy("v").agg(F.min("vec_id").alias("id"))
    # the place limits rows before the shuffle too, so a vector that many rows share stays small
    order = Window.partitionBy("v").orderBy("vec_id")
    members = rows.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    first = members.groupBy("v").agg(F.min("vec_id").alias("node"))
    return nodes, members.join(first, "v").select("vec_id", "node")


class Trees:
    """Random-projection trees in heap order; a leaf's number has one bit for each level."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 42, trees: int = TREES):
        draw = np.random.default_rng(seed)
        self.depth, dim = depth, sample.shape[1]
        self.normal = np.zeros((trees, 2**depth, dim), dtype=np.float32)
        self.at = np.zeros((trees, 2**depth), dtype=np.float32)
        for t in range(trees):
            leaf = np.ones(len(sample), dtype=np.int64)
            for node in range(1, 2**depth):
                own = sample[leaf == node]
                if len(own) > 1:
                    a, b = own[draw.choice(len(own), 2, replace=False)]
                    self.normal[t, node] = a - b
                else:
                    self.normal[t, node] = draw.normal(size=dim)
                side = own @ self.normal[t, node]
                self.at[t, node] = np.median(side) if len(own) else 0
                leaf[leaf == node] = 2 * node + (side > self.at[t, node])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        out = np.ones((len(x), len(self.at)), dtype=np.int64)
        for t in range(len(self.at)):
            for _ in range(self.depth):
                node = out[:, t]
                out[:, t] = 2 * node + ((x * self.normal[t, node]).sum(axis=1) > self.at[t, node])
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), dtype=np.float32)


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances of all rows, about their mean so that large vectors keep their digits; a row is infinitely far from itself."""
    x = x - x.mean(axis=0)
    square = (x * x).sum(axis=1)
    d = np.maximum(square[:, None] - 2 * x @ x.T + square[None, :], 0)
    np.fill_diagonal(d, np.inf)
    return d


_EDGES = "id long, other long, d float"


def _edges(ids: np.ndarray, others: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(d, pa.float32())], ["id", "other", "d"])


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """``(id, other, d, known)``: the k nearest of each node among edges ``(id, other, d, known)``, repeated ones once."""
    once = edges.repartition("id").groupBy("id", "other").agg(F.min("d").alias("d"), F.max("known").alias("known"))
    order = Window.partitionBy("id").orderBy("d", "other")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def first_edges(nodes: DataFrame, n: int, k: int, seed: int = 42) -> DataFrame:
    """Edges from the leaves of the trees; a leaf with more nodes than twice ``LEAF`` is dealt into parts."""
    sample = nodes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow().column("x").combine_chunks()
    depth = max(0, math.ceil(math.log2(max(1, n / LEAF))))
    trees = Trees(_matrix(sample), min(depth, 12), seed)

    def leaves(batches):
        for batch in batches:
            if batch.num_rows:
                found = trees.leaves(_matrix(batch.column(1)))
                for t in range(found.shape[1]):
                    yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found[:, t] * TREES + t)], ["id", "x", "leaf"])

    dealt = nodes.select("id", "x").mapInArrow(leaves, "id long, x array<float>, leaf long")
    sizes = dealt.groupBy("leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts"))
    parted = dealt.join(sizes, "leaf").withColumn("part", F.pmod(F.xxhash64("id", "leaf"), F.col("parts")))

    def compare(group):
        ids, d = group.column("id").to_numpy(), _squares(_matrix(group.column("x").combine_chunks()))
        few = min(k, len(ids) - 1)
        best = np.argpartition(d, few, axis=1)[:, :few] if few else np.zeros((len(ids), 0), dtype=np.int64)
        rows = np.repeat(np.arange(len(ids)), few)
        return pa.Table.from_batches([_edges(ids[rows], ids[best.ravel()], np.sqrt(d[rows, best.ravel()]))])

    return parted.groupBy("leaf", "part").applyInArrow(compare, _EDGES)


def both_ways(graph: DataFrame, reverse: int) -> DataFrame:
    """``(id, other)``: neighbours of a node, and of the nodes whose neighbour it is the ``reverse`` nearest."""
    order = Window.partitionBy("other").orderBy("d", "id")
    back = graph.withColumn("place", F.row_number().over(order)).where(F.col("place") <= reverse)
    return graph.select("id", "other").union(back.select("other", "id")).distinct()


def _meetings(batches):
    """Sorted rows ``(id, other, worst, x)`` to edges: of all that meet at one id, each pair that is nearer than what either end has."""

    def met(rows: pa.Table):
        ids = rows.column("id").to_numpy()
        other, worst, x = rows.column("other").to_numpy(), rows.column("worst").to_numpy(), _matrix(rows.column("x").combine_chunks())
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        left, right, far = [], [], []
        for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
            d = _squares(x[a:b])
            i, j = np.nonzero(d < worst[a:b, None] ** 2)
            left.append(other[a:b][i])
            right.append(other[a:b][j])
            far.append(np.sqrt(d[i, j]))
        return _edges(*map(np.concatenate, (left, right, far)))

    held: list[pa.RecordBatch] = []
    some = 0
    for batch in batches:
        held.append(batch)
        some += batch.num_rows
        if some < ROWS:
            continue
        table = pa.Table.from_batches(held)
        ids = table.column("id").to_numpy()
        cut = int(np.searchsorted(ids, ids[-1]))  # the last id may go on in the next batch
        if cut:
            yield met(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        some = len(ids) - cut
    if some:
        yield met(pa.Table.from_batches(held))


def descend(graph: DataFrame, nodes: DataFrame, k: int, reverse: int) -> DataFrame:
    """One round: everything that meets at a node, as neighbour or reverse neighbour, is compared with each other."""
    # a list that isn't full takes whatever comes
    worst = graph.groupBy("id").agg(F.when(F.count("*") >= k, F.max("d")).otherwise(F.lit(float("inf"))).cast("float").alias("worst"))
    ends = nodes.join(worst, "id", "left").select(F.col("id").alias("other"), F.coalesce("worst", F.lit(float("inf")).cast("float")).alias("worst"), "x")
    met = both_ways(graph, reverse).join(ends, "other").select("id", "other", "worst", "x").repartition("id").sortWithinPartitions("id")
    better = met.mapInArrow(_meetings, _EDGES).withColumn("known", F.lit(False))
    return _nearest(graph.withColumn("known", F.lit(True)).unionByName(better), k)


def build(nodes: DataFrame, k: int = NEIGHBOURS, reverse: int = REVERSE) -> DataFrame:
    """The neighbour graph ``(id, other, d)`` of ``nodes(id, x)``."""
    graph = stored(_nearest(first_edges(nodes, nodes.count(), k).withColumn("known", F.lit(True)), k), "graph")
    while True:
        graph = stored(descend(graph, nodes, k, reverse), "graph")
        changed, entries = graph.agg(F.count_if(~F.col("known")), F.count("*")).first()
        if changed <= CHANGED * entries:
            return graph


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays, in double precision."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, z: s + z))


def search(starts: DataFrame, graph: DataFrame, nodes: DataFrame, reverse: int = REVERSE, pool: int = POOL, beam: int = BEAM) -> DataFrame:
    """``(q, pool)`` for ``starts(q, x)``, q the node to start from: the nearest nodes found, ``(d, id, open)`` by distance.

    A node is fetched and compared once for each query. Each step opens a node
    or more of each query that isn't done, so there is an end.
    """
    adjacent = stored(both_ways(graph, reverse).groupBy("id").agg(F.collect_list("other").alias("others")), "adjacent")
    vectors = nodes.select(F.col("id").alias("c"), F.col("x").alias("w"))
    own = F.struct(F.lit(0.0).alias("d"), F.col("q").alias("id"), F.lit(True).alias("open"))
    now = stored(starts.select("q", F.array(own).cast(_STATE).alias("pool"), F.array("q").alias("seen")), "pool")
    while True:
        opened = now.withColumn("go", F.transform(F.slice(F.filter("pool", lambda p: p["open"]), 1, beam), lambda p: p["id"]))
        step = opened.where(F.size("go") > 0).select("q", F.explode("go").alias("id"))
        if step.limit(1).count() == 0:
            return now.select("q", "pool")
        reached = step.join(adjacent, "id").groupBy("q").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("reached"))
        joined = opened.join(reached, "q", "left").withColumn("fresh", F.coalesce(F.array_except("reached", "seen"), F.array().cast("array<long>")))
        joined = stored(joined.select("q", "pool", "seen", "go", "fresh"), "fresh")
        new = joined.select("q", F.explode("fresh").alias("c")).join(vectors, "c").join(starts, "q")
        found = new.select("q", F.struct(distance(F.col("x"), F.col("w")).alias("d"), F.col("c").alias("id"), F.lit(True).alias("open")).alias("p"))
        lists = found.groupBy("q").agg(F.collect_list("p").alias("new"))
        shut = F.transform("pool", lambda p: F.struct(p["d"].alias("d"), p["id"].alias("id"), (p["open"] & ~F.array_contains("go", p["id"])).alias("open")))
        merged = joined.join(lists, "q", "left").withColumn("shut", shut)
        both = F.array_sort(F.concat("shut", F.coalesce("new", F.array().cast(_STATE))))
        now = stored(merged.select("q", F.slice(both, 1, pool).alias("pool"), F.concat("seen", "fresh").alias("seen")), "pool")


def neighbours(vectors: DataFrame, is_query: Column | None = None, top: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` nearest found of each query among all rows but its own, nearest first, ties by vec_id.

    vectors: ``(vec_id, embedding, ...)``; other columns are ignored. is_query:
    condition on vec_id, ids divisible by 100 if None. Null, zero and empty
    vectors, those with null or non-finite components, and rows without vec_id
    take no part; vectors that are shorter than the longest count as if they
    ended in zeros. The graph is searched with floats, scores are of the
    vectors as they are, in double precision. Repeated rows count once. Where
    fewer candidates than ``top`` are found, all are returned; an empty table
    gives an empty result.
    """
    rows = stored(usable(vectors).repartition("vec_id"), "vectors")
    nodes, members = classes(rows, top + 1)
    nodes = stored(nodes.select("id", "v", F.col("v").cast("array<float>").alias("x")), "nodes")
    members = stored(members, "members")
    graph = build(nodes)
    # a row's first vector counts, of those that share a vec_id
    mine = rows.where(F.col("vec_id") % 100 == 0 if is_query is None else is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(mine.join(nodes.select("v", F.col("id").alias("node")), "v").select(F.col("vec_id").alias("q"), "node"), "queries")
    starts = stored(asked.select(F.col("node").alias("id")).distinct().join(nodes, "id").select(F.col("id").alias("q"), "x"), "starts")
    pools = search(starts, graph, nodes)
    # the nearest nodes hold the nearest rows, each has one at least, the query's own aside; which these are, doubles decide
    near = pools.select(F.col("q").alias("node"), F.explode("pool").alias("p")).select("node", F.col("p.id").alias("id"))
    ends = nodes.select("id", "v")
    scored = near.join(ends, "id").join(ends.select(F.col("id").alias("node"), F.col("v").alias("own")), "node").select("node", "id", distance(F.col("own"), F.col("v")).alias("score"))
    order = Window.partitionBy("node").orderBy("score", "vec_id")
    reached = scored.join(members.select(F.col("node").alias("id"), "vec_id"), "id")
    best = reached.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1).select("node", "vec_id", "score")
    found = asked.join(best, "node").where("vec_id <> q")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id"))).where(F.col("rank") <= top)
    return ranked.select(F.col("q").alias("query_id"), "rank", "vec_id", "score")
