"""SimHash near-duplicates: tiled exact comparison of fingerprints.

Fingerprints are made of word shingles. Distinct fingerprints are dealt into
blocks by hash, every pair of blocks is one group of a bounded size, and a
group compares its fingerprints tile by tile with exclusive-or and bit counts
in numpy. Tiles hold fingerprints sorted by the population counts of their
halves and quarters; a pair of tiles whose counts differ beyond the radius is
skipped, since ``|pop(x) - pop(y)|`` never exceeds the number of differing bits
of any part. A group emits a spanning forest of the links that it finds, never
all pairs.

The comparison is exact and hence quadratic in the number of distinct
fingerprints; see the README for what that means at scale.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, stored, texts_of
from .components import components, matched

SEED = 42
TILE = 256
#: At most so many distinct fingerprints meet in a block; a group holds two blocks.
BLOCK = 1 << 19
#: At least so many blocks, for parallel work on small inputs.
BLOCKS = 12
#: How many standard deviations more bits than expected at a similarity may differ in a pair that is to be checked.
DEVIATIONS = 4.5
#: A group that checks pairs holds about so many different texts and so many of their shingles at most (more only for a longer text).
CHECKED_TEXTS, CHECKED_SHINGLES = 4096, 2_000_000
#: Up to so many texts are named to all tasks (40 bytes each) to be read; beyond, by a shuffle.
BROADCAST_TEXTS = 200_000
_SPREAD = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Further 64 hash bits for lane 1 and up (a splitmix64 step)."""
    if lane == 0:
        return h
    with np.errstate(over="ignore"):
        z = h + np.uint64((0x9E3779B97F4A7C15 * lane) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _majorities(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each run of ``h`` that begins at ``starts``: the 64 bits that over half of its members have."""
    sizes = np.diff(np.append(starts, len(h)))
    chunks = -(-sizes // 255)  # eight 8-bit counters in a word count up to 255
    first = np.cumsum(chunks) - chunks
    at = np.repeat(starts, chunks) + 255 * (np.arange(chunks.sum()) - np.repeat(first, chunks))
    octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    sums = np.empty((len(at), 8), dtype="<u8")
    for k in range(8):
        sums[:, k] = np.add.reduceat(_SPREAD[octets[:, k]], at)
    counts = np.add.reduceat(sums.view(np.uint8).reshape(-1, 64).astype(np.int64), first, axis=0)
    return np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def hashes_of(text: str, shingle: int) -> list[int]:
    """Hashes of all word shingles, repeats included; of a text with fewer words, that of all of them; none without words."""
    words = text.encode().lower().split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    intdigest = xxhash.xxh64_intdigest
    return [intdigest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))]


def fingerprints_of(texts: list[str], shingle: int, lanes: int) -> tuple[np.ndarray, list[int]]:
    """(texts, lanes) unsigned 64-bit words, and how many different shingles each text has."""
    out = np.zeros((len(texts), lanes), dtype=np.uint64)
    hashes: list[int] = []
    starts, rows, sizes = [], [], []
    for row, text in enumerate(texts):
        own = hashes_of(text, shingle)
        sizes.append(len(set(own)))
        if own:
            rows.append(row)
            starts.append(len(hashes))
            hashes += own
    if rows:
        h, at = np.array(hashes, dtype=np.uint64), np.array(starts)
        for lane in range(lanes):
            out[rows, lane] = _majorities(_mixed(h, lane), at)
    return out, sizes


def _keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, h1, h2)``: 128 bits of hash stand for a text; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"))


def fingerprints(docs: DataFrame, shingle: int = 3, lanes: int = 1) -> DataFrame:
    """``(doc_id, h1, h2, size, fp)``: a hash of the text, its number of different shingles, and the big-endian binary of ``lanes`` 64-bit words.

    A-Z are lower-cased, words are runs without ASCII white space. Null and
    empty texts get zero. Other columns are ignored.
    """
    names = ["doc_id", "h1", "h2", "size", "fp"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, sizes = fingerprints_of(texts_of(part.column(1)), shingle, lanes)
                fp = pa.array([w.tobytes() for w in words.astype(">u8")], pa.binary())
                yield pa.record_batch([part.column(0), part.column(2), part.column(3), pa.array(sizes, pa.int32()), fp], names)

    return _keyed(docs).mapInArrow(run, "doc_id long, h1 long, h2 long, size int, fp binary")


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return up
        parent = up


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        parent = parent.copy()
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent = _roots(parent)


def _counts(x: np.ndarray) -> np.ndarray:
    """(n, 6) population counts: of the upper and the lower half, and of the two quarters of each."""
    quarters = [np.bitwise_count(x >> np.uint64(16 * q) & np.uint64(0xFFFF)).astype(np.int16) for q in (3, 2, 1, 0)]
    return np.stack([quarters[0] + quarters[1], quarters[2] + quarters[3], *quarters], axis=1)


def close_pairs(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = TILE, sizes: np.ndarray | None = None, ratio: float = 0.0):
    """Index pairs (into left followed by right) within ``radius`` and their differing bits, tile by tile.

    left, right: (n, lanes) words; right None: pairs within left. Pairs of tiles
    whose counts of any parts of all lanes differ by more than the radius are
    skipped, and, with ``sizes``, those of which no pair of sizes has at least
    the given ratio; neither can hold a pair that is asked for.
    """
    whole = left if right is None else np.concatenate([left, right])
    lanes = whole.shape[1]
    columns = [np.ascontiguousarray(whole[:, lane]) for lane in range(lanes)]
    counts = np.concatenate([_counts(x) for x in columns], axis=1)
    space = np.empty((tile, tile), dtype=np.uint64)
    size = np.ones(len(whole)) if sizes is None else sizes.astype(float)

    def tiles(ids: np.ndarray):
        """Ids by tile, and the least and largest counts and sizes of each tile."""
        ids = ids[np.lexsort((*counts[ids].T[[4, 2, 1, 0]], size[ids]))]
        at = np.arange(0, len(ids), tile)
        if not len(at):
            return [], counts[:0], counts[:0], size[:0], size[:0]
        return np.split(ids, at[1:]), np.minimum.reduceat(counts[ids], at), np.maximum.reduceat(counts[ids], at), np.minimum.reduceat(size[ids], at), np.maximum.reduceat(size[ids], at)

    mine, low, high, least, most = tiles(np.arange(len(left)))
    other, olow, ohigh, oleast, omost = (mine, low, high, least, most) if right is None else tiles(np.arange(len(left), len(whole)))
    for k, a in enumerate(mine):
        gap = np.maximum(0, np.maximum(low[k] - ohigh, olow - high[k])).reshape(len(other), lanes, 6)
        bound = (np.maximum(gap[:, :, 0], gap[:, :, 2] + gap[:, :, 3]) + np.maximum(gap[:, :, 1], gap[:, :, 4] + gap[:, :, 5])).sum(axis=1)
        alike = (omost >= ratio * least[k]) & (most[k] >= ratio * oleast)
        for m in np.nonzero((bound <= radius) & alike)[0]:
            if right is None and m < k:
                continue
            b = other[m]
            differ = None
            for x in columns:
                own = np.bitwise_count(np.bitwise_xor(x[a][:, None], x[b][None, :], out=space[: len(a), : len(b)]))
                differ = own if differ is None else np.add(differ, own, out=differ, dtype=np.uint8) if lanes < 4 else differ.astype(np.uint16) + own
            if differ.min() > radius:
                continue
            # one dimension is searched several times faster than two
            at = np.flatnonzero(differ.ravel() <= radius)
            i, j = np.divmod(at, len(b))
            d, i, j = differ.ravel()[at], a[i], b[j]
            if right is None and m == k:
                once = i < j
                i, j, d = i[once], j[once], d[once]
            if sizes is not None:
                fits = np.minimum(size[i], size[j]) >= ratio * np.maximum(size[i], size[j])
                i, j, d = i[fits], j[fits], d[fits]
            yield i, j, d


def forest(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = TILE, sizes: np.ndarray | None = None, ratio: float = 0.0):
    """Index pairs of a spanning forest of all links within ``radius``, with ``sizes`` of those whose sizes have the ratio."""
    parent = np.arange(len(left) + (0 if right is None else len(right)))
    for i, j, _ in close_pairs(left, right, radius, tile, sizes, ratio):
        parent = _unite(parent, i, j)
    linked = np.nonzero(parent != np.arange(len(parent)))[0]
    return linked, parent[linked]


class _Sets:
    """Sets of hashes, and how many members pairs of them have in common."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        known, self.ids = np.unique(flat, return_inverse=True)
        self.mark = np.zeros(len(known) + 1, dtype=bool)

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.ids[self.starts[i] :][: self.sizes[i]]
        self.mark[own] = True
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[others] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        total = np.concatenate([[0], np.cumsum(self.mark[self.ids[at]], dtype=np.int64)])
        self.mark[own] = False
        return total[ends] - total[ends - sizes]


def checked_forest(fp: np.ndarray, split: int | None, sets: _Sets, radius: int, similarity: float):
    """Index pairs of a spanning forest of all pairs within ``radius`` whose sets have the Jaccard similarity.

    Pairs within the first ``split``, with those after it (None: all pairs).
    Every pair is checked unless pairs that were checked connect its ends already.
    """
    n = len(fp)
    parent = np.arange(n)
    left, right = (fp, None) if split is None else (fp[:split], fp[split:])
    for i, j, d in close_pairs(left, right, radius, sizes=sets.sizes, ratio=similarity):
        # nearest first, a few to begin with: what they connect needs no further check
        order = np.argsort(d, kind="stable")
        i, j = i[order], j[order]
        at, step = 0, 256
        while at < len(i):
            a, b = i[at : at + step], j[at : at + step]
            open_ = parent[a] != parent[b]
            a, b = a[open_], b[open_]
            by = np.argsort(a, kind="stable")
            a, b = a[by], b[by]
            cuts = np.flatnonzero(np.diff(a)) + 1
            for k, m in zip([0, *cuts], [*cuts, len(a)], strict=True):
                if k < m:
                    x, ys = int(a[k]), b[k:m]
                    both = sets.common(x, ys)
                    true = ys[both >= similarity * (sets.sizes[x] + sets.sizes[ys] - both)]
                    parent = _unite(parent, np.full(len(true), x), true)
            at, step = at + step, min(2 * step, 1 << 14)
    linked = np.nonzero(parent != np.arange(n))[0]
    return linked, parent[linked]


def links(nodes: DataFrame, lanes: int, radius: int, ratio: float | None = None) -> DataFrame:
    """``nodes(node, size, fp)`` to ``(a, b)``, from every pair of blocks: a spanning forest of the links, with a ratio of those whose sizes have it."""
    blocks = max(BLOCKS, math.ceil(nodes.count() / BLOCK))
    cells = (
        nodes.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .select((F.least("block", "other") * blocks + F.greatest("block", "other")).alias("cell"), "block", "node", "size", "fp")
    )

    def compare(key, group):
        first, second = divmod(key[0].as_py(), blocks)
        block, node, size = (group.column(c).to_numpy() for c in ("block", "node", "size"))
        fp = np.frombuffer(b"".join(group.column("fp").to_pylist()), dtype=">u8").reshape(-1, lanes).astype(np.uint64)
        mine, other = np.nonzero(block == first)[0], np.nonzero(block == second)[0]
        order = mine if first == second else np.concatenate([mine, other])
        right = None if first == second else fp[other]
        a, b = forest(fp[mine], right, radius, sizes=None if ratio is None else size[order], ratio=ratio or 0.0)
        return pa.table({"a": node[order][a], "b": node[order][b]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return cells.groupBy("cell").applyInArrow(compare, "a long, b long")


def _classes(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``nodes(node, first, ...)`` with root and the smallest ``first`` of its class; links are ``found(a, b)``."""
    rooted = nodes.join(components(found), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min(F.struct("first", "node")).alias("best"), F.count("*").alias("n"))
    return matched(rooted, smallest, "root", rooted.count()).drop("n")


def near_duplicates(docs: DataFrame, shingle: int = 3, lanes: int = 1, radius: int = 3) -> DataFrame:
    """Every row of ``docs(doc_id, text, ...)`` as ``(doc_id, fingerprint, component_id)``.

    Two fingerprints link at ``radius`` or fewer differing bits; component_id is
    the smallest doc_id reachable over links, the row's own included. Equal
    fingerprints link too, those of empty texts among them. Rows that repeat
    stay, each with the same result; texts that share a doc_id may come with
    different classes. Rows without doc_id keep their fingerprint and get a null
    component. Texts of any length are taken whole, other columns are ignored.
    An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle, lanes).select("doc_id", "size", "fp"), "fingerprints")
    distinct = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first"), F.min("size").alias("size"))
    # the table is written before the ids are used, so they stay
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    classes = _classes(nodes, links(nodes, lanes, radius)).select("fp", F.col("best.first").alias("component_id"))
    return prints.join(classes, "fp", "left").select(
        "doc_id",
        F.lower(F.hex("fp")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def radius_for(similarity: float, bits: int, deviations: float = 0.0) -> int:
    """Differing bits that ``bits`` SimHash bits are expected to have at a Jaccard similarity of shingles, and some standard deviations more."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def verified(docs: DataFrame, nodes: DataFrame, classes: DataFrame, radius: int, similarity: float, shingle: int, lanes: int) -> DataFrame:
    """``(a, b)``: a spanning forest of the links of exact Jaccard similarity within each of ``classes(node, root)``, which are connected by pairs that SimHash proposes.

    Only texts of classes are read. Small classes meet by several in a group,
    large ones are cut into blocks, and each pair of blocks is a group: none
    holds more than a bounded number of texts and shingles, and every proposed pair meets in one.
    """
    members = classes.unionByName(classes.select(F.col("root").alias("node"), "root").distinct())
    need = stored(nodes.join(members, "node").select("node", "root", "size", "fp", F.col("first").alias("doc_id"), "h1", "h2"), "need")
    asked = F.broadcast(need) if need.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS else need

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(np.array(hashes_of(t, shingle), dtype=np.uint64)).view(np.int64) for t in texts_of(part.column(3))]
                yield pa.record_batch([*part.columns[:3], pa.array(sets, pa.list_(pa.int64()))], ["node", "root", "fp", "set"])

    texts = _keyed(docs).join(asked, ["doc_id", "h1", "h2"]).select("node", "root", "fp", "text")
    sets = stored(texts.mapInArrow(run, "node long, root long, fp binary, set array<long>").dropDuplicates(["node"]), "sets")
    classed = sets.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.size("set")).alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / CHECKED_TEXTS), F.ceil(F.col("shingles") / CHECKED_SHINGLES)).cast("int")
    sized = stored(classed.withColumn("blocks", blocks), "sized")
    some = sized.where("blocks = 1").agg(F.sum("n"), F.sum("shingles")).first()
    bins = max(1, math.ceil((some[0] or 0) / CHECKED_TEXTS), math.ceil((some[1] or 0) / CHECKED_SHINGLES))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = matched(sets, sized, "root", max(1, need.count())).withColumn("block", block)
    alone = rows.where("blocks = 1").select(F.lit(None).cast("long").alias("large"), F.pmod(F.xxhash64("root"), F.lit(bins)).cast("int").alias("x"), F.lit(0).alias("y"), "block", "node", "root", "fp", "set")
    cut = rows.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = alone.unionByName(cut.select(F.col("root").alias("large"), F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "root", "fp", "set"))

    def check(key, group):
        first, second = key[1].as_py(), key[2].as_py()
        large = key[0].as_py() is not None
        node, root, block_ = (group.column(c).to_numpy() for c in ("node", "root", "block"))
        fp = np.frombuffer(b"".join(group.column("fp").to_pylist()), dtype=">u8").reshape(-1, lanes).astype(np.uint64)
        lists = group.column("set").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        bounds = lists.offsets.to_numpy()
        flat, sizes = np.asarray(lists.values)[bounds[0] : bounds[-1]], np.diff(bounds)
        starts = bounds[:-1] - bounds[0]
        a, b = [], []
        order = np.lexsort((block_ == second, root)) if large and first != second else np.argsort(root, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(root[order])) + 1, len(order))
        at = 0
        for to in ends:
            own, at = order[at:to], to
            if len(own) < 2:
                continue
            values = np.concatenate([flat[starts[k] :][: sizes[k]] for k in own])
            split = int((block_[own] == first).sum()) if large and first != second else None
            i, j = checked_forest(fp[own], split, _Sets(values, sizes[own]), radius, similarity)
            a.append(node[own][i])
            b.append(node[own][j])
        none = np.zeros(0, dtype=np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return cells.groupBy("large", "x", "y").applyInArrow(check, "a long, b long")


def deduplicated(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, lanes: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest doc_id stays, with all its columns.

    SimHash proposes pairs: all pairs of different texts are compared within a
    radius of ``DEVIATIONS`` standard deviations beyond what is expected at
    ``similarity``. Each of these pairs is checked by the exact Jaccard similarity
    of their sets of five-word shingles, unless pairs that were checked connect
    it already; groups are connected by checked pairs. Texts without
    words are near-duplicates of each other. Rows without doc_id stay. Of rows
    that are equal in doc_id and text one stays; a doc_id that comes with
    different texts is no duplicate by itself. Column names are free.
    """
    prints = stored(fingerprints(docs, shingle, lanes), "fingerprints")
    distinct = prints.where("doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"), F.min("size").alias("size"))
    nodes = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    radius = radius_for(similarity, 64 * lanes, DEVIATIONS)
    proposed = stored(components(links(nodes, lanes, radius, similarity)), "proposed")
    true = stored(verified(docs, nodes, proposed, radius, similarity, shingle, lanes), "pairs")
    kept = _classes(nodes, true).where("node = best.node").select(F.col("first").alias("doc_id"), "h1", "h2")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    stay = rows.join(kept, ["doc_id", "h1", "h2"], "left_semi").dropDuplicates(["doc_id", "h1", "h2"])
    return stay.unionByName(rows.where("doc_id is null")).select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
