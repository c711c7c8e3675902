"""Masked pseudo-likelihood by a bidirectional window network.

Every token is predicted from the two tokens on either side of it; a document's
score is the sum of the logarithms of the conditional probabilities of its
tokens. The most frequent words have a leaf and an embedding of their own; how
many grows with the square root of the corpus, as vocabularies do. Rarer words
share leaves by hash, and within a leaf go by their counts, which are those of
the whole corpus.

Leaves hang on a Huffman tree of 32 branches. A word's probability is the
product of the choices on its path, one softmax each, so all words add up to 1
without a sum over the vocabulary. At the start choices follow the counts, and
the network predicts each word by its frequency. Executors then train on all
windows of their documents; what each has changed is averaged row by row,
weighted by the occurrences that it has seen.
"""

from __future__ import annotations

import heapq
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, stored

#: Words with a leaf of their own, times the square root of the number of tokens; one shared leaf for so many of them, and so many at least.
GROWTH, SHARED, BUCKETS = 8, 8, 16
SIZE, BRANCHES = 16, 32
#: Tokens of a step of training, of a step of scoring, and of what is cut into steps at once.
BATCH, SCORED, CHUNK = 8_192, 16_384, 1 << 18
#: Words with fewer occurrences in a step are summed together with those of as many.
FEW = 16
#: Bytes of text that are counted, and looked up, at once.
COUNTED, LOOKED_UP = 32_000_000, 2_000_000
RATE = 0.15
#: Windows to train on at least: a smaller corpus is gone over several times, in ``ROUNDS`` rounds.
EXAMPLES, PASSES, ROUNDS = 4_000_000, 48, 4
#: Rows of parameters that are averaged together, for words, nodes and places.
BLOCKS = (1 << 14, 1 << 8, 4)
OFFSETS = (-2, -1, 1, 2)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts, one after the other, and how many each has; null counts as empty."""
    # a copy, because ascii_lower goes wrong over slices of an array
    whole = texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(whole, "")))
    words, n = lists.flatten().cast(pa.large_binary()), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if empty.any():  # beside white space at the ends
        n = n - np.bincount(np.repeat(np.arange(len(n)), n)[empty], minlength=len(n))
        words = words.filter(pa.array(~empty))
    return words, n


def tally(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all texts."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", COUNTED):
                counts = split(part.column(0))[0].value_counts()
                if len(counts):
                    yield pa.record_batch([counts.field("values").cast(pa.binary()), counts.field("counts")], ["word", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Leaves:
    """Leaves of words: those with a leaf of their own, then the shared ones; the counts of all."""

    rank: dict[bytes, int]
    counts: np.ndarray

    def __post_init__(self):
        self._own: pa.Array | None = None

    def __getstate__(self):
        return self.__dict__ | {"_own": None}

    def ids(self, words: pa.Array | list[bytes]) -> np.ndarray:
        if self._own is None:
            self._own = pa.array(list(self.rank), pa.large_binary())
        words = pa.array(words, pa.large_binary()) if isinstance(words, list) else words
        out = pc.fill_null(pc.index_in(words, self._own), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        first = len(self.rank)
        shared, other = len(self.counts) - first, np.flatnonzero(out < 0)
        out[other] = [first + zlib.crc32(w) % shared for w in words.take(pa.array(other)).to_pylist()]
        return out


def leaves(docs: DataFrame) -> tuple[Leaves, DataFrame]:
    """Leaves of all words of all texts; and ``(h, ln)``, the logarithms of the counts of rarer words that occur more than once, by a hash of the word.

    A word has a leaf of its own from the smallest count (two at least) at which
    there are no more such words than ``GROWTH`` allows; words of equal counts
    are treated alike.
    """
    total = stored(tally(docs), "words")
    sizes = total.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).toArrow()
    n, k = (sizes.column(c).to_numpy() for c in ("n", "k"))
    fits = (np.cumsum(k) <= GROWTH * math.sqrt((n * k).sum())) & (n >= 2)
    least = int(n[fits].min()) if fits.any() else int(n.max(initial=0)) + 1
    own = total.where(F.col("n") >= least).orderBy(F.desc("n"), "word").toArrow()
    rare = total.where(F.col("n") < least)
    shared = max(BUCKETS, own.num_rows // SHARED)
    sums = rare.groupBy((F.crc32("word") % shared).cast("int").alias("b")).agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(shared, dtype=np.int64)
    counts[sums.column("b").to_numpy()] = sums.column("n").to_numpy()
    several = rare.where("n > 1").groupBy(F.xxhash64("word").alias("h")).agg(F.log(F.sum("n").cast("double")).alias("ln"))
    return Leaves({bytes(w): k for k, w in enumerate(own.column("word").to_pylist())}, np.concatenate([own.column("n").to_numpy(), counts])), several


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(node, branch, bias)``: for each leaf the inner nodes of its path from the root and the branch that it takes there (-1 beyond its end); bias (nodes, BRANCHES) by the counts."""
    n = len(counts)
    # a full tree has one leaf more than a multiple of BRANCHES - 1; what lacks weighs nothing
    spare = -(n - 1) % (BRANCHES - 1) if n > 1 else BRANCHES - 1
    heap = [(0, n + k) for k in range(spare)] + [(int(c) + 1, k) for k, c in enumerate(counts)]
    heapq.heapify(heap)
    size, made = n + spare, []
    while len(heap) > 1 or not made:
        made.append([heapq.heappop(heap) for _ in range(BRANCHES)])
        heapq.heappush(heap, (sum(w for w, _ in made[-1]), size + len(made) - 1))
    bias = np.full((len(made), BRANCHES), -60, dtype=np.float32)
    paths: dict[int, list[tuple[int, int]]] = {size + len(made) - 1: []}
    out: list[list[tuple[int, int]]] = [[]] * n
    for node in range(len(made) - 1, -1, -1):
        path, whole = paths.pop(size + node), sum(w for w, _ in made[node])
        for branch, (w, child) in enumerate(made[node]):
            if w:
                bias[node, branch] = math.log(w / whole)
            if child >= size:
                paths[child] = [*path, (node, branch)]
            elif child < n:
                out[child] = [*path, (node, branch)]
    depth = max(map(len, out), default=0)
    node, branch = np.full((n, depth), -1, dtype=np.int32), np.zeros((n, depth), dtype=np.int64)
    for k, path in enumerate(out):
        for level, (a, b) in enumerate(path):
            node[k, level], branch[k, level] = a, b
    return node, branch, bias


def _groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1], [True]]))


def _by_size(starts: np.ndarray) -> list:
    """``(runs, rows)`` of runs that begin at ``starts``: a long run alone, as a slice of rows, and short ones with all of their size, rows by run."""
    sizes = np.diff(starts)
    short = np.flatnonzero(sizes < FEW)
    short = short[np.argsort(sizes[short], kind="stable")]
    out: list = [(k, slice(starts[k], starts[k + 1])) for k in np.flatnonzero(sizes >= FEW).tolist()]
    if len(short):
        bounds = _groups(sizes[short])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            runs = short[a:b]
            out.append((runs, starts[runs, None] + np.arange(sizes[runs[0]])))
    return out


@dataclass
class Network:
    """The sum of the neighbours' embeddings, each turned by its place's matrix; choices are softmaxes of its products with the branches' vectors, and their bias."""

    node: np.ndarray
    branch: np.ndarray
    #: Where a leaf stands among all in the order of the tree.
    rank: np.ndarray
    #: (leaves + 1, SIZE); the last row stands for what is beyond the edge of a text.
    words: np.ndarray
    #: (inner nodes, BRANCHES, SIZE + 1), the bias last.
    nodes: np.ndarray
    places: np.ndarray

    def __post_init__(self):
        # of a level after the other
        self.node_at, self.branch_at = np.ascontiguousarray(self.node.T), np.ascontiguousarray(self.branch.T)

    def hidden(self, near: np.ndarray) -> np.ndarray:
        """Of all positions but two at either end, from embeddings of all; with a column of ones."""
        n = len(near) - 4
        out = np.ones((n, SIZE + 1), dtype=near.dtype)
        out[:, :-1] = sum(near[2 + k : 2 + k + n] @ turn for k, turn in zip(OFFSETS, self.places, strict=True))
        return out

    def levels(self, h: np.ndarray, leaf: np.ndarray):
        """For each level of tokens, their rows of h given, what each node's softmax needs.

        ``(at, nodes, sizes, runs, own, vectors, branch, z)``: positions of the
        tokens that have the level, those of a node together, nodes with as many
        after each other; nodes and their numbers of tokens; ``(nodes, tokens)``
        of nodes with as many, as slices; rows of h, the nodes' vectors, the
        branches taken, and products with all branches.
        """
        order = np.argsort(self.rank[leaf])
        for of_leaf, taken in zip(self.node_at, self.branch_at, strict=True):
            node = of_leaf.take(leaf.take(order))
            order = order[node >= 0]
            if not len(order):
                return
            node = node[node >= 0]
            starts = _groups(node)
            sizes = np.diff(starts)
            by_size = np.argsort(sizes, kind="stable")
            sizes, starts = sizes[by_size], starts[:-1][by_size]
            nodes, ends = node[starts], np.cumsum(sizes)
            at = order[np.repeat(starts - ends + sizes, sizes) + np.arange(len(order))]
            own, vectors = h.take(at, axis=0), self.nodes.take(nodes, axis=0)
            z = np.empty((len(at), BRANCHES), dtype=h.dtype)
            bounds, runs, last = _groups(sizes).tolist(), [], 0
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rows = slice(last, last := int(ends[b - 1]))
                runs.append((slice(a, b), rows))
                np.matmul(own[rows].reshape(b - a, -1, SIZE + 1), vectors[a:b].swapaxes(1, 2), out=z[rows].reshape(b - a, -1, BRANCHES))
            yield at, nodes, sizes, runs, own, vectors, taken[leaf[at]], z

    @staticmethod
    def weights(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exponentials, up to a factor for each row, and their sums."""
        ones = np.ones(BRANCHES, dtype=z.dtype)
        with np.errstate(over="ignore"):
            weights = np.exp(z)
        sums = weights @ ones
        # where exponentials leave the range of numbers, they are taken from the largest
        far = np.flatnonzero(~((sums > 1e-3) & (sums < 1e30)))
        if len(far):
            weights[far] = np.exp(z[far] - z[far].max(axis=1, keepdims=True))
            sums[far] = weights[far] @ ones
        return weights, sums

    def log_probabilities(self, near: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """near: (tokens, 4) leaves of the neighbours."""
        return self.scored(*_apart(near, leaf))

    def scored(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of the leaves at positions ``at``, ascending, of ``flat``, which has two more at either end."""
        out = np.zeros(len(at))
        for a in range(0, len(at), SCORED):
            here = at[a : a + SCORED]
            h = self.hidden(self.words.take(flat[here[0] - 2 : here[-1] + 3], axis=0)).take(here - here[0], axis=0)
            for rows, *_, branch, z in self.levels(h, flat[here]):
                weights, sums = self.weights(z)
                out[a + rows] += np.log(np.maximum(weights.ravel()[branch + np.arange(0, weights.size, BRANCHES)] / sums, 1e-37))
        return out


def network(counts: np.ndarray, seed: int = 42) -> Network:
    draw = np.random.default_rng(seed)
    node, branch, bias = huffman(counts)
    nodes = np.zeros((*bias.shape, SIZE + 1), dtype=np.float32)
    nodes[:, :, -1] = bias
    words = draw.normal(0, 0.3, (len(counts) + 1, SIZE)).astype(np.float32)
    turns = [np.linalg.qr(draw.normal(size=(SIZE, SIZE)))[0] for _ in OFFSETS]
    rank = np.empty(len(counts), dtype=np.int32)
    rank[np.lexsort(node.T[::-1])] = np.arange(len(counts))
    return Network(node, branch, rank, words, nodes, np.array(turns, dtype=np.float32))


def windows(ids: np.ndarray, n: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of texts of so many tokens each, one after the other, with two edges around each; and where the tokens are."""
    flat = np.full(len(ids) + 2 * len(n) + 2, edge, dtype=np.int32)
    at = np.arange(len(ids)) + np.repeat(2 * np.arange(1, len(n) + 1), n)
    flat[at] = ids
    return flat, at


def _apart(near: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``windows``, of tokens that each have their neighbours to themselves."""
    return np.column_stack([near[:, :2], leaf, near[:, 2:]]).astype(np.int32).ravel(), 5 * np.arange(len(leaf)) + 2


def _summed(keys: np.ndarray, rows: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sums of their rows and times."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = _groups(keys)
    rows, out = rows.take(order, axis=0), np.empty((len(starts) - 1, rows.shape[1]), dtype=rows.dtype)
    for k, at in _by_size(starts):
        some = rows[at]
        out[k] = np.ones(some.shape[-2], dtype=rows.dtype) @ some
    return keys[starts[:-1]], out, np.add.reduceat(times[order], starts[:-1])


class Training:
    """Steps of AdaGrad, a rate for each row, on a copy of a network; and what they have changed."""

    def __init__(self, net: Network):
        self.start, self.seen = net, 0
        self.net = Network(net.node, net.branch, net.rank, net.words.copy(), net.nodes.copy(), net.places.copy())
        self.square = [np.zeros(x.shape[:-1], dtype=np.float32) for x in (net.words, net.nodes)] + [np.zeros(len(net.places), dtype=np.float32)]
        self.times = [np.zeros(len(x), dtype=np.float32) for x in (net.words, net.nodes)]

    def _step(self, k: int, rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        """What to add to rows for gradients g, which it takes the place of."""
        flat = g.reshape(*g.shape[: self.square[k].ndim], -1)
        square = self.square[k].take(rows, axis=0) + np.einsum("...i,...i->...", flat, flat) / flat.shape[-1]
        self.square[k][rows] = square
        flat *= (RATE / np.sqrt(square + 1e-8))[..., None]
        return g

    def _of_nodes(self, h: np.ndarray, leaf: np.ndarray, back: np.ndarray):
        """``(nodes, gradients, tokens, vectors)`` of each level, of the sum of log-probabilities; adds those of h to ``back``. A node has one level."""
        for at, nodes, sizes, runs, own, vectors, branch, z in self.net.levels(h, leaf):
            error, sums = self.net.weights(z)
            error *= (-1 / sums)[:, None]
            error.ravel()[branch + np.arange(0, error.size, BRANCHES)] += 1
            g, down = np.empty_like(vectors), np.empty((len(at) + 1, SIZE), dtype=h.dtype)
            for k, rows in runs:
                e = error[rows].reshape(k.stop - k.start, -1, BRANCHES)
                np.matmul(e.swapaxes(1, 2), own[rows].reshape(len(e), -1, SIZE + 1), out=g[k])
                down[rows] = (e @ vectors[k, :, :-1]).reshape(-1, SIZE)
            # tokens without the level read the last row; rows are taken faster than added in place
            down[-1], where = 0, np.full(len(h), len(at))
            where[at] = np.arange(len(at))
            back += down.take(where, axis=0)
            yield nodes, g, sizes, vectors

    def _of_words(self, flat: np.ndarray, at: np.ndarray, near: np.ndarray, back: np.ndarray):
        """``(rows, gradients, occurrences)`` of words and gradients of places, from those of h at each position."""
        n = len(near) - 4
        every, used = np.zeros((n, SIZE), dtype=near.dtype), np.zeros(n, dtype=near.dtype)
        every[at], used[at] = back, 1
        of_near, times, of_places = np.zeros_like(near), np.zeros(len(near), dtype=near.dtype), np.empty_like(self.net.places)
        for p, k in enumerate(OFFSETS):
            beside = slice(2 + k, 2 + k + n)
            of_near[beside] += every @ self.net.places[p].T
            times[beside] += used
            of_places[p] = near[beside].T @ every
        return _summed(flat, of_near, times), of_places

    def gradients(self, near: np.ndarray, leaf: np.ndarray):
        """Of the sum of log-probabilities: ``(rows, gradients, occurrences)`` of words and of nodes, gradients of places."""
        flat, at = _apart(near, leaf)
        vectors, back = self.net.words.take(flat, axis=0), np.zeros((len(at), SIZE), dtype=self.net.words.dtype)
        of_nodes = [x[:3] for x in self._of_nodes(self.net.hidden(vectors)[at - 2], leaf, back)]
        of_words, of_places = self._of_words(flat, at - 2, vectors, back)
        return of_words, tuple(np.concatenate(x) for x in zip(*of_nodes, strict=True)), of_places

    def step(self, flat: np.ndarray, at: np.ndarray) -> None:
        """On tokens at positions ``at``, ascending, of ``flat``, which has two more at either end."""
        net, flat, at = self.net, flat[at[0] - 2 : at[-1] + 3], at - at[0]
        near, back = net.words.take(flat, axis=0), np.zeros((len(at), SIZE), dtype=net.words.dtype)
        for nodes, g, sizes, vectors in self._of_nodes(net.hidden(near).take(at, axis=0), flat.take(at + 2), back):
            vectors += self._step(1, nodes, g)
            net.nodes[nodes] = vectors
            self.times[1][nodes] += sizes
        (words, g, times), of_places = self._of_words(flat, at, near, back)
        net.words[words] = net.words.take(words, axis=0) + self._step(0, words, g)
        # matrices that all tokens share go a tenth of the way
        net.places += self._step(2, np.arange(len(OFFSETS)), of_places * 0.1)
        self.times[0][words] += times
        self.seen += len(at)

    def learn(self, ids: np.ndarray, n: np.ndarray, passes: int) -> None:
        """On texts of so many tokens each, one after the other."""
        flat, at = windows(ids, n, len(self.net.words) - 1)
        for _ in range(passes):
            # a short input still makes some steps
            size = min(BATCH, max(64, len(at) // 8))
            for a in range(0, len(at), size):
                self.step(flat, at[a : a + size])

    def changes(self):
        """``(kind, block, rows, times, delta)``: kind 0 words, 1 nodes, 2 places."""
        pairs = ((self.net.words, self.start.words), (self.net.nodes, self.start.nodes), (self.net.places, self.start.places))
        for kind, (now, before) in enumerate(pairs):
            times = self.times[kind] if kind < 2 else np.full(len(OFFSETS), self.seen, dtype=np.float32)
            for block in range(0, len(now), BLOCKS[kind]):
                rows = np.flatnonzero(times[block : block + BLOCKS[kind]])
                if len(rows):
                    at = rows + block
                    yield kind, block // BLOCKS[kind], rows.astype("<i4"), times[at].astype("<f4"), (now[at] - before[at]).astype("<f2")


_CHANGES = "kind int, block int, rows binary, times binary, delta binary"


def _sent(kind: int, block: int, rows: np.ndarray, times: np.ndarray, delta: np.ndarray) -> pa.RecordBatch:
    values = [[kind], [block], [rows.tobytes()], [times.tobytes()], [delta.tobytes()]]
    return pa.record_batch([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)], ["kind", "block", "rows", "times", "delta"])


def _averaged(batches):
    """Changes of one row to their mean, weighted by the row's occurrences."""
    sums: dict = {}
    for batch in batches:
        for r in batch.to_pylist():
            rows, times = np.frombuffer(r["rows"], "<i4"), np.frombuffer(r["times"], "<f4")
            delta = np.frombuffer(r["delta"], "<f2").reshape(len(rows), -1)
            key = (r["kind"], r["block"])
            if key not in sums:
                sums[key] = np.zeros((BLOCKS[r["kind"]], delta.shape[1] + 1), dtype=np.float32)
            sums[key][rows, :-1] += delta * times[:, None]
            sums[key][rows, -1] += times
    for (kind, block), s in sums.items():
        rows = np.flatnonzero(s[:, -1])
        yield _sent(kind, block, rows.astype("<i4"), s[rows, -1].astype("<f4"), (s[rows, :-1] / s[rows, -1:]).astype("<f2"))


def trained(docs: DataFrame, words: Leaves) -> Network:
    """The network of the corpus; every window of every text is trained on, once at least.

    Two tasks a core train, on all partitions between them, so that the changes
    that they send don't grow with the partitions.
    """
    net, tokens = network(words.counts), int(words.counts.sum())
    if not tokens:
        return net
    passes = min(PASSES, max(1, -(-EXAMPLES // tokens)))
    rounds = min(ROUNDS, passes)
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism

    def run(batches):
        train, held, size = Training(net), [], 0

        def learn():
            train.learn(*(np.concatenate(x) for x in zip(*held, strict=True)), -(-passes // rounds))

        for batch in batches:
            for part in slices(batch, "text", LOOKED_UP):
                own, n = split(part.column(0))
                held.append((words.ids(own), n[n > 0]))
                size += len(own)
                if size > CHUNK:
                    learn()
                    held, size = [], 0
        if size:
            learn()
        if train.seen:
            for change in train.changes():
                yield _sent(*change)

    for _ in range(rounds):
        made = docs.select(F.col("text").cast("string").alias("text")).coalesce(tasks).mapInArrow(run, _CHANGES).repartition("kind", "block").mapInArrow(_averaged, _CHANGES).toArrow()
        new = Network(net.node, net.branch, net.rank, net.words.copy(), net.nodes.copy(), net.places.copy())
        for r in made.to_pylist():
            rows, to = np.frombuffer(r["rows"], "<i4") + r["block"] * BLOCKS[r["kind"]], (new.words, new.nodes, new.places)[r["kind"]]
            to[rows] += np.frombuffer(r["delta"], "<f2").reshape(len(rows), *to.shape[1:])
        net = new
    return net


def scores(docs: DataFrame, words: Leaves, several: DataFrame, net: Network) -> DataFrame:
    """``(doc_id, n_tokens, log_prob, mean_log_prob)`` of each row of ``docs(doc_id, text, ...)``.

    A word that shares a leaf has the leaf's probability times its part of the
    leaf's count. Null or empty texts have no tokens, a sum of 0 and no mean.
    Rows that repeat each have a result. Texts of any length are scored whole,
    other columns are ignored. An empty table gives an empty result.
    """
    of_leaf = np.log(np.maximum(words.counts, 1))

    def run(batches):
        first, seen = len(words.rank), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", LOOKED_UP):
                own, n = split(part.column(1))
                ids, of_text = words.ids(own), np.repeat(np.arange(len(n)), n)
                logp, other = net.scored(*windows(ids, n, len(net.words) - 1)), np.flatnonzero(ids >= first)
                logp[other] -= of_leaf[ids[other]]
                total = np.bincount(of_text, weights=logp, minlength=len(n))
                hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in own.take(pa.array(other)).to_pylist()], dtype=np.uint64).view(np.int64)
                ends = np.cumsum(np.bincount(of_text[other], minlength=len(n)))
                rare = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(hashes))
                rows = pa.array(np.arange(seen, seen + len(n)))
                seen += len(n)
                yield pa.record_batch([rows, part.column(0), pa.array(n, pa.int64()), pa.array(total, pa.float64()), rare], ["row", "doc_id", "n_tokens", "own", "rare"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(texts.mapInArrow(run, "row long, doc_id long, n_tokens long, own double, rare array<long>"), "scored")
    parts = made.select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count("*").alias("k"))
    shares = parts.join(several, "h").groupBy("row").agg(F.sum(F.col("k") * F.col("ln")).alias("shares"))
    log_prob = F.col("own") + F.coalesce("shares", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return made.drop("rare").join(shares, "row", "left").select("doc_id", "n_tokens", log_prob.alias("log_prob")).withColumn("mean_log_prob", mean)


def scored(docs: DataFrame) -> DataFrame:
    """``scores`` by the vocabulary and all windows of ``docs`` itself."""
    words, several = leaves(docs)
    return scores(docs, words, several, trained(docs, words))
