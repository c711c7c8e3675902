"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, texts_of

#: At most so many labelled rows are learnt from, those with the smallest hash of doc_id.
SAMPLE = 20_000
_MARKS = ".,;:!?|#$%&*@+-_=/\\<>()[]{}'\"~^`"
_SETS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", bytes(range(128, 256)), b"aeiouAEIOU"]
_CLASS = np.zeros((256, len(_SETS) + len(_MARKS)))
for _k, _s in enumerate(_SETS + [m.encode() for m in _MARKS]):
    _CLASS[list(_s), _k] = 1
STATISTICS = _CLASS.shape[1] + 16


def statistics_of(text: str) -> np.ndarray:
    """What the trees see of a text: shares of bytes, words and lines; zeros for an empty text."""
    out = np.zeros(STATISTICS)
    raw = text.encode()
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, k = len(raw), _CLASS.shape[1]
    out[:k] = counts @ _CLASS / n
    share = counts[counts > 0] / n
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    w, m = max(1, len(words)), max(1, len(lines))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1)
    low = [x.lower() for x in words]
    tally: dict[bytes, int] = {}
    for x in low:
        tally[x] = tally.get(x, 0) + 1
    out[k:] = (
        np.log1p(n), np.log1p(len(words)), sizes.mean(), sizes.std(), sizes.max(), -(share * np.log2(share)).sum(),
        len(tally) / w, max(tally.values(), default=0) / w, sum(map(bytes.__eq__, low[1:], low)) / w,
        sum(map(bytes.isupper, words)) / w, sum(map(bytes.istitle, words)) / w, sum(map(bytes.isalpha, words)) / w,
        np.log1p(len(lines)), len(set(lines)) / m, np.log1p(w / m), sum(x[-1:] in b".!?" for x in lines) / m,
    )
    return out


@dataclass
class Trees:
    """Complete binary trees in heap order: node k has the children 2k+1 and 2k+2; x goes right where x[feature] > threshold."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    value: np.ndarray  # (trees, leaves)
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees or not len(x):
            return np.full(len(x), self.base)
        node, rows, tree = np.zeros((len(x), trees), dtype=np.int64), np.arange(len(x))[:, None], np.arange(trees)
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.value[tree, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosting of the logistic loss with quantile histograms. Without rows or with one class only, the trees are none and the score is the smoothed share."""
    rate_of_one = (y.sum() + 1) / (len(y) + 2)
    base, inner = float(np.log(rate_of_one / (1 - rate_of_one))), 2**depth - 1
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(d)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(d)], axis=1)  # bin b: edges[b-1] < x <= edges[b]
    feature, threshold, value = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h, node = p - y, p * (1 - p), np.zeros(n, dtype=np.int64)
        for level in range(depth):
            here, width = 2**level - 1, 2**level
            local = node - here
            best, where = np.full(width, 1e-6), np.full((width, 2), -1)
            for f in range(d):
                cell = local * bins + binned[:, f]
                gs, hs = (np.bincount(cell, weights=v, minlength=width * bins).reshape(width, bins).cumsum(axis=1) for v in (g, h))
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = -1
                gain[:, len(edges[f]) :] = -1
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], where[better, 0], where[better, 1] = top[better], f, at[better]
            for k in np.nonzero(where[:, 0] >= 0)[0]:
                feature[t, here + k], threshold[t, here + k] = where[k, 0], edges[where[k, 0]][where[k, 1]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        value[t] = -rate * np.bincount(leaf, weights=g, minlength=inner + 1) / (np.bincount(leaf, weights=h, minlength=inner + 1) + l2)
        margin += value[t, leaf]
    return Trees(feature, threshold, value, base)


def _mapped(docs: DataFrame, function, schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = np.stack([statistics_of(t) for t in texts_of(part.column(1))])
                yield from function(part, x)

    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> Trees:
    """Trees for ``labels.<label>``, learnt on at most ``sample`` labelled rows: a fixed bound, whatever the input.

    Rows with crc32(doc_id as text) mod 3 = 1 are held out and never read here.
    Labels that are null or refer to no document are left out. Of a doc_id with
    several labels the smallest counts, of one with several texts the smallest
    text, so that the trees don't depend on the layout. Null texts count as
    empty, long ones whole. Other columns are ignored, whatever their names.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")

    def emit(part, x):
        yield pa.record_batch([part.column(0), part.column(2), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    got = _mapped(rows, emit, "doc_id long, y int, x array<double>").orderBy("doc_id").toArrow()
    x = np.array(got.column("x").to_pylist()).reshape(-1, STATISTICS)
    return fit(x, got.column("y").to_numpy().astype(float))


def scored(docs: DataFrame, trees: Trees) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``.

    A null text counts as empty, a null doc_id is not held out. Repeated rows
    each have a result, equal texts the same score. An empty table gives an
    empty result.
    """

    def emit(part, x):
        score = trees.score(x)
        yield pa.record_batch([part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return _mapped(docs.select("doc_id", "text"), emit, "doc_id long, score double, predicted int").select("doc_id", held_out.alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores 0.5 or more.

    A null text is scored as an empty one. Texts are scored whole, however long.
    Rows that repeat stay or go alike, rows without doc_id are rows like others.
    Column names are free; an empty table gives an empty one.
    """
    schema = docs.schema

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            keep = [trees.score(np.stack([statistics_of(t) for t in texts_of(part.column(at))])) >= 0.5 for part in slices(batch, "text")]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, schema)
