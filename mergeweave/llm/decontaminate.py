"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (``least`` words in a row) are
compared: the longest match of words is marked, then the longest among what is
left, and so on down to ``least`` words. Matches of every length are found by
Karp-Rabin hashes of word ids. The marked share of the item's words is
its coverage, so that passages in another order count as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, stored, texts_of

LEAST = 5
COVERAGE = 0.5
#: Characters of benchmark text that tasks hold at once; a larger benchmark takes several passes over the documents.
BLOCK_CHARS = 32_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs without ASCII white space, less punctuation at both ends."""
    return [w for w in (x.strip(b".,;:!?\"'()[]{}*#$%&|") for x in text.encode().lower().split()) if w]


class Windows:
    """Karp-Rabin hashes of the windows of a sequence of ids, modulo 2 ** 64, of any width in one step for each window.

    With powers of an odd base, which has an inverse, sums from the start differ
    by a window's hash times a power: what rolling does step by step.
    """

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        with np.errstate(over="ignore"):
            self.power = _powers(_BASE, len(ids) + 1)
            self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ids * _powers(_INVERSE, len(ids)), dtype=np.uint64)])

    def hashes(self, width: int) -> np.ndarray:
        n = len(self.ids) - width + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return (self.sums[width:] - self.sums[:-width]) * self.power[width - 1 : width - 1 + n]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def tile(item: np.ndarray, doc: np.ndarray, least: int = LEAST, of_doc: Windows | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(start in item, start in doc, length)``, longest first, none overlapping another on either side.

    Equal lengths go by the smaller start in the item, then in the document.
    """
    pattern, text = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool)
    of_item, of_doc = Windows(item), of_doc or Windows(doc)
    tiles: list[tuple[int, int, int]] = []
    length = min(len(item), len(doc))
    while length >= least:
        # the longest match not longer than the last: lengths at which windows of free words agree, by bisection
        low, high = least, length
        while low <= high:
            mid = (low + high) // 2
            if len(_common(of_item, of_doc, pattern, text, mid)[0]):
                low = mid + 1
            else:
                high = mid - 1
        if high < least:
            break
        length = high
        before = len(tiles)
        _mark(item, doc, pattern, text, length, *_common(of_item, of_doc, pattern, text, length), tiles)
        if len(tiles) == before:  # hashes agreed, words didn't
            length -= 1
    return tiles


def _free(mask: np.ndarray, width: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return np.nonzero(total[width:] - total[:-width] == width)[0]


def _common(of_item: Windows, of_doc: Windows, pattern, text, width):
    """Starts of free windows in the item whose hash a free window of the document has; and those of the document by hash and start, with their hashes."""
    i, j = _free(pattern, width), _free(text, width)
    hi, hj = of_item.hashes(width)[i], of_doc.hashes(width)[j]
    near = np.isin(hj, hi)
    j, hj = j[near], hj[near]
    order = np.argsort(hj, kind="stable")
    hit = np.isin(hi, hj)
    return i[hit], hi[hit], j[order], hj[order]


def _mark(item, doc, pattern, text, width, i, hi, j, hj, tiles) -> None:
    """Mark matches by start in the item, each at its first free place in the document. Places that aren't free any more are passed once."""
    first = dict(zip(hj[::-1].tolist(), range(len(hj) - 1, -1, -1), strict=True))
    for a, h in zip(i.tolist(), hi.tolist(), strict=True):
        if not pattern[a : a + width].all():
            continue
        at = first[h]
        while at < len(j) and hj[at] == h and not text[j[at] : j[at] + width].all():
            at += 1
        first[h] = at
        while at < len(j) and hj[at] == h:
            b = int(j[at])
            if text[b : b + width].all() and np.array_equal(item[a : a + width], doc[b : b + width]):
                pattern[a : a + width] = False
                text[b : b + width] = False
                tiles.append((a, b, width))
                break
            at += 1


class Index:
    """Word ids and seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least = least
        self.ids: dict[bytes, int] = {}
        self.items, seeds, owner = [], [], []
        for key, text in items:
            words = words_of(text)
            ids = np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in words], dtype=np.uint64)
            # an item with fewer words than a seed is looked for as a whole
            width = min(least, len(ids))
            if width:
                for h in Windows(ids).hashes(width):
                    seeds.append((width, int(h)))
                    owner.append(len(self.items))
                self.items.append((key, ids))
        self.seeds = {}
        for width in {w for w, _ in seeds}:
            mine = [(h, o) for (w, h), o in zip(seeds, owner, strict=True) if w == width]
            mine.sort()
            self.seeds[width] = (np.array([h for h, _ in mine], dtype=np.uint64), np.array([o for _, o in mine]))

    def coverages(self, text: str) -> list[tuple[int, float, int]]:
        """``(item, coverage, tiles)`` of every item that shares a seed with the text."""
        get = self.ids.get
        doc = np.array([get(w, 0) for w in words_of(text)], dtype=np.uint64)
        found: set[int] = set()
        known, windows = doc > 0, Windows(doc)
        if known.any():
            for width, (hashes, owner) in self.seeds.items():
                if len(doc) < width:
                    continue
                h = np.unique(windows.hashes(width)[_free(known, width)])
                left, right = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
                for a, b in zip(left[right > left], right[right > left], strict=True):
                    found.update(owner[a:b].tolist())
        out = []
        for k in sorted(found):
            key, ids = self.items[k]
            least = min(self.least, len(ids))
            tiles = tile(ids, doc, least, windows)
            if tiles:
                out.append((key, sum(t[2] for t in tiles) / len(ids), len(tiles)))
        return out


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """``(doc_id, item_id, coverage, n_tiles)`` of each row of ``docs`` and each item covered by ``coverage`` or more.

    Null or empty texts on either side match nothing; repeated rows match as
    often as they occur; repeated items count once for an item_id and text.
    Texts of any length are compared whole, other columns are ignored. The
    benchmark goes to the tasks in blocks of at most ``BLOCK_CHARS`` characters
    (one item at least), one pass over the documents for each. Where there are
    several blocks, the result of one is stored before the next is read, so
    that neither driver nor tasks hold more than one. Documents are never
    shuffled. An empty table on either side gives an empty result.
    """
    schema = "doc_id long, item_id long, coverage double, n_tiles int"
    names = ["doc_id", "item_id", "coverage", "n_tiles"]
    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None

    def pass_of(block):
        def run(batches):
            index = Index(block, least)
            for batch in batches:
                for part in slices(batch, "text"):
                    found = [(d, *m) for d, t in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True) for m in index.coverages(t) if m[1] >= coverage]
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in found], schema=_MATCHES)

        return rows.mapInArrow(run, schema)

    for block, is_last in _blocks(benchmark):
        one = pass_of(block)
        one = one if is_last and out is None else stored(one, "matches")
        out = one if out is None else out.union(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


_MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32())])


def _blocks(benchmark: DataFrame):
    """Lists of ``(item_id, text)``, each of a bounded number of characters, read one after the other, and whether it is the last."""
    rows = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    block, held = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if block and held + len(row["text"]) > BLOCK_CHARS:
            yield block, False
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += len(row["text"])
    if block:
        yield block, True


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark item is covered in; the blocks of the benchmark filter one after the other, what is left being stored in between.

    Null and empty texts, and rows without doc_id, stay unless a text matches.
    Rows that repeat stay or go alike. Texts are compared whole, however long.
    Column names are free. An empty table gives an empty one, an empty benchmark leaves all rows.
    """

    def pass_of(block, left):
        def run(batches):
            index = Index(block, least)
            for batch in batches:
                at = batch.schema.get_field_index("text")
                keep = [all(m[1] < coverage for m in index.coverages(t)) for part in slices(batch, "text") for t in texts_of(part.column(at))]
                if keep:
                    yield batch.filter(pa.array(keep))

        return left.mapInArrow(run, left.schema)

    for block, is_last in _blocks(benchmark):
        docs = pass_of(block, docs) if is_last else stored(pass_of(block, docs), "left")
    return docs
