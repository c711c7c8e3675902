import random

import numpy as np

from mergeweave.llm import decontaminate as d

from .helpers import ODD, ODD_IDS, SCHEMA, docs, prose


def brute_tiles(item, doc, least):
    """Greedy string tiling by its definition: the longest common run of free words, again and again."""
    p, t, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and p[i + n] and t[j + n] and item[i + n] == doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        for k in range(n):
            p[i + k] = t[j + k] = False
        out.append((i, j, n))


def test_tiles_as_by_definition():
    r = random.Random(3)
    for _ in range(150):
        item = np.array([r.randrange(4) for _ in range(r.randrange(1, 25))], dtype=np.uint64)
        doc = np.array([r.randrange(4) for _ in range(r.randrange(1, 40))], dtype=np.uint64)
        assert d.tile(item, doc, 3) == brute_tiles(item.tolist(), doc.tolist(), 3)


def test_window_hashes_as_by_definition():
    ids = np.random.default_rng(2).integers(0, 2**63, 50, dtype=np.uint64)
    for width in (1, 2, 7, 50, 51):
        want = [sum(int(x) * int(d._BASE) ** (width - 1 - k) for k, x in enumerate(ids[at : at + width])) % 2**64 for at in range(50 - width + 1)]
        assert d.Windows(ids).hashes(width).tolist() == want


def test_many_equal_windows_are_no_pairs():
    item, doc = np.ones(3_000, dtype=np.uint64), np.ones(40_000, dtype=np.uint64)
    doc[::100] = 2
    assert sum(n for _, _, n in d.tile(item, doc)) >= 2_900


def test_planted_reordered_and_clean(spark):
    item = prose(40, 5)
    words = item.split()
    swapped = " ".join(words[20:] + ["between"] + words[:20])
    texts = [prose(200, 8), prose(100, 9) + " " + item.upper() + " " + prose(90, 10), "x " + swapped, " ".join(words[:12]), None, ""]
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (10, "two words")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in d.matches(docs(spark, texts), items).collect()}
    assert got == {(1, 7): 1.0, (2, 7): 1.0}
    left = d.decontaminated(docs(spark, texts), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 3, 4, 5] and left.columns == SCHEMA.fieldNames()


def test_real_passages(spark, data):
    table, items = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in d.matches(table, items).collect()}
    inside = {(a["doc_id"], b["item_id"]) for a in table.collect() for b in items.collect() if b["text"] in a["text"]}
    assert inside and inside <= got
    # by definition, wherever any five words are common
    want = set()
    for b in items.collect():
        item = d.words_of(b["text"])
        seeds = {tuple(item[k : k + 5]) for k in range(len(item) - 4)}
        for a in table.collect():
            doc = d.words_of(a["text"] or "")
            if any(tuple(doc[k : k + 5]) in seeds for k in range(len(doc) - 4)) and sum(n for _, _, n in brute_tiles(item, doc, 5)) >= 0.5 * len(item):
                want.add((a["doc_id"], b["item_id"]))
    assert got == want


def test_blocks_of_items_make_no_difference(spark, monkeypatch):
    texts = [prose(60, k) for k in range(8)]
    items = spark.createDataFrame([(k, prose(60, k)) for k in range(8)], "item_id long, text string")
    one = sorted(map(tuple, d.matches(docs(spark, texts), items).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 700)
    assert sorted(map(tuple, d.matches(docs(spark, texts), items).collect())) == one and len(one) >= 8


def test_odd_rows_and_empty(spark):
    items = spark.createDataFrame([(1, prose(30))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in d.matches(docs(spark, ODD, ODD_IDS), items).collect())[:2] == [6, 7]
    assert d.matches(spark.createDataFrame([], SCHEMA), items).count() == 0
    assert d.matches(docs(spark, ODD), items.limit(0)).count() == 0
    assert d.decontaminated(docs(spark, ODD), items.limit(0)).count() == len(ODD)
