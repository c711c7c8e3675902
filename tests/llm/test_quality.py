import math
import zlib

import numpy as np

from mergeweave.llm import quality

from .helpers import ODD, ODD_IDS, SCHEMA, docs


def test_trees_learn_and_flat_arrays_agree_with_a_walk():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    trees = quality.fit(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    for row, score in zip(x[:20], trees.raw(x[:20])):
        total = trees.base
        for t in range(len(trees.feature)):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.value[t, node - trees.feature.shape[1]]
        assert abs(total - score) < 1e-9


def test_one_class_and_no_rows():
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (quality.fit(np.ones((8, 3)), np.ones(8)).score(np.ones((2, 3))) > 0.8).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.scored(table, quality.learn(table, labels)).join(labels, "doc_id").where("held_out").select("quality", "predicted").toPandas()
    assert len(got) > 1000
    for label in (0, 1):
        own = got[got.quality == label]
        assert (own.predicted == label).mean() > 0.97, label


def test_held_out_labels_are_never_read(spark):
    table = docs(spark, ["good words here " * 9, "x | y | z"] * 30)
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1]
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    wrong = spark.createDataFrame([(k, 1 - k % 2 if k in ids else k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    a, b = (sorted(map(tuple, quality.scored(table, quality.learn(table, x)).collect())) for x in (labels, wrong))
    assert a == b
    assert {r[0] for r in a if r[1]} == {k for k in range(60) if k not in ids}


def test_odd_rows_and_empty(spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (7, None), (None, 1), (99, 0), (6, 1)], "doc_id long, quality int")
    table = docs(spark, ODD, ODD_IDS)
    trees = quality.learn(table, labels)
    got = quality.scored(table, trees).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    kept = quality.accepted(table, trees)
    assert kept.columns == SCHEMA.fieldNames() and kept.count() == sum(r["predicted"] for r in got)
    none = spark.createDataFrame([], SCHEMA)
    assert quality.scored(none, quality.learn(none, labels)).count() == 0


def brute_statistics(text):
    """By definition, character class by character class."""
    raw = text.encode()
    if not raw:
        return [0.0] * quality.STATISTICS
    classes = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " ", "\n", "\t\r\x0b\x0c", None, "aeiouAEIOU", *quality._MARKS]
    out = [sum(b > 127 if c is None else chr(b) in c for b in raw) / len(raw) for c in classes]
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    low, sizes = [w.lower() for w in words], [len(w) for w in words] or [0]
    w, m, mean = max(1, len(words)), max(1, len(lines)), sum(sizes) / len(sizes)
    share = [raw.count(bytes([b])) / len(raw) for b in set(raw)]
    return out + [
        math.log1p(len(raw)), math.log1p(len(words)), mean, math.sqrt(sum((s - mean) ** 2 for s in sizes) / len(sizes)), max(sizes), -sum(s * math.log2(s) for s in share),
        len(set(low)) / w, max([low.count(x) for x in set(low)], default=0) / w, sum(a == b for a, b in zip(low, low[1:])) / w,
        sum(x.isupper() for x in words) / w, sum(x.istitle() for x in words) / w, sum(x.isalpha() for x in words) / w,
        math.log1p(len(lines)), len(set(lines)) / m, math.log1p(w / m), sum(x.endswith((b".", b"!", b"?")) for x in lines) / m,
    ]


def test_statistics_as_by_definition():
    for text in [t or "" for t in ODD[:7]] + ["A b\nA b\n\n  \nÉté ÉTÉ. 12|34 the the THE!\t~x"]:
        assert np.allclose(quality.statistics_of(text), brute_statistics(text))


def test_first_split_and_leaves_as_by_definition():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 9, size=(200, 3)).astype(float)
    y = (x[:, 1] + draw.normal(size=200) > 4).astype(float)
    got = quality.fit(x, y, trees=1, depth=1, bins=64, rate=1.0)
    p = 1 / (1 + math.exp(-got.base))
    g, h = p - y, np.full(200, p * (1 - p))
    best = max(
        ((sum(g[s]) ** 2 / (sum(h[s]) + 1) + sum(g[~s]) ** 2 / (sum(h[~s]) + 1) - sum(g) ** 2 / (sum(h) + 1)), -f, -at)
        for f in range(3)
        for at in np.unique(x[:, f])[:-1]
        for s in [x[:, f] <= at]
        if sum(h[s]) >= 2 and sum(h[~s]) >= 2
    )
    assert got.feature[0, 0] == -best[1] and ((x[:, got.feature[0, 0]] > got.threshold[0, 0]) == (x[:, -best[1]] > -best[2])).all()
    for leaf, side in enumerate((x[:, -best[1]] <= -best[2], x[:, -best[1]] > -best[2])):
        assert abs(got.value[0, leaf] + sum(g[side]) / (sum(h[side]) + 1)) < 1e-9


def test_of_repeated_ids_the_smallest_text_is_learnt(spark):
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    ids = [k for k in range(60) for _ in range(2)]
    texts = [t for k in range(60) for t in (f"b other {k} | | |", f"a {'clean words here ' * (k % 2)}")]
    one = quality.learn(docs(spark, texts, ids, parts=2), labels)
    two = quality.learn(docs(spark, texts[::-1], ids[::-1], parts=5), labels)
    alone = quality.learn(docs(spark, texts[1::2], ids[1::2]), labels)
    for other in (two, alone):
        assert (one.feature == other.feature).all() and (one.value == other.value).all()
