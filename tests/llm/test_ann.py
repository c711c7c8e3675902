import numpy as np
import pytest

from mergeweave.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, id long, d string"


def brute(vectors, queries, top=10):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], dtype=np.float64)
    out = {}
    for q, v in vectors:
        if q in queries:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
            order = sorted((round(a, 9), i) for a, i in zip(d, ids) if i != q)[:top]
            out[q] = order
    return out


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in vectors], SCHEMA)


def found(spark, vectors, **how):
    out = {}
    for r in ann.neighbours(table(spark, vectors), **how).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((round(r["score"], 9), r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = found(spark, vectors)
    want = brute(vectors, {i for i, _ in vectors if i % 100 == 0})
    assert got.keys() == want.keys()
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    true = {q: dict((i, s) for s, i in brute([(i, v) for i, v in vectors], {q}, len(vectors))[q]) for q in list(want)[:5]}
    assert all(true[q][i] == s for q in true for s, i in got[q])


def test_copies_ties_and_unusable(spark):
    v = [1.0, 0.0]
    vectors = [(k, v) for k in range(0, 300)] + [(300, [0.0, 1.0]), (400, None), (500, [0.0, 0.0]), (600, [float("nan"), 1.0]), (700, [1.0, None]), (800, [5.0, 6.0, 7.0]), (900, [float("inf"), 0.0]), (None, v), (200, v)]
    got = found(spark, vectors)
    # a shorter vector ends in zeros
    assert got.keys() == {0, 100, 200, 300, 800} and got[800][0] == (round((25 + 25 + 49) ** 0.5, 9), 300)
    assert got[0] == [(0.0, k) for k in range(1, 11)] and got[100] == [(0.0, k) for k in range(10)]
    assert got[300] == [(round(2**0.5, 9), k) for k in range(10)]


def test_doubles_as_they_are(spark):
    """Vectors that floats hardly tell apart."""
    vectors = [(k, [1.0 + k * 1e-7, 2.0]) for k in range(110)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in ann.neighbours(rows).where("query_id = 100").orderBy("rank").collect()]
    want = sorted(((abs(vectors[100][1][0] - v[0]), i) for i, v in vectors if i != 100))[:10]
    assert [i for i, _ in got] == [i for _, i in want] and all(abs(s - d) < 1e-15 for (_, s), (d, _) in zip(got, want))


def test_recall_without_clusters(spark):
    """Independent directions, more of them than a pool can see."""
    x = np.random.default_rng(7).normal(size=(12_000, 48))
    vectors = [(k, v) for k, v in enumerate(x.tolist())]
    got = found(spark, vectors)
    want = brute(vectors, {k for k in range(0, 12_000, 100)})
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9


def test_few_and_none(spark):
    got = found(spark, [(0, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0])])
    assert got == {0: [(1.0, 1), (2.0, 2)]}
    assert found(spark, [(0, [1.0, 1.0])]) == {}
    assert ann.neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trees_split_evenly():
    x = np.random.default_rng(0).normal(size=(1000, 8)).astype(np.float32)
    leaves = ann.Trees(x, 3).leaves(x)
    for t in range(leaves.shape[1]):
        assert np.bincount(leaves[:, t]).max() < 250
