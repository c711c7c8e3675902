import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mergeweave.llm import mixing

from .helpers import SCHEMA, docs


def u(key, seed=42):
    return int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52


def name(i, text, place=1):
    return f"{'' if i is None else i}:{hashlib.md5((text or '').encode()).hexdigest()}" + (f":{place}" if place > 1 else "")


def brute(key, rate):
    """The inverse of the Poisson distribution; of large means, the sum of several."""
    if rate <= 0:
        return 0
    if rate > mixing.LARGEST:
        n = math.ceil(rate / mixing.LARGEST)
        return sum(brute(key if j == 1 else f"{key}:{j}", rate / n) for j in range(1, n + 1))
    x, k, total = u(key), 0, 0.0
    while True:
        total += math.exp((k * math.log(rate) if k else 0.0) - rate - math.lgamma(k + 1))
        if x < total:
            return k
        k += 1


def test_counts_are_the_inverse(spark):
    sources = ["a"] * 300 + ["b"] * 60 + ["c"] * 6 + [None] * 4
    table = docs(spark, [f"t{k}" for k in range(370)], sources=sources)
    rates = {r["source"]: r["rate"] for r in mixing.rates(table).collect()}
    total = sum(math.sqrt(n) for n in (300, 60, 6, 4))
    assert abs(rates["a"] - math.sqrt(300) / total * 370 / 300) < 1e-12 and abs(rates[None] - 2 / total * 370 / 4) < 1e-12
    got = Counter(r["doc_id"] for r in mixing.mixed(table).collect())
    assert got == Counter({k: n for k, s in enumerate(sources) if (n := brute(name(k, f"t{k}"), rates[s]))})


def test_weights_large_rates_and_size(spark):
    sources = ["a"] * 5 + ["b"] * 500
    table = docs(spark, ["t"] * 505, sources=sources)
    got = mixing.mixed(table, weights={"a": 3.0, "b": 1.0, "zz": 5.0}, size=20_000).collect()
    counts = Counter(r["source"] for r in got)
    # "a" has 3/4 of what the sources here weigh: 3,000 times each
    assert abs(counts["a"] / 15_000 - 1) < 0.05 and abs(counts["b"] / 5_000 - 1) < 0.05
    each = Counter(r["doc_id"] for r in got)
    assert all(each[k] == brute(name(k, "t"), 3000.0) for k in range(5))
    only = mixing.mixed(table, weights={"a": 1.0})
    assert {r["source"] for r in only.collect()} == {"a"}
    assert mixing.mixed(table, weights={}).count() == 0


def test_same_on_any_layout_and_shuffled(spark):
    table = docs(spark, [f"t{k}" for k in range(400)], sources=["a", "b"] * 200)
    one = sorted((r["doc_id"], r["copy"], r["shuffle_key"]) for r in mixing.mixed(table.repartition(7)).collect())
    assert sorted((r["doc_id"], r["copy"], r["shuffle_key"]) for r in mixing.mixed(table.coalesce(1)).collect()) == one
    order = [r["doc_id"] for r in mixing.mixed(table).collect()]
    assert order != sorted(order)
    assert len({r[2] for r in one}) == len(one)


def test_names_of_its_own(spark):
    names = ["__copies", "__u", "__cdf", "copies", "doc", "cdf", "of", "from", "drawn", "copy", "a.b"]
    table = docs(spark, ["t"] * 30).select("doc_id", "text", "source", *[F.lit("x").alias(n) for n in names])
    for bound in (0, mixing.BROADCAST_NUMBERS):
        mixing.BROADCAST_NUMBERS, before = bound, mixing.BROADCAST_NUMBERS
        out = mixing.mixed(table)
        mixing.BROADCAST_NUMBERS = before
        assert sorted(out.columns) == sorted(["doc_id", "text", "source", *names, "shuffle_key"])
        rows = out.collect()
        assert Counter(r["doc_id"] for r in rows) == Counter({k: n for k in range(30) if (n := brute(name(k, "t"), 1.0))}) and all(r["copies"] == r["a.b"] == "x" for r in rows)


@pytest.fixture
def parts_stay(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_each_row_has_a_draw_of_its_own(spark, monkeypatch, parts_stay):
    texts = [f"t{k}" for k in range(3000)] + ["same"] * 3000 + ["twin"] * 40 + [None, "", ""]
    ids = [None] * 6000 + [7] * 40 + [8, 8, 8]
    want = Counter({(i, t): n for i, t, m in [(None, f"t{k}", 1) for k in range(3000)] + [(None, "same", 3000), (7, "twin", 40), (8, "", 3)] if (n := sum(brute(name(i, t, p), 1.0) for p in range(1, m + 1)))})
    table = docs(spark, texts, ids=ids, parts=8)
    for bound, given in ((0, table), (mixing.BROADCAST_TWINS, table), (mixing.BROADCAST_TWINS, table.coalesce(1))):
        monkeypatch.setattr(mixing, "BROADCAST_TWINS", bound)
        out = mixing.mixed(given, power=1.0).withColumn("part", F.spark_partition_id())
        rows = out.collect()
        assert Counter((r["doc_id"], r["text"] or "") for r in rows) == want
        assert len({r["shuffle_key"] for r in rows}) == len(rows)
        assert 5_500 < len(rows) < 6_600
        # rows without doc_id, and rows that are equal, are spread
        assert max(Counter(r["part"] for r in rows).values()) < 0.4 * len(rows)


def test_odd_rows_and_empty(spark):
    table = docs(spark, [None, "", "x", "x", "y"], ids=[1, 1, None, None, 5], sources=["a", "a", None, "b", "b"])
    out = mixing.mixed(table, weights={"a": 1.0, "b": 9.0}, size=50)
    assert set(SCHEMA.fieldNames()) < set(out.columns)
    assert {r["source"] for r in out.collect()} <= {"a", "b"}
    assert mixing.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
