import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mergeweave.llm import linededup

from .helpers import ODD, ODD_IDS, SCHEMA, docs

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def brute(pairs, least=10, keep="none"):
    seen, first = defaultdict(set), {}
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        for pos, line in enumerate((t or "").split("\n")):
            seen[key(line)].add(i)
            at = (i is not None, i or 0, pos)
            first[key(line)] = min(first.get(key(line), at), at)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for pos, x in enumerate(lines) if not (key(x) and len(seen[key(x)]) >= least) or keep == "first" and first[key(x)] == (i is not None, i or 0, pos)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, pairs, **how):
    table = docs(spark, [t for _, t in pairs], [i for i, _ in pairs])
    got = linededup.apply(table, linededup.bitmaps(table, **how)).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(kept_text, 256) as h").collect()
    return sorted(map(tuple, got), key=str)


TEXTS = [f"own {k}\n  Common LINE \n\nrare {k % 6}\ncommon line\n" for k in range(14)] + ["COMMON line", "\n\n", "x\n\x1ccommon line", "Común\ncomún"]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_same_as_brute_force(spark, keep):
    pairs = list(enumerate(TEXTS))
    want = brute(pairs, keep=keep)
    assert run(spark, pairs, keep=keep) == want
    assert sum(w[2] for w in want) >= 20


@pytest.mark.parametrize("bound", [0, 10**6])
def test_both_joins(spark, monkeypatch, bound):
    monkeypatch.setattr(linededup, "BROADCAST_KEYS", bound)
    pairs = list(enumerate(TEXTS))
    assert run(spark, pairs) == brute(pairs)


def test_odd_rows_and_repeated_ids(spark):
    pairs = list(zip(ODD_IDS, ODD)) + [(k, "again\nonce more") for k in (1, 2, 2, 2, 3)]
    assert run(spark, pairs, min_docs=3) == brute(pairs, least=3)


def test_runs(spark):
    table = docs(spark, ["a\nb\na\na", "a", "c"])
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["runs"]) for r in linededup.bitmaps(table, min_docs=2).collect()}
    assert got == {0: (4, 3, [0, 1, 1, 2]), 1: (1, 1, [0, 1]), 2: (1, 0, [1])}


def test_names_of_its_own(spark):
    names = ["__lines", "__flags", "__kept", "lines", "flags", "runs", "doc", "id", "cut_id", "kept_text", "n_lines", "a.b"]
    table = docs(spark, ["a\nb", "a"]).select("doc_id", "text", *[F.lit("x").alias(n) for n in names])
    out = linededup.apply(table, linededup.bitmaps(table, min_docs=2))
    assert sorted(out.columns) == sorted(["doc_id", "text", *names, "n_dropped"])
    assert {r["doc_id"]: (r["kept_text"], r["lines"], r["a.b"]) for r in out.collect()} == {0: ("b", "x", "x"), 1: ("", "x", "x")}


def test_empty_and_wrong(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert linededup.bitmaps(none).count() == 0
    with pytest.raises(ValueError):
        linededup.bitmaps(none, keep="last")
