from collections import Counter

import corpus_pipeline
import pytest

from mergeweave.llm import decontaminate, mixing, quality

from .helpers import ODD, ODD_IDS, SCHEMA, docs
from .test_decontaminate import brute_tiles
from .test_mixing import brute as poisson
from .test_mixing import name as identity
from .test_simhash import jaccard_groups


def covered(item, doc):
    """Whether greedy tiles of five words cover half of the item; by definition, where any five words are common at all."""
    least = min(5, len(item))
    seeds = {tuple(item[k : k + least]) for k in range(len(item) - least + 1)}
    if not least or not any(tuple(doc[k : k + least]) in seeds for k in range(len(doc) - least + 1)):
        return False
    return sum(n for _, _, n in brute_tiles(item, doc, least)) >= 0.5 * len(item)


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    names, done = [], docs
    for name, stage in corpus_pipeline.STAGES:
        before, done = done, stage(spark, done, data)
        names.append(name)
        if name != "token ids":
            assert done.columns == docs.columns
        done = done.cache()
        if name == "quality classifier":
            scores = quality.scored(before, quality.learn(docs, spark.read.parquet(f"{data}/labels.parquet")))
            assert {r["doc_id"] for r in done.collect()} == {r["doc_id"] for r in scores.where("predicted = 1").collect()}
        elif name == "simhash near-dedup":
            assert sorted(r["doc_id"] for r in done.collect()) == jaccard_groups([(r["doc_id"], r["text"]) for r in before.collect()])
        elif name == "benchmark decontamination":
            items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
            bad = {r["doc_id"] for r in before.collect() if any(covered(i, decontaminate.words_of(r["text"])) for i in items)}
            assert bad and {r["doc_id"] for r in done.collect()} == {r["doc_id"] for r in before.collect()} - bad
        elif name == "mixing sources":
            rates = {r["source"]: r["rate"] for r in mixing.rates(before).collect()}
            want = Counter({r["doc_id"]: n for r in before.collect() if (n := poisson(identity(r["doc_id"], r["text"]), rates[r["source"]]))})
            assert Counter(r["doc_id"] for r in done.collect()) == want
        else:
            got = sorted(done.collect(), key=lambda r: r["start"])
            assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in before.collect())
            assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:k]) for k in range(len(got))]
    assert len(names) == 5


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_each_stage_stands_odd_rows(spark, data, name, stage):
    for table in (docs(spark, ODD, ODD_IDS), docs(spark, [None, "same text here"] * 3, [None, 7] * 3, [None, "s"] * 3), spark.createDataFrame([], SCHEMA)):
        done = stage(spark, table, data)
        rows = done.collect()
        if name == "token ids":
            assert len(rows) == table.count() and all(r["n_tokens"] > 0 for r in rows)
            continue
        assert done.columns == table.columns
        given = {(r["doc_id"], r["text"]) for r in table.collect()}
        assert {(r["doc_id"], r["text"]) for r in rows} <= given
        if name == "simhash near-dedup" and len(given) == len(ODD):
            # two texts are equal, three have no words; the row without doc_id stays
            assert len(rows) == len(ODD) - 3 and any(r["doc_id"] is None for r in rows)
        elif name == "benchmark decontamination":
            assert len(rows) == table.count()


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
