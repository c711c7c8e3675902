"""From raw documents to packed training tokens, in five stages.

Each stage takes all that the one before kept. Stages are written as Parquet and
read again, in the session's shared folder, so a lost executor costs no more
than its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mergeweave.llm import decontaminate, mixing, quality, simhash, tokens
from mergeweave.llm._shared import stored, table
from mergeweave.llm.queries import VOCABULARY, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees accept (a score of 0.5 or more). A null text scores as an empty one; repeated rows stay or go alike; no rows give none."""
    trees = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, trees)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more. Null and empty texts are one group; of rows equal in doc_id and text one stays; rows without doc_id stay; no rows give none."""
    return simhash.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay, repeated rows stay or go alike; no rows give none."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources, in random order; a document occurs as often as its source's rate has it. Each row has a draw of its own, without doc_id or repeated too; a null source is a source; null texts stay; no rows give none."""
    return mixing.mixed(docs).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids in the order of the mixture, read back: each document's place and checksum. Null and empty texts are the end id alone; no rows give none."""
    return tokens.read_back(tokens.shards(docs, tokenizer_path(), VOCABULARY, ordered=False))


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("token ids", token_stage),
]

#: No SQL expresses trained trees; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
