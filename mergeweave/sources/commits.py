"""A log of what has been written: each commit is one row file beside the data, which appears at once or not at all.

A commit's data lie in a folder of their own, ``commit=<id>`` below the table's,
and count once the log names them. What a run that died has left is in no
commit: it is never read, and its rows are made again. A log entry says which
bucket it is about, how many rows of input the bucket had, and how many rows came of it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = T.StructType(
    [T.StructField("commit", T.StringType(), False), T.StructField("at", T.TimestampType(), False), T.StructField("repo_bucket", T.IntegerType()), T.StructField("rows_in", T.LongType(), False), T.StructField("rows_out", T.LongType(), False)]
)


def new_commit() -> str:
    return uuid.uuid4().hex


def folder(root: str, commit: str) -> str:
    return f"{root}/commit={commit}"


def record(spark: SparkSession, root: str, commit: str, buckets: list[tuple[int, int, int]]) -> None:
    """Commit ``(bucket, rows in, rows out)``. One file is written, which Spark's committer renames into place as its last step."""
    rows = spark.createDataFrame([(commit, *b) for b in buckets], "commit string, repo_bucket int, rows_in long, rows_out long").withColumn("at", F.current_timestamp())
    rows.select(*_LOG.fieldNames()).coalesce(1).write.mode("append").parquet(f"{root}/_commits")


def log(spark: SparkSession, root: str) -> DataFrame:
    """All entries; none if nothing was committed yet."""
    try:
        return spark.read.schema(_LOG).parquet(f"{root}/_commits")
    except AnalysisException:
        return spark.createDataFrame([], _LOG)


def committed(spark: SparkSession, root: str) -> DataFrame | None:
    """The table's committed rows, None if there are none. Folders that no entry names aren't opened."""
    names = [r[0] for r in log(spark, root).where("rows_out > 0").select("commit").distinct().collect()]
    if not names:
        return None
    return spark.read.option("basePath", root).parquet(*[folder(root, n) for n in sorted(names)]).drop("commit")


def finished(spark: SparkSession, root: str, rows: DataFrame) -> list[int]:
    """Buckets of which the last commit had as many input rows as ``rows(repo_bucket, ...)`` has now. Their number is bounded by that of buckets."""
    last = log(spark, root).groupBy("repo_bucket").agg(F.max_by("rows_in", "at").alias("rows"))
    now = rows.groupBy("repo_bucket").agg(F.count("*").alias("rows"))
    return sorted(r[0] for r in now.join(last, ["repo_bucket", "rows"], "left_semi").select("repo_bucket").collect())


def forgotten(spark: SparkSession, root: str) -> list[str]:
    """Folders of runs that died, which may be removed when no run is under way."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [s.getPath().getName().removeprefix("commit=") for s in store.globStatus(path(f"{root}/commit=*")) or []]
    named = {r[0] for r in log(spark, root).select("commit").distinct().collect()}
    return [folder(root, n) for n in sorted(there) if n not in named]
