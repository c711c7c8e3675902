"""Tables between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only where all runs on one machine, as in tests, a temporary folder serves if the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", None) or spark.sparkContext.master).startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="mergeweave-")
    return _LOCAL[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again.

    This cuts the lineage: a lost executor costs the tasks that ran on it, not
    the work of the steps before. Tables stay until the folder is cleared, since
    results that are not read yet may need them. options: of the writer.
    """
    path = new_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
