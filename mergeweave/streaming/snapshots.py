"""The latest snapshot of each pull request, kept over a stream of event files.

The aggregation is the batch's own: a maximum by order and sets, which come out
alike in whatever order files arrive, so an event that is late changes what it
would have changed in time. Each trigger writes the rows that changed to a folder of
its own, replaced whole if the trigger is run again; the current table is the
last of these rows for each pull request.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schemas as S
from ..operators.snapshot import KEY, snapshots

#: State lies on disk beside the executors' memory, and in the checkpoint.
STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def events(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A streaming table of ``pr_events`` as stage 1 writes it, files old and new."""
    return spark.readStream.schema(S.EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def start(pr_events: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True):
    """Keep ``snapshots`` of a stream of direct events; state holds a row for each pull request, with no watermark, as none is ever closed."""
    pr_events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE)

    def write(changed: DataFrame, trigger: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out_dir}/trigger={trigger}")

    writer = snapshots(pr_events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The table as of the last trigger; None before the first."""
    try:
        rows = spark.read.parquet(out_dir)
    except AnalysisException:
        return None
    columns = [c for c in rows.columns if c not in (*KEY, "trigger")]
    last = rows.groupBy(*KEY).agg(F.max_by(F.struct(*columns), "trigger").alias("last"))
    return last.select(*KEY, "last.*")


def compacted(spark: SparkSession, out_dir: str, to: str) -> None:
    """Write the current table to ``to`` as a first trigger of its own, for readers that shall not go through all changes."""
    rows = current(spark, out_dir)
    if rows is not None:
        rows.write.parquet(f"{to}/trigger=-1")
