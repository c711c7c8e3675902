"""Stage 1 as a stream: archives come as a file an hour, and typing a line needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.coerce import configure
from ..functions.events import normalized
from ..sources import sinks
from ..sources.archive import GLOB


def events(spark: SparkSession, root: str, buckets: int = 1024, keep_extra: bool = False, files_per_trigger: int = 64) -> DataFrame:
    """A streaming table of events from the files below ``root``, old and new."""
    configure(spark)
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", GLOB).option("ignoreCorruptFiles", "true")
    return normalized(reader.option("lineSep", "\n").option("maxFilesPerTrigger", files_per_trigger).text(root), buckets, keep_extra)


def start(stream: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True):
    """Append each batch to the event tables. Each has its own query and checkpoint, so that either is written exactly once."""
    from pyspark.sql import functions as F

    from ..functions.schemas import DIRECT_TYPES

    direct = F.col("type").isin(DIRECT_TYPES)
    started = []
    for name, rows in (("pr_events", stream.where(direct)), ("other_events", stream.where(~direct))):
        writer = sinks._bucketed(rows).writeStream.format("parquet").partitionBy("repo_bucket").option("path", f"{out_dir}/{name}")
        writer = writer.option("checkpointLocation", f"{checkpoint}/{name}").option("compression", "zstd").outputMode("append")
        started.append((writer.trigger(availableNow=True) if available_now else writer).start())
    return started
