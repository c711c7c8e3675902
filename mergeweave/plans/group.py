"""Stage 2: event tables to one row for each kept pull request."""

from __future__ import annotations

import argparse
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import schemas as S
from ..functions.coerce import configure
from ..operators.attach import attached, nested
from ..operators.landed import with_landed
from ..operators.quality import kept as quality_kept
from ..operators.snapshot import KEY, body_versions, snapshots
from ..sources import sinks
from ..sources.scratch import stored


def kept_pull_requests(pr_events: DataFrame, other_events: DataFrame, inference_source: str = "pr_events", bucket_local: bool = True) -> DataFrame:
    """Merged, landed pull requests that pass the quality filter.

    inference_source: "pr_events", in which no push ever is, so that nothing is
    inferred (what the original does); "all", what it means to; "none".
    """
    pushes = {"pr_events": lambda: pr_events, "all": lambda: pr_events.unionByName(other_events), "none": lambda: None}[inference_source]()
    return quality_kept(with_landed(snapshots(pr_events), pushes, bucket_local))


def pull_request_rows(
    pr_events: DataFrame, other_events: DataFrame, inference_source: str = "pr_events", bucket_local: bool = True
) -> DataFrame:
    """``repo_bucket`` and the columns of ``schemas.PR_ROW``. The kept pull requests are stored before events are joined to them in four ways."""
    configure(pr_events.sparkSession)
    kept = stored(kept_pull_requests(pr_events, other_events, inference_source, bucket_local), "kept")
    ranked = pr_events.withColumn("src_rank", F.lit(0)).unionByName(other_events.withColumn("src_rank", F.lit(1)))
    # nothing but relevant types is attached
    lists = nested(attached(ranked.where(F.col("type").isin(S.PR_TYPES)), kept, bucket_local))
    joined = kept.join(body_versions(pr_events), KEY, "left").join(lists, KEY, "left")
    none = F.array().cast(S.PR_ROW["events"].dataType)
    pr = S.PR_ROW["pull_request"].dataType
    columns = {c: F.col(c) for c in S.PR_ROW.fieldNames()}
    columns["pull_request"] = _widened(F.col("pull_request"), pr).alias("pull_request")
    columns["events"] = F.coalesce("events", none).alias("events")
    return joined.select("repo_bucket", *columns.values())


def _widened(source, to):
    """A struct with the fields of another: missing ones null, others dropped, all the way down."""
    from pyspark.sql import types as T

    have = S.event_struct("pull_request")

    def fit(value, old: T.DataType, new: T.DataType):
        if old == new:
            return value
        if isinstance(new, T.ArrayType):
            return F.transform(value, lambda x: fit(x, old.elementType, new.elementType))
        names = set(old.fieldNames())
        fields = [(fit(value[f.name], old[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in new.fields]
        return F.when(value.isNotNull(), F.struct(*fields))

    return fit(source, have, to)


def statistics(events: DataFrame, kept: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of counts: events, pull requests kept, events attached at least once or not."""
    seen = events.agg(F.count("*").alias("events_seen"))
    prs = kept.agg(F.count("*").alias("prs_kept"), F.count(F.when(F.col("landed_inferred"), 1)).alias("inferred_used"))
    hits = rows.agg(F.count("*").alias("attachments"), F.countDistinct("src_rank", "event_id").alias("events_attached"))
    return seen.join(F.broadcast(prs)).join(F.broadcast(hits))


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--stage1-dir", required=True)
    p.add_argument("--out-dir", required=True)
    p.add_argument("--buckets", default="", help="comma-separated; all by default")
    p.add_argument("--max-rows-per-file", type=int, default=100_000)
    p.add_argument("--inference-source", choices=["pr_events", "all", "none"], default="pr_events")
    p.add_argument("--compression", default="zstd")
    p.add_argument("--parts", type=int, help="tasks that write the table; shuffle partitions by default")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("mergeweave-group").getOrCreate()
    buckets = sinks.bucket_list(a.buckets)
    pr, other = (sinks.read_events(spark, sinks.event_table(spark, a.stage1_dir, n), buckets) for n in ("pr_events", "other_events"))
    rows = stored(pull_request_rows(pr, other, a.inference_source), "rows")
    sinks.write_pr_rows(rows, a.out_dir, a.max_rows_per_file, a.compression, parts=a.parts)


if __name__ == "__main__":
    main()
