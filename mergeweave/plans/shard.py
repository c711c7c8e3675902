"""Stage 1: JSON lines to typed, bucketed event tables."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import configure
from ..functions.events import normalized
from ..functions.schemas import DIRECT_TYPES
from ..sources import archive, sinks


def events(lines: DataFrame, buckets: int = 1024, keep_extra: bool = False, columns: list[str] | None = None, seen: Observation | None = None) -> DataFrame:
    """The event table of a table of lines (column ``value``), or some columns of it."""
    configure(lines.sparkSession)
    return normalized(lines, buckets, keep_extra, columns, seen)


def statistics(lines: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: lines, malformed lines, events kept, and those by table."""
    direct = F.col("type").isin(DIRECT_TYPES)
    counts = kept.agg(F.count("*").alias("events_kept"), F.count(F.when(direct, 1)).alias("kept_pr"), F.count(F.when(~direct, 1)).alias("kept_other"))
    return archive.line_statistics(lines).join(F.broadcast(counts))


def run(spark: SparkSession, in_dir: str, out_dir: str, buckets: int = 1024, keep_extra: bool = False, max_bad_lines: int | None = None, count_damage: bool = False, **sink) -> dict[str, int]:
    """Type the archives below ``in_dir`` and write both tables; counts of lines and events, from the same pass. count_damage: of damaged files too, ``bad_files``; they are then read as ``archive.checked`` does."""
    harm = Observation()
    lines = archive.checked(spark, in_dir).observe(harm, F.count("damage").alias("bad_files")).where("damage is null") if count_damage else archive.lines(spark, in_dir)
    configure(spark)
    if max_bad_lines is not None:
        lines = archive.within_budget(lines, max_bad_lines)
    seen, kept, direct = Observation(), Observation(), F.col("type").isin(DIRECT_TYPES)
    rows = events(lines, buckets, keep_extra, seen=seen)
    rows = rows.observe(kept, F.count(F.lit(1)).alias("events_kept"), F.count_if(direct).alias("kept_pr"), F.count_if(~direct).alias("kept_other"))
    sinks.write_events(rows, out_dir, **sink)
    return seen.get | kept.get | (harm.get if count_damage else {})


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--in-root", "--in-dir", dest="in_dir", required=True)
    p.add_argument("--out-dir", required=True)
    p.add_argument("--buckets", type=int, default=1024)
    p.add_argument("--flush-rows", type=int, default=1_000_000, help="rows of a file at most")
    p.add_argument("--keep-extra-json", action="store_true")
    p.add_argument("--max-bad-lines", type=int, help="malformed lines after which a file is left; none by default")
    p.add_argument("--row-group-rows", type=int, help="rows of a row group at most")
    p.add_argument("--row-group-size", type=int, help="bytes of a row group")
    p.add_argument("--count-damage", action="store_true", help="count damaged files; a task then holds an archive as it lies in the store")
    p.add_argument("--compression", default="zstd")
    p.add_argument("--parts", type=int, help="tasks that write a table; shuffle partitions by default")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("mergeweave-shard").getOrCreate()
    print(run(spark, a.in_dir, a.out_dir, a.buckets, a.keep_extra_json, a.max_bad_lines, a.count_damage, rows_per_file=a.flush_rows, compression=a.compression, parts=a.parts, row_group_rows=a.row_group_rows, row_group_bytes=a.row_group_size))


if __name__ == "__main__":
    main()
