"""Bucketed Parquet tables: written sorted, read pruned, resumed by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schemas as S
from . import commits
from .scratch import stored


def bucket_list(text: str) -> list[int] | None:
    """Distinct numbers of a comma-separated list, in order; None if there are none."""
    return list(dict.fromkeys(int(x) for x in text.replace(" ", "").split(",") if x)) or None


def _bucketed(df: DataFrame) -> DataFrame:
    """With the bucket as four digits or more, which is how its folder is named."""
    return df.withColumn("repo_bucket", F.format_string("%04d", F.col("repo_bucket").cast("int")))


#: Fixed value: row groups of a file at most, where their rows are bounded. A writer holds what it tells of all of them until the file ends.
GROUPS_PER_FILE = 100


def write_bucketed(df: DataFrame, path: str, order: list, rows_per_file: int, compression: str = "zstd", mode: str = "overwrite", parts: int | None = None, row_group_rows: int | None = None, row_group_bytes: int | None = None, look_up: tuple[str, ...] = ()) -> None:
    """One folder for each bucket, rows in ``order`` within files.

    Rows are range-partitioned by bucket and order, so a hot bucket, and a hot
    repository in it, spreads over as many tasks as its rows need; small buckets
    share one. Ranges come from a sample of the rows, so ``df`` should be a
    table. parts: number of ranges, that of shuffle partitions if None.
    row_group_rows, row_group_bytes: what a row group holds at most; with few rows in one, files hold fewer
    rows too. look_up: columns with Bloom filters, by which readers skip row groups that lack a value; they are as
    large as the rows of a group ask for, or as the values that are met.
    """
    keys = ["repo_bucket", *order]
    # the folder's name is what is sorted by: else the writer would sort once more, by the folder alone
    named = _bucketed(df)
    dealt = named.repartitionByRange(parts, *keys) if parts else named.repartitionByRange(*keys)
    writer = dealt.sortWithinPartitions(*keys).write.partitionBy("repo_bucket").option("compression", compression).option("partitionOverwriteMode", "dynamic")
    limits = {"parquet.block.row.count.limit": row_group_rows, "parquet.block.size": row_group_bytes} | {f"parquet.bloom.filter.enabled#{c}": "true" for c in look_up}
    if row_group_rows:
        rows_per_file = min(rows_per_file, GROUPS_PER_FILE * row_group_rows) if rows_per_file > 0 else GROUPS_PER_FILE * row_group_rows
        limits |= {f"parquet.bloom.filter.expected.ndv#{c}": str(row_group_rows) for c in look_up}
    elif look_up:
        limits |= {"parquet.bloom.filter.adaptive.enabled": "true"}
    writer.options(**{k: v for k, v in limits.items() if v is not None}).option("maxRecordsPerFile", rows_per_file).mode(mode).parquet(path)


def append_bucketed(df: DataFrame, path: str, order: list, rows_per_file: int, compression: str = "zstd") -> None:
    """One folder for each bucket, rows in ``order`` within files, each task writing what it has: for rows whose making is what costs, which are neither sampled nor shuffled once made."""
    named = _bucketed(df).sortWithinPartitions("repo_bucket", *order)
    named.write.partitionBy("repo_bucket").option("compression", compression).option("maxRecordsPerFile", rows_per_file).mode("append").parquet(path)


def scan_order() -> list:
    """By repository, time and id; a missing one comes first."""
    return [F.coalesce("repo_id", F.lit(-1)), F.coalesce("created_at", F.lit("")), F.coalesce("event_id", F.lit(""))]


def write_events(events: DataFrame, root: str, rows_per_file: int = 1_000_000, compression: str = "zstd", parts: int | None = None, row_group_rows: int | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """``pr_events`` for types with a number of their own, ``other_events`` for all others, as the new version of both in one commit.

    Lines are parsed and typed once: what comes of it is stored, then sampled,
    split and sorted. Returns the stored rows, unsorted. Readers see the version
    before until both tables are there, then both new ones; nothing of
    an earlier version is left in what they see. ``superseded`` names what may be removed.
    """
    spark, commit = events.sparkSession, commits.new_commit()
    typed = stored(events, "typed")
    direct = F.col("type").isin(S.DIRECT_TYPES)
    for name, which in (("pr_events", direct), ("other_events", ~direct)):
        write_bucketed(
            typed.where(which), f"{commits.folder(root, commit)}/{name}", scan_order(), rows_per_file, compression, parts=parts, row_group_rows=row_group_rows, row_group_bytes=row_group_bytes,
            look_up=("repo_id", "join_sha"),
        )
    n = typed.count()
    commits.record(spark, root, commit, [(None, n, n)])
    return typed


def event_table(spark: SparkSession, root: str, name: str) -> str:
    """Where the current version of ``pr_events`` or ``other_events`` below ``root`` lies; tables that a stream appends to have no versions."""
    last = commits.log(spark, root).where("repo_bucket is null").orderBy(F.desc("at")).select("commit").first()
    return f"{commits.folder(root, last[0])}/{name}" if last else f"{root}/{name}"


def superseded(spark: SparkSession, root: str) -> list[str]:
    """Folders of earlier versions, which may be removed once nobody reads them."""
    names = [r[0] for r in commits.log(spark, root).where("repo_bucket is null").orderBy("at").select("commit").collect()]
    return [commits.folder(root, n) for n in names[:-1]]


def row_groups(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``(file, row_group, rows, least, most)`` of the Parquet files below ``path``, from their footers: what readers skip row groups by. A task holds a file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "content")
    names = ["file", "row_group", "rows", "least", "most"]

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                meta = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
                rows = []
                for k in range(meta.num_row_groups):
                    group = meta.row_group(k)
                    told = next(c.statistics for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column)
                    some = told is not None and told.has_min_max
                    rows.append((file, k, group.num_rows, told.min if some else None, told.max if some else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)], names)

    return files.mapInArrow(run, "file string, row_group int, rows long, least long, most long")


def read_bucketed(spark: SparkSession, path: str, schema=None, buckets: list[int] | None = None) -> DataFrame:
    """The table with an int bucket; only folders of ``buckets`` are read if given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path).withColumn("repo_bucket", F.col("repo_bucket").cast("int"))
    return df if buckets is None else df.where(F.col("repo_bucket").isin(buckets))


def read_events(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    return read_bucketed(spark, path, S.EVENT, buckets).select(*S.EVENT.fieldNames())


def buckets_of(spark: SparkSession, path: str) -> DataFrame:
    """Distinct buckets, from folder names alone."""
    return spark.read.parquet(path).select(F.col("repo_bucket").cast("int").alias("repo_bucket")).distinct().orderBy("repo_bucket")


def row_count(spark: SparkSession, path: str) -> int:
    """From the files' footers."""
    return spark.read.option("aggregatePushdown", "true").parquet(path).count()


def write_pr_rows(rows: DataFrame, path: str, rows_per_file: int = 100_000, compression: str = "zstd", mode: str = "overwrite", parts: int | None = None) -> None:
    write_bucketed(rows, path, [F.col("repo_id"), F.col("pr_number")], rows_per_file, compression, mode, parts)


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """``(repo_bucket, file, rows)`` of a bucketed table, by bucket and name."""
    table = spark.read.parquet(path).select(F.col("repo_bucket").cast("int").alias("repo_bucket"), F.col("_metadata.file_path").alias("file"))
    return table.groupBy("repo_bucket", "file").agg(F.count("*").alias("rows")).orderBy("repo_bucket", "file")


def bucket_rows(rows: DataFrame) -> DataFrame:
    """``(repo_bucket, rows)``; of a table only folder names and footers are read."""
    return rows.groupBy("repo_bucket").agg(F.count("*").alias("rows"))


def remaining(rows: DataFrame, done: DataFrame | None, keys: tuple[str, ...] = ("repo_id", "pr_number")) -> DataFrame:
    """Rows whose key isn't in ``done`` yet; all if there is none. Null keys are equal to each other."""
    if done is None:
        return rows
    have = done.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & rows[k].eqNullSafe(have[f"__{k}"])
    return rows.join(have, same, "left_anti")
