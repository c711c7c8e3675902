"""Stage 3: rows of pull requests with code from git.

Rows are dealt by repository and sorted by it, so a task clones a repository
once, for the run of its rows, and removes the clone after it. Repositories with
more rows than a task should take are cut into chunks, and chunks and groups of
small repositories are packed into tasks by their rows, the largest first.
Chunks of a repository that meet on a machine borrow from one clone there.

A run goes by groups of buckets and commits each, so what a run has done before it died is kept.
"""

from __future__ import annotations

import argparse
import heapq
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import schemas as S
from ..functions.text import first_of
from ..operators import gitops
from ..sources import commits, sinks


def discussion_count(events: Column) -> Column:
    """Events of the four types that carry a number; null for null."""
    return F.when(events.isNotNull(), F.size(F.filter(events, lambda e: e["type"].isin(S.DIRECT_TYPES)))).cast("int")


def wanted(rows: DataFrame) -> dict[str, Column]:
    """Which repository, pull request and commits a row is about, by the fallbacks that its columns allow."""
    pr = F.col("pull_request")
    return {
        "repo": first_of(pr["base"]["repo"]["full_name"], pr["head"]["repo"]["full_name"]),
        "number": F.coalesce("pr_number", pr["number"]),
        "base": first_of(pr["base"]["sha"]),
        "head": first_of(pr["head"]["sha"]),
        "discussion": discussion_count(F.col("events")),
        "repo_key": F.coalesce("repo_id", pr["base"]["repo"]["id"], pr["head"]["repo"]["id"]),
    }


def _arrow(kind: T.DataType) -> pa.DataType:
    """Strings and lists with 64-bit offsets: diffs and trees are large."""
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.StringType(): pa.large_string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_()}[kind]


#: Fixed value: bytes of a clone that may stay while the next repository is cloned.
SPARE_BYTES = 50_000_000


def _bytes(path: str) -> int:
    return sum(os.lstat(os.path.join(d, name)).st_size for d, _, names in os.walk(path) for name in names)


#: A task takes about so many rows at most, and a repository isn't cut into chunks of fewer than the least.
ROWS_PER_TASK, LEAST_CHUNK = 1000, 8
#: Small repositories are packed by groups, so many for each task, and large ones by chunks of such a part of what a task takes: hashes fill chunks unevenly.
GROUPS, CHUNKS = 8, 4


def packed(weights: list[int], bins: int) -> list[int]:
    """A bin for each weight: the largest first, each into the bin that holds least."""
    heap = [(0, b) for b in range(bins)]
    out = [0] * len(weights)
    for k in sorted(range(len(weights)), key=lambda k: (-weights[k], k)):
        held, b = heapq.heappop(heap)
        out[k] = b
        heapq.heappush(heap, (held + weights[k], b))
    return out


def dealt(rows: DataFrame, key: str, item: str, rows_per_task: int = ROWS_PER_TASK, least: int = LEAST_CHUNK) -> DataFrame:
    """``rows`` in as many partitions as their number asks for, with ``__shared``: whether rows of the same ``key`` are in several.

    Keys with more rows than fit a task are cut into chunks by a hash of
    ``item``, rows without key go by it alone. ``rows`` is read several times, so it should be a table. The driver packs chunks and groups of small keys; there are
    ``GROUPS`` groups and ``2 * CHUNKS`` chunks for each task at most, whatever the keys.
    """
    spark = rows.sparkSession
    total = rows.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // rows_per_task))
    fair = max(least, min(rows_per_task, -(-total // tasks)))
    chunk = max(least, -(-fair // CHUNKS))
    large = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__of")).agg(F.count("*").alias("__rows")).where(F.col("__rows") > fair)
    large = large.select("__of", F.ceil(F.col("__rows") / chunk).cast("int").alias("__chunks"))
    marked = rows.join(large, F.col(key) == F.col("__of"), "left").drop("__of")
    shared = F.col("__chunks").isNotNull()
    salt = F.when(shared, F.pmod(F.xxhash64(item), F.col("__chunks"))).otherwise(F.pmod(F.when(F.col(key).isNull(), F.xxhash64(item)).otherwise(F.xxhash64(key)), F.lit(GROUPS * tasks))).cast("int")
    marked = marked.select(*rows.columns, shared.alias("__shared"), F.when(shared, F.col(key)).alias("__large"), salt.alias("__salt"))
    units = marked.groupBy("__large", "__salt").agg(F.count("*").alias("n")).orderBy("__large", "__salt").collect()
    bins = packed([u["n"] for u in units], tasks)
    kind = marked.schema["__large"].dataType
    placed = spark.createDataFrame(
        [(u["__large"], u["__salt"], b) for u, b in zip(units, bins, strict=True)], T.StructType([T.StructField("__l", kind), T.StructField("__s", T.IntegerType()), T.StructField("__bin", T.IntegerType())])
    )
    where = marked.join(F.broadcast(placed), F.col("__large").eqNullSafe(F.col("__l")) & (F.col("__salt") == F.col("__s")))
    return where.repartitionById(tasks, F.col("__bin")).select(*rows.columns, "__shared")


def enriched(rows: DataFrame, limits: gitops.Limits | None = None, clone_url: Callable[[str], str] = gitops.hosted, clone_root: str | None = None, exact_paths: bool = False, batch: int = 16, rows_per_task: int = ROWS_PER_TASK, keep_clones: bool = False, least_chunk: int = LEAST_CHUNK) -> DataFrame:
    """``rows`` with the column ``code``; order within a part is by repository and number.

    clone_url: from a repository's full name. clone_root: folder of clones on
    each executor, a temporary one by default; keep_clones: leave them there and fetch when they are met again. What a row needs goes to the
    worker as five scalars beside it; ``batch`` rows return at once, since
    they are large. rows_per_task, least_chunk: see ``dealt``; no result depends on them.
    """
    limits = limits or gitops.Limits()
    asks = wanted(rows)
    asked = rows.withColumn("__ask", F.struct(*[c.alias(n) for n, c in asks.items()])).withColumn("__key", F.col("__ask.repo_key")).withColumn("__item", F.col("__ask.number"))
    parts = dealt(asked, "__key", "__item", rows_per_task, least_chunk)
    ordered = parts.withColumn("__ask", F.col("__ask").withField("shared", F.col("__shared"))).sortWithinPartitions("__key", "__item").drop("__key", "__item", "__shared")
    schema = T.StructType([*rows.schema.fields, T.StructField("code", S.CODE)])
    kind = _arrow(S.CODE)
    of_run = uuid.uuid4().hex

    def run(batches):
        root = clone_root if keep_clones and clone_root else tempfile.mkdtemp(prefix="clones-", dir=clone_root)
        mirrors = gitops.Mirrors(os.path.join(clone_root or tempfile.gettempdir(), f"mirrors-{of_run}"))
        clones: dict[str, gitops.Repository] = {}
        entered: dict[str, str] = {}
        # of the repository whose rows are read: URLs by its names, and as a set
        urls: dict[str, str] = {}
        current: set[str] = set()
        now, shared = object(), False
        # numbers that the batch asks for, by repository and name, and of the present one by URL
        ahead: dict[object, dict[str, list[int]]] = {}
        expected: dict[str, list[int]] = {}

        def url_of(full_name: str) -> str:
            if full_name not in urls:
                urls[full_name] = clone_url(full_name)
            return urls[full_name]

        def repository(full_name: str) -> gitops.Repository:
            url = url_of(full_name)
            for name, numbers in ahead.pop(now, {}).items():
                expected.setdefault(url_of(name), []).extend(numbers)
            if url not in current:
                # a clone stays for the next repository if that is cloned from where it was; the last other one, if it is small
                others = [u for u in clones if u != url and u not in current]
                spare = [u for u in others[-1:] if _bytes(clones[u].path) <= SPARE_BYTES]
                left(current if keep_clones else {*current, url, *spare})
                current.add(url)
            if url in clones:
                clones[url] = clones.pop(url)  # the last
            else:
                name = full_name.replace("/", "__") + ".git"
                mirror = mirrors.enter(name, url) if shared else None
                if mirror:
                    entered[url] = name
                # tasks that hold chunks of one repository have a clone each
                path = os.path.join(root, f"{uuid.uuid4().hex}-{name}" if shared else name)
                clones[url] = gitops.Repository(path, url, exact_paths, mirror)
            if url in expected:
                clones[url].expect(expected.pop(url))
            return clones[url]

        def left(but: set[str] = frozenset()):
            for url in [u for u in clones if u not in but]:
                old = clones.pop(url)
                if not keep_clones or old.mirror:
                    shutil.rmtree(old.path, ignore_errors=True)
                if url in entered:
                    mirrors.leave(entered.pop(url))

        try:
            for whole in batches:
                asks = whole.column(whole.schema.get_field_index("__ask")).to_pylist()
                ahead.clear()
                for a in asks:
                    if a["repo"] and a["number"] is not None and a["base"] and a["head"]:
                        ahead.setdefault(a["repo_key"], {}).setdefault(a["repo"], []).append(a["number"])
                for at in range(0, whole.num_rows, batch):
                    part = whole.slice(at, batch)
                    out = []
                    for a in asks[at : at + batch]:
                        if a["repo_key"] != now:
                            for held in (urls, current, expected):
                                held.clear()
                            now, shared = a["repo_key"], a["shared"]
                        out.append(gitops.enrich(gitops.Wanted(a["repo"], a["number"], a["base"], a["head"], a["discussion"]), repository, limits))
                    own = part.drop_columns(["__ask"])
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(out, kind)], schema=own.schema.append(pa.field("code", kind)))
        finally:
            left()
            if root != clone_root:
                shutil.rmtree(root, ignore_errors=True)

    return ordered.mapInArrow(run, schema)


def grouped(rows: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Buckets of ``(bucket, rows)`` in order, in groups of ``most`` rows at most (one bucket at least)."""
    out: list[list[int]] = []
    held = 0
    for bucket, n in sorted(rows):
        if not out or held + n > most:
            out.append([])
            held = 0
        out[-1].append(bucket)
        held += n
    return out


def run(spark, in_dir: str, out_dir: str, buckets: list[int] | None = None, rows_per_file: int = 5_000, rows_per_commit: int = 100_000, **how) -> dict[str, int]:
    """Enrich what ``out_dir`` doesn't have yet, by (repo_id, pr_number), and commit it by groups of buckets; how many rows came out ok, skip and error.

    Buckets that are committed with as many input rows as they have now aren't
    read. A run that dies keeps all groups that it committed; of the group it
    died in nothing counts. A group is made of whole buckets, of about
    ``rows_per_commit`` rows.
    """
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    rows = sinks.read_bucketed(spark, in_dir, None, buckets)
    done = commits.finished(spark, out_dir, rows)
    sizes = {r["repo_bucket"]: r["rows"] for r in sinks.bucket_rows(rows).collect() if r["repo_bucket"] not in set(done)}
    counts = {"ok": 0, "skip": 0, "error": 0}
    for group in grouped(list(sizes.items()), rows_per_commit):
        left = sinks.remaining(sinks.read_bucketed(spark, in_dir, None, group), commits.committed(spark, out_dir))
        commit, seen = commits.new_commit(), Observation()
        made = enriched(left, **how)
        status = F.col("code.status")
        watched = made.observe(seen, *[F.count_if(status == s).alias(s) for s in counts])
        sinks.append_bucketed(watched, commits.folder(out_dir, commit), ["repo_id", "pr_number"], rows_per_file)
        told = seen.get
        written = {r["repo_bucket"]: r["rows"] for r in sinks.bucket_rows(sinks.read_bucketed(spark, commits.folder(out_dir, commit))).collect()} if sum(told.values()) else {}
        commits.record(spark, out_dir, commit, [(b, sizes[b], written.get(b, 0)) for b in group])
        counts = {s: counts[s] + told[s] for s in counts}
    return counts


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--in-root", "--in-dir", dest="in_dir", required=True)
    p.add_argument("--out-dir", required=True)
    p.add_argument("--clone-root")
    p.add_argument("--buckets", default="")
    p.add_argument("--rows-per-file", type=int, default=100_000)
    p.add_argument("--batch-size", type=int, default=256)
    p.add_argument("--rows-per-commit", type=int, default=100_000, help="rows after which what is done is committed")
    p.add_argument("--rows-per-task", type=int, default=ROWS_PER_TASK, help="repositories with more rows are cut into chunks")
    p.add_argument("--keep-clones", action="store_true", help="leave clones in the clone root, and fetch when they are met again")
    p.add_argument("--exact-paths", action="store_true")
    for name, value in vars(gitops.Limits()).items():
        also = {"commits": "--max-commits", "patch_bytes": "--max-commit-patch-bytes"}.get(name)
        p.add_argument(f"--max-{name.replace('_', '-')}", *([also] if also and also != f"--max-{name.replace('_', '-')}" else []), dest=f"max_{name}", type=int, default=value)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("mergeweave-enrich").getOrCreate()
    limits = gitops.Limits(**{n: getattr(a, f"max_{n}") for n in vars(gitops.Limits())})
    done = run(spark, a.in_dir, a.out_dir, sinks.bucket_list(a.buckets), a.rows_per_file, limits=limits, clone_root=a.clone_root, exact_paths=a.exact_paths, batch=a.batch_size,
        rows_per_commit=a.rows_per_commit, rows_per_task=a.rows_per_task, keep_clones=a.keep_clones)
    print(done)


if __name__ == "__main__":
    main()
