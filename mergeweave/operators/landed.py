"""The commits by which a merged pull request landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .snapshot import KEY, scan_order


def told_numbers(message: Column) -> Column:
    """Distinct numbers, as text, whose ``#N`` a message holds, also as the beginning of a longer one: of #123 these are 1, 12 and 123."""
    runs = F.regexp_extract_all(F.coalesce(message, F.lit("")), F.lit("#(-?[0-9]+)"), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(runs, lambda n: F.transform(F.sequence(F.lit(1), F.least(F.length(n), F.lit(20))), lambda k: F.substring(n, F.lit(1), k)))))


def inferred(merged: DataFrame, pushes: DataFrame, bucket_local: bool = True) -> DataFrame:
    """``(key, landed_commit_shas)`` from pushes to the base branch, for pull requests without merge commit.

    A commit counts if its message holds ``#N`` (as part of ``#N5`` too) or its
    author is a participant; order is that of pushes, then of their commits.
    """
    wanted = merged.where(F.coalesce(F.col("pull_request.merge_commit_sha"), F.lit("")) == "").where(F.coalesce(F.col("base.ref"), F.lit("")) != "")
    wanted = wanted.select(*KEY, F.col("base.repo_id").alias("on_repo"), F.concat(F.lit("refs/heads/"), F.col("base.ref")).alias("on_ref"), "number", "participants")
    landed = pushes.where("type = 'PushEvent' and push is not null").select(
        F.col("repo_bucket").alias("in_bucket"), F.col("repo_id").alias("on_repo"), F.col("push_ref").alias("on_ref"), scan_order().alias("ord"), F.posexplode("push.commits").alias("pos", "commit")
    )
    author = F.coalesce(F.nullif(F.col("commit.author.username"), F.lit("")), F.nullif(F.col("commit.author.name"), F.lit("")))
    landed = landed.where(F.col("commit.sha").isNotNull()).withColumn("author", author)
    on = ["on_repo", "on_ref"] + (["repo_bucket"] if bucket_local else [])
    landed = landed.withColumnRenamed("in_bucket", "repo_bucket") if bucket_local else landed.drop("in_bucket")
    # both ways are equi-joins, so that a busy branch doesn't meet all of its pull requests
    told = landed.select(*on, "ord", "pos", F.col("commit.sha").alias("sha"), F.explode(told_numbers(F.col("commit.message"))).alias("number"))
    by_number = wanted.select(*{*KEY, *on}, F.col("number").cast("string").alias("number")).join(told, [*on, "number"])
    taking_part = wanted.select(*{*KEY, *on}, F.explode("participants").alias("author"))
    by_author = taking_part.join(landed.select(*on, "ord", "pos", F.col("commit.sha").alias("sha"), "author"), [*on, "author"])
    found = by_number.select(*KEY, "sha", "ord", "pos").unionByName(by_author.select(*KEY, "sha", "ord", "pos"))
    hits = found.groupBy(*KEY, "sha").agg(F.min(F.struct("ord", "pos")).alias("first"))
    return hits.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("first", "sha"))).alias("all")).select(*KEY, F.transform("all", lambda x: x["sha"]).alias("landed_commit_shas"))


def with_landed(snapshots: DataFrame, pushes: DataFrame | None = None, bucket_local: bool = True) -> DataFrame:
    """Merged pull requests with ``landed_commit_sha``, ``landed_commit_shas`` and ``landed_inferred``; those without any are left out.

    pushes: events to infer from; none are inferred without.
    """
    merged = snapshots.where("pull_request.merged")
    sha = F.nullif(F.col("pull_request.merge_commit_sha"), F.lit(""))
    known = merged.where(sha.isNotNull()).select(*merged.columns, sha.alias("landed_commit_sha"), F.array(sha).alias("landed_commit_shas"), F.lit(False).alias("landed_inferred"))
    if pushes is None:
        return known
    found = merged.join(inferred(merged, pushes, bucket_local), KEY)
    return known.unionByName(found.select(*merged.columns, F.col("landed_commit_shas")[0].alias("landed_commit_sha"), "landed_commit_shas", F.lit(True).alias("landed_inferred")))
