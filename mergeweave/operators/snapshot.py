"""The latest snapshot of each pull request, and what its direct events gather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["repo_bucket", "repo_id", "pr_number"]


def scan_order() -> Column:
    """Events have no order of their own; time and id stand for it. A missing one comes first."""
    return F.struct(F.coalesce("created_at", F.lit("")).alias("at"), F.coalesce("event_id", F.lit("")).alias("id"))


def _snapshot_order() -> Column:
    pr = F.col("pull_request")
    changed = F.coalesce(F.nullif(pr["updated_at"], F.lit("")), F.nullif(pr["created_at"], F.lit("")), F.lit(""))
    return F.struct(changed.alias("changed"), scan_order().alias("scan"))


def direct_events(pr_events: DataFrame) -> DataFrame:
    return pr_events.where("direct_pr_number is not null").withColumn("pr_number", F.col("direct_pr_number"))


def snapshots(pr_events: DataFrame) -> DataFrame:
    """One row for each pull request that any event holds a snapshot of.

    ``pull_request`` is the snapshot that changed last; of equal ones the event
    last in order. participants, head_refs and head_shas are sorted sets over
    all direct events. head_repo_id is that of the last event with a snapshot,
    even if null. number and base are the latest that aren't null.
    """
    pr = F.col("pull_request")
    order, has = _snapshot_order(), pr.isNotNull()
    latest = lambda value, given: F.max_by(value, F.when(given, order))
    sets = lambda value: F.array_sort(F.collect_set(value))
    ref, sha = pr["head"]["ref"], pr["head"]["sha"]
    return (
        direct_events(pr_events)
        .groupBy(*KEY)
        .agg(
            F.max_by("pull_request", F.when(has, order)).alias("pull_request"),
            latest(pr["number"], has & pr["number"].isNotNull()).alias("number"),
            latest(F.struct(pr["base"]["repo"]["id"].alias("repo_id"), pr["base"]["ref"].alias("ref")), has & pr["base"].isNotNull()).alias("base"),
            sets(F.col("actor.login")).alias("participants"),
            sets(F.when(ref != "", F.concat(F.lit("refs/heads/"), ref))).alias("head_refs"),
            sets(F.when(sha != "", sha)).alias("head_shas"),
            F.max_by(F.struct(pr["head"]["repo"]["id"].alias("id")), F.when(has, scan_order()))["id"].alias("head_repo_id"),
        )
        .where("pull_request is not null")
    )


def body_versions(pr_events: DataFrame) -> DataFrame:
    """``(key, pr_body_versions)``: different bodies of a pull request or its issue by first occurrence, where there are two or more."""
    pr, issue = F.col("pull_request"), F.col("issue")
    blank = F.lit("")
    of_pr = F.when(pr["body"] != "", F.struct(F.lit("pull_request").alias("source"), F.coalesce(F.nullif(pr["updated_at"], blank), F.nullif(pr["created_at"], blank), F.col("created_at")).alias("at"), F.col("event_id"), pr["body"].alias("body")))
    of_issue = F.when((F.col("type") == "IssueCommentEvent") & (issue["body"] != ""), F.struct(F.lit("issue").alias("source"), F.coalesce(F.nullif(issue["updated_at"], blank), F.col("created_at")).alias("at"), F.col("event_id"), issue["body"].alias("body")))
    rows = direct_events(pr_events).select(*KEY, scan_order().alias("ord"), F.explode(F.array_compact(F.array(of_pr, of_issue))).alias("v"))
    first = rows.groupBy(*KEY, F.col("v.body").alias("body")).agg(F.min(F.struct("ord", "v")).alias("first"))
    listed = first.groupBy(*KEY).agg(F.array_sort(F.collect_list("first")).alias("all"))
    return listed.where(F.size("all") > 1).select(*KEY, F.transform("all", lambda x: x["v"]).alias("pr_body_versions"))
