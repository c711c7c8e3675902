"""Events to pull requests, by the first of four ways that yields a candidate.

An event goes by its own number; else, if a check, by the numbers it lists;
else, if a push, to pull requests from that branch; else by a commit that is the
head of exactly one of them. The conditions exclude each other, so the four joins
are a union. Whether a candidate is kept doesn't matter for the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import schemas as S
from ..functions.coerce import json_map, merged_json
from .snapshot import KEY


def _listed() -> Column:
    return F.col("type").isin(S.CHECK_TYPES) & (F.coalesce(F.size("check_pr_numbers"), F.lit(-1)) > 0)


def is_direct() -> Column:
    return F.col("direct_pr_number").isNotNull()


def is_check() -> Column:
    return ~is_direct() & _listed()


def is_push() -> Column:
    return ~is_direct() & (F.col("type") == "PushEvent")


def is_sha() -> Column:
    return ~is_direct() & ~_listed() & (F.col("type") != "PushEvent") & (F.coalesce(F.col("join_sha"), F.lit("")) != "")


def _same_bucket(joined: DataFrame, bucket_local: bool) -> DataFrame:
    joined = joined.where("repo_bucket = __bucket") if bucket_local else joined
    return joined


def _events(events: DataFrame) -> DataFrame:
    """Names of events' keys apart from those of pull requests."""
    return events.withColumnsRenamed({"repo_bucket": "__bucket", "repo_id": "__repo"})


def by_number(events: DataFrame, kept: DataFrame) -> DataFrame:
    """Direct events, and checks by their listed numbers: one join for both."""
    numbers = F.when(is_direct(), F.array("direct_pr_number")).when(is_check(), F.col("check_pr_numbers"))
    return (
        events.where(is_direct() | is_check())
        .withColumn("pr_number", F.explode(numbers))
        .join(kept.select(*KEY), KEY)
        .withColumnsRenamed({"repo_bucket": "__bucket"})
        .withColumn("__repo", F.col("repo_id"))
        .withColumn("repo_bucket", F.col("__bucket"))
    )


def by_branch(events: DataFrame, kept: DataFrame, bucket_local: bool = True) -> DataFrame:
    """Pushes to the branch of a pull request. Where it has commits on record, the push's head must be one of them, or, without head, any of its commits.

    Each case is an equi-join of its own, on the commit too where one decides,
    so a push to a busy branch only meets pull requests that it belongs to.
    """
    branches = kept.where("head_repo_id is not null").select(*KEY, F.col("head_repo_id").alias("__repo"), "head_shas", F.explode("head_refs").alias("push_ref"))
    on_record = F.coalesce(F.size("head_shas"), F.lit(0)) > 0
    told = branches.where(on_record)
    by_sha = told.select(*KEY, "__repo", "push_ref", F.explode(F.array_distinct("head_shas")).alias("__sha"))
    pushes = _events(events.where(is_push() & (F.col("push_ref") != "")))
    has_head, has_commits = F.coalesce(F.col("push_head"), F.lit("")) != "", F.coalesce(F.size("push_commit_shas"), F.lit(0)) > 0
    branch, commit = ["__repo", "push_ref"], ["__repo", "push_ref", "__sha"]
    columns = [*KEY, *[c for c in pushes.columns if c not in KEY]]
    by_head = pushes.where(has_head).withColumn("__sha", F.col("push_head")).join(by_sha, commit)
    # a push without head may share several commits with a pull request, which it belongs to once
    listed = pushes.where(~has_head & has_commits).withColumn("__push", F.monotonically_increasing_id()).withColumn("__sha", F.explode(F.array_distinct("push_commit_shas")))
    by_commits = listed.join(by_sha, commit).dropDuplicates(["__push", *KEY])
    by_neither = pushes.where(~has_head & ~has_commits).join(told.select(*KEY, *branch), branch)
    no_record = pushes.join(branches.where(~on_record).select(*KEY, *branch), branch)
    out = by_head.select(*columns)
    for part in (by_commits, by_neither, no_record):
        out = out.unionByName(part.select(*columns))
    return _same_bucket(out, bucket_local)


def unique_heads(kept: DataFrame, bucket_local: bool = True) -> DataFrame:
    """``(join_sha, key)`` of commits that are the head of exactly one kept pull request, in a bucket or at all."""
    by = ["repo_bucket", "sha"] if bucket_local else ["sha"]
    heads = kept.select(*KEY, F.explode("head_shas").alias("sha"))
    return heads.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct(*KEY)).alias("key")).where("n = 1").select(F.col("sha").alias("join_sha"), "key.*")


def by_commit(events: DataFrame, kept: DataFrame, bucket_local: bool = True) -> DataFrame:
    return _same_bucket(_events(events.where(is_sha())).join(unique_heads(kept, bucket_local), "join_sha"), bucket_local)


def attached(events: DataFrame, kept: DataFrame, bucket_local: bool = True) -> DataFrame:
    """Every event with every kept pull request it belongs to: key columns, and all columns of ``events`` (its own repository as ``__repo``, ``__bucket``)."""
    parts = [by_number(events, kept), by_branch(events, kept, bucket_local), by_commit(events, kept, bucket_local)]
    columns = [*KEY, "__bucket", "__repo", *[c for c in events.columns if c not in ("repo_bucket", "repo_id")]]
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out


def _narrowed(name: str) -> Column:
    """A payload struct of an event as the nested one; what that has no field for goes to its extras."""
    to = S.NESTED_EVENT[name].dataType
    source = F.col(name)
    extra_field = next((f for f in to.fieldNames() if f.endswith("_extra_json")), None)
    extra = source[extra_field]
    if name == "comment":
        moved = F.create_map(F.lit("commit_id"), source["commit_id"].cast("variant"))
        extra = F.when(F.coalesce(source["commit_id"], F.lit("")) != "", merged_json(json_map(extra), moved)).otherwise(extra)
    if name in ("check_run", "check_suite"):
        # extras of the references are JSON in JSON, not bytes
        refs = F.transform(
            source["pull_requests"],
            lambda x: F.struct(x["number"].alias("number"), x["url"].alias("url"), x["head_sha"].alias("head_sha"), F.decode(x["check_pr_ref_extra_json"], "UTF-8").alias("check_pr_ref_extra_json")),
        )
        moved = F.create_map(F.lit("pull_requests"), F.try_parse_json(F.to_json(refs, {"ignoreNullFields": "false"})))
        extra = F.when(F.size(source["pull_requests"]) > 0, merged_json(json_map(extra), moved)).otherwise(extra)
    fields = [(extra if f == extra_field else source[f]).alias(f) for f in to.fieldNames()]
    return F.when(source.isNotNull(), F.struct(*fields)).alias(name)


def nested_event(repo: str = "repo_id") -> Column:
    """An event row as element of ``events``. The helper columns are always in ``event_extra_json``, nulls included; those of the payload win."""
    variant = lambda c: F.col(c).cast("variant")
    names = ["direct_pr_number", "check_pr_numbers", "join_sha", "push_ref", "push_head", "push_commit_shas"]
    helpers = F.create_map(*[x for n in names for x in (F.lit(n), F.to_variant_object(n) if n.endswith(("numbers", "shas")) else variant(n))])
    extra = merged_json(json_map(F.col("event_extra_json")), helpers, json_map(F.col("payload_extra_json")))
    number = F.coalesce("direct_pr_number", F.col("pull_request.number"), F.col("issue.number"))
    return F.struct(
        F.col("event_id").alias("id"),
        "type",
        "created_at",
        "public",
        "actor",
        F.col(repo).alias("event_repo_id"),
        F.col("repo_name").alias("event_repo_name"),
        "action",
        number.alias("number"),
        *[_narrowed(n) for n in ("issue", "comment", "review")],
        "push",
        "status",
        *[_narrowed(n) for n in ("check_run", "check_suite")],
        extra.alias("event_extra_json"),
    )


def nested(rows: DataFrame) -> DataFrame:
    """``(key, events)``: attached rows as lists, the direct table's events first, then by time and id."""
    order = [F.col("src_rank"), F.coalesce("created_at", F.lit("")).alias("at"), F.coalesce("event_id", F.lit("")).alias("id")]
    # the event itself has maps no more and could be compared, but never decides before src_rank, time and id
    listed = rows.select(*KEY, F.struct(*order, nested_event("__repo").alias("ev")).alias("e")).groupBy(*KEY).agg(F.array_sort(F.collect_list("e")).alias("all"))
    return listed.select(*KEY, F.transform("all", lambda e: e["ev"]).alias("events"))
