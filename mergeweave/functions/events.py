"""From a parsed line (variant column ``v``) to a typed event row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from . import schemas as S
from .coerce import at, bigint, boolean, extras, is_object, listed, parsed_once, project, string

#: JSON of payloads that count as ``{}``.
_EMPTY = ['""', "0", "0.0", "-0.0", "false", "[]"]
V = "v"


def relevant() -> Column:
    """Types that concern pull requests; of issue comments those whose issue has the key ``pull_request``, even with null."""
    comment = at(F.col(V), "$.payload.issue.pull_request").isNotNull()
    return F.coalesce(F.col("type").isin(S.PR_TYPES) & ((F.col("type") != "IssueCommentEvent") | comment), F.lit(False))


def has_payload_object() -> Column:
    """Whether the payload is an object, or missing, null or empty, which count as ``{}``."""
    payload = at(F.col(V), "$.payload")
    return payload.isNull() | is_object(payload) | F.is_variant_null(payload) | F.to_json(payload).isin(_EMPTY)


def repo_id() -> Column:
    return F.coalesce(bigint(V, "$.repo.id"), bigint(V, "$.repo_id"))


def repo_name() -> Column:
    return F.coalesce(string(V, "$.repo.name"), string(V, "$.repo_name"))


def bucket(repo: Column, buckets: int) -> Column:
    """Never negative."""
    return F.pmod(repo, F.lit(buckets)).cast("int")


def direct_pr_number() -> Column:
    t = F.col("type")
    return (
        F.when(t == "PullRequestEvent", bigint(V, "$.payload.number"))
        .when(t.isin("PullRequestReviewEvent", "PullRequestReviewCommentEvent"), bigint(V, "$.payload.pull_request.number"))
        .when((t == "IssueCommentEvent") & at(F.col(V), "$.payload.issue.pull_request").isNotNull(), bigint(V, "$.payload.issue.number"))
    )


def _unique(items: Column) -> Column:
    """Distinct in order of first occurrence; null if none is left."""
    found = F.array_distinct(F.filter(items, lambda x: x.isNotNull()))
    return F.when(F.size(found) > 0, found)


def check_pr_numbers() -> Column:
    t = F.col("type")
    numbers = lambda path: _unique(listed(V, path, "$.number", "bigint"))
    return F.when(t.isin(S.CHECK_RUN_TYPES), numbers("$.payload.check_run.pull_requests")).when(t.isin(S.CHECK_SUITE_TYPES), numbers("$.payload.check_suite.pull_requests"))


def join_sha() -> Column:
    t = F.col("type")
    return (
        F.when(t == "CommitCommentEvent", string(V, "$.payload.comment.commit_id"))
        .when(t.isin(S.STATUS_TYPES), string(V, "$.payload.sha"))
        .when(t.isin(S.CHECK_RUN_TYPES), string(V, "$.payload.check_run.head_sha"))
        .when(t.isin(S.CHECK_SUITE_TYPES), string(V, "$.payload.check_suite.head_sha"))
    )


def push_helpers() -> tuple[Column, Column, Column]:
    """Ref, head and distinct non-empty commit SHAs of a push."""
    push = F.col("type") == "PushEvent"
    shas = _unique(F.transform(listed(V, "$.payload.commits", "$.sha", "string"), lambda s: F.nullif(s, F.lit(""))))
    return F.when(push, string(V, "$.payload.ref")), F.when(push, string(V, "$.payload.head")), F.when(push, shas)


def normalized(lines: DataFrame, buckets: int, keep_extra: bool = False, columns: list[str] | None = None, seen: Observation | None = None) -> DataFrame:
    """Typed rows of the relevant events among JSON lines; the filters read few paths and come before the wide projection.

    Lines that are blank, malformed or no objects give no row, as do events
    without repository id. columns: those of the event table that are wanted;
    others aren't even analysed. seen: observes lines and malformed ones.
    """
    rows = parsed_once(lines, "value", V, seen)
    rows = rows.withColumn("type", string(V, "$.type")).where(relevant() & has_payload_object()).withColumn("repo_id", repo_id()).where("repo_id is not null")

    def payload(path: str, types: list[str], struct: str) -> Column:
        return F.when(F.col("type").isin(types), project(V, path, S.event_struct(struct), keep_extra, S.SILENT_KEYS.get(struct)))

    snapshots = ["PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent"]
    comments = ["PullRequestReviewCommentEvent", "IssueCommentEvent", "CommitCommentEvent"]
    made = {
        "repo_bucket": lambda: bucket(F.col("repo_id"), buckets),
        "repo_id": lambda: F.col("repo_id"),
        "repo_name": repo_name,
        "event_id": lambda: string(V, "$.id"),
        "type": lambda: F.col("type"),
        "created_at": lambda: string(V, "$.created_at"),
        "public": lambda: boolean(V, "$.public"),
        "actor": lambda: project(V, "$.actor", S.event_struct("user"), keep_extra),
        "direct_pr_number": direct_pr_number,
        "check_pr_numbers": check_pr_numbers,
        "join_sha": join_sha,
        "push_ref": lambda: push_helpers()[0],
        "push_head": lambda: push_helpers()[1],
        "push_commit_shas": lambda: push_helpers()[2],
        "action": lambda: string(V, "$.payload.action"),
        "pull_request": lambda: payload("$.payload.pull_request", snapshots, "pull_request"),
        "issue": lambda: payload("$.payload.issue", ["IssueCommentEvent"], "issue"),
        "comment": lambda: payload("$.payload.comment", comments, "comment"),
        "review": lambda: payload("$.payload.review", ["PullRequestReviewEvent"], "review"),
        "push": lambda: payload("$.payload", ["PushEvent"], "push"),
        "status": lambda: payload("$.payload", S.STATUS_TYPES, "status"),
        "check_run": lambda: payload("$.payload.check_run", S.CHECK_RUN_TYPES, "check_run"),
        "check_suite": lambda: payload("$.payload.check_suite", S.CHECK_SUITE_TYPES, "check_suite"),
        "event_extra_json": lambda: extras(V, "$", S.EVENT_KEYS, keep_extra),
        "payload_extra_json": lambda: extras(V, "$.payload", S.PAYLOAD_KEYS, keep_extra),
    }
    return rows.select(*[made[c]().alias(c) for c in columns or S.EVENT.fieldNames()])
