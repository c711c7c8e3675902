"""Schemas of the three tables, and the key sets that JSON objects are read by.

Fixed values: the tables must have these names, types and orders of fields to be
exchangeable, and events these types. ``*_extra_json`` holds JSON text.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BIGINT, INT, BOOLEAN, BINARY = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.BinaryType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


USER = _struct(
    login=STRING,
    id=BIGINT,
    url=STRING,
    html_url=STRING,
    avatar_url=STRING,
    type=STRING,
    site_admin=BOOLEAN,
    user_extra_json=BINARY,
)

LABEL = _struct(
    id=BIGINT,
    node_id=STRING,
    url=STRING,
    name=STRING,
    color=STRING,
    default=BOOLEAN,
    description=STRING,
    label_extra_json=BINARY,
)

MILESTONE = _struct(
    id=BIGINT,
    node_id=STRING,
    number=BIGINT,
    title=STRING,
    description=STRING,
    state=STRING,
    html_url=STRING,
    created_at=STRING,
    updated_at=STRING,
    due_on=STRING,
    closed_at=STRING,
    creator=USER,
    milestone_extra_json=BINARY,
)

LICENSE = _struct(
    key=STRING,
    name=STRING,
    spdx_id=STRING,
    url=STRING,
    node_id=STRING,
    license_extra_json=BINARY,
)

REPO = _struct(
    id=BIGINT,
    node_id=STRING,
    name=STRING,
    full_name=STRING,
    private=BOOLEAN,
    fork=BOOLEAN,
    archived=BOOLEAN,
    disabled=BOOLEAN,
    description=STRING,
    homepage=STRING,
    language=STRING,
    default_branch=STRING,
    html_url=STRING,
    url=STRING,
    created_at=STRING,
    updated_at=STRING,
    pushed_at=STRING,
    size=BIGINT,
    stargazers_count=BIGINT,
    watchers_count=BIGINT,
    forks_count=BIGINT,
    open_issues_count=BIGINT,
    has_issues=BOOLEAN,
    has_projects=BOOLEAN,
    has_downloads=BOOLEAN,
    has_wiki=BOOLEAN,
    has_pages=BOOLEAN,
    license=LICENSE,
    owner=USER,
    repo_extra_json=BINARY,
)

REF = _struct(
    label=STRING,
    ref=STRING,
    sha=STRING,
    user=USER,
    repo=REPO,
    ref_extra_json=BINARY,
)

PULL_REQUEST = _struct(
    id=BIGINT,
    node_id=STRING,
    number=BIGINT,
    state=STRING,
    title=STRING,
    body=STRING,
    draft=BOOLEAN,
    locked=BOOLEAN,
    html_url=STRING,
    url=STRING,
    comments_url=STRING,
    review_comments_url=STRING,
    commits_url=STRING,
    statuses_url=STRING,
    created_at=STRING,
    updated_at=STRING,
    closed_at=STRING,
    merged_at=STRING,
    merge_commit_sha=STRING,
    merged=BOOLEAN,
    author_association=STRING,
    user=USER,
    labels=T.ArrayType(LABEL),
    assignees=T.ArrayType(USER),
    requested_reviewers=T.ArrayType(USER),
    milestone=MILESTONE,
    additions=BIGINT,
    deletions=BIGINT,
    changed_files=BIGINT,
    commits=BIGINT,
    comments=BIGINT,
    review_comments=BIGINT,
    base=REF,
    head=REF,
    pr_extra_json=BINARY,
)

ISSUE = _struct(
    id=BIGINT,
    number=BIGINT,
    state=STRING,
    title=STRING,
    body=STRING,
    html_url=STRING,
    updated_at=STRING,
    issue_extra_json=BINARY,
)

COMMENT = _struct(
    id=BIGINT,
    html_url=STRING,
    url=STRING,
    created_at=STRING,
    updated_at=STRING,
    author_association=STRING,
    body=STRING,
    commit_id=STRING,
    user=USER,
    comment_extra_json=BINARY,
)

REVIEW = _struct(
    id=BIGINT,
    state=STRING,
    submitted_at=STRING,
    body=STRING,
    html_url=STRING,
    user=USER,
    review_extra_json=BINARY,
)

AUTHOR = _struct(
    name=STRING,
    email=STRING,
    username=STRING,
    author_extra_json=BINARY,
)

COMMIT = _struct(
    sha=STRING,
    message=STRING,
    url=STRING,
    distinct=BOOLEAN,
    author=AUTHOR,
    commit_extra_json=BINARY,
)

PUSH = _struct(
    ref=STRING,
    before=STRING,
    head=STRING,
    size=BIGINT,
    distinct_size=BIGINT,
    commits=T.ArrayType(COMMIT),
    push_extra_json=BINARY,
)

STATUS = _struct(
    sha=STRING,
    state=STRING,
    context=STRING,
    description=STRING,
    target_url=STRING,
    status_extra_json=BINARY,
)

CHECK_PR = _struct(
    number=BIGINT,
    url=STRING,
    head_sha=STRING,
    check_pr_ref_extra_json=BINARY,
)

CHECK_RUN = _struct(
    id=BIGINT,
    name=STRING,
    status=STRING,
    conclusion=STRING,
    head_sha=STRING,
    details_url=STRING,
    external_id=STRING,
    pull_requests=T.ArrayType(CHECK_PR),
    check_run_extra_json=BINARY,
)

CHECK_SUITE = _struct(
    id=BIGINT,
    status=STRING,
    conclusion=STRING,
    head_sha=STRING,
    pull_requests=T.ArrayType(CHECK_PR),
    check_suite_extra_json=BINARY,
)

EVENT = _struct(
    repo_bucket=INT,
    repo_id=BIGINT,
    repo_name=STRING,
    event_id=STRING,
    type=STRING,
    created_at=STRING,
    public=BOOLEAN,
    actor=USER,
    direct_pr_number=BIGINT,
    check_pr_numbers=T.ArrayType(BIGINT),
    join_sha=STRING,
    push_ref=STRING,
    push_head=STRING,
    push_commit_shas=T.ArrayType(STRING),
    action=STRING,
    pull_request=PULL_REQUEST,
    issue=ISSUE,
    comment=COMMENT,
    review=REVIEW,
    push=PUSH,
    status=STATUS,
    check_run=CHECK_RUN,
    check_suite=CHECK_SUITE,
    event_extra_json=BINARY,
    payload_extra_json=BINARY,
)

PR_ISSUE = _struct(
    number=BIGINT,
    state=STRING,
    title=STRING,
    html_url=STRING,
    updated_at=STRING,
    issue_extra_json=BINARY,
)

PR_COMMENT = _struct(
    id=BIGINT,
    html_url=STRING,
    url=STRING,
    created_at=STRING,
    updated_at=STRING,
    author_association=STRING,
    body=STRING,
    user=USER,
    comment_extra_json=BINARY,
)

PR_CHECK_RUN = _struct(
    id=BIGINT,
    name=STRING,
    status=STRING,
    conclusion=STRING,
    head_sha=STRING,
    details_url=STRING,
    external_id=STRING,
    check_run_extra_json=BINARY,
)

PR_CHECK_SUITE = _struct(
    id=BIGINT,
    status=STRING,
    conclusion=STRING,
    head_sha=STRING,
    check_suite_extra_json=BINARY,
)

NESTED_EVENT = _struct(
    id=STRING,
    type=STRING,
    created_at=STRING,
    public=BOOLEAN,
    actor=USER,
    event_repo_id=BIGINT,
    event_repo_name=STRING,
    action=STRING,
    number=BIGINT,
    issue=PR_ISSUE,
    comment=PR_COMMENT,
    review=REVIEW,
    push=PUSH,
    status=STATUS,
    check_run=PR_CHECK_RUN,
    check_suite=PR_CHECK_SUITE,
    event_extra_json=BINARY,
)

PR_LABEL = _struct(
    id=BIGINT,
    node_id=STRING,
    url=STRING,
    name=STRING,
    color=STRING,
    default=BOOLEAN,
    description=STRING,
)

PR_LICENSE = _struct(
    key=STRING,
    name=STRING,
    spdx_id=STRING,
    url=STRING,
    node_id=STRING,
)

PR_REPO = _struct(
    id=BIGINT,
    node_id=STRING,
    name=STRING,
    full_name=STRING,
    private=BOOLEAN,
    fork=BOOLEAN,
    archived=BOOLEAN,
    disabled=BOOLEAN,
    description=STRING,
    homepage=STRING,
    language=STRING,
    default_branch=STRING,
    html_url=STRING,
    url=STRING,
    created_at=STRING,
    updated_at=STRING,
    pushed_at=STRING,
    size=BIGINT,
    stargazers_count=BIGINT,
    watchers_count=BIGINT,
    forks_count=BIGINT,
    open_issues_count=BIGINT,
    has_issues=BOOLEAN,
    has_projects=BOOLEAN,
    has_downloads=BOOLEAN,
    has_wiki=BOOLEAN,
    has_pages=BOOLEAN,
    license=PR_LICENSE,
    owner=USER,
    repo_extra_json=BINARY,
)

PR_REF = _struct(
    label=STRING,
    ref=STRING,
    sha=STRING,
    user=USER,
    repo=PR_REPO,
    ref_extra_json=BINARY,
)

PR_PULL_REQUEST = _struct(
    id=BIGINT,
    node_id=STRING,
    number=BIGINT,
    state=STRING,
    title=STRING,
    body=STRING,
    draft=BOOLEAN,
    locked=BOOLEAN,
    html_url=STRING,
    url=STRING,
    comments_url=STRING,
    review_comments_url=STRING,
    commits_url=STRING,
    statuses_url=STRING,
    created_at=STRING,
    updated_at=STRING,
    closed_at=STRING,
    merged_at=STRING,
    merge_commit_sha=STRING,
    merged=BOOLEAN,
    mergeable=BOOLEAN,
    rebaseable=BOOLEAN,
    mergeable_state=STRING,
    merged_by=USER,
    author_association=STRING,
    user=USER,
    labels=T.ArrayType(PR_LABEL),
    assignees=T.ArrayType(USER),
    requested_reviewers=T.ArrayType(USER),
    milestone=MILESTONE,
    additions=BIGINT,
    deletions=BIGINT,
    changed_files=BIGINT,
    commits=BIGINT,
    comments=BIGINT,
    review_comments=BIGINT,
    base=PR_REF,
    head=PR_REF,
    pr_extra_json=BINARY,
)

BODY_VERSION = _struct(
    source=STRING,
    at=STRING,
    event_id=STRING,
    body=STRING,
)

PR_ROW = _struct(
    repo_id=BIGINT,
    pr_number=BIGINT,
    pull_request=PR_PULL_REQUEST,
    participants=T.ArrayType(STRING),
    head_refs=T.ArrayType(STRING),
    head_shas=T.ArrayType(STRING),
    landed_commit_sha=STRING,
    landed_commit_shas=T.ArrayType(STRING),
    landed_inferred=BOOLEAN,
    pr_body_versions=T.ArrayType(BODY_VERSION),
    events=T.ArrayType(NESTED_EVENT),
)

CODE_COMMIT = _struct(
    sha=STRING,
    subject=STRING,
    patch=STRING,
    patch_truncated=BOOLEAN,
)

FILE = _struct(
    path=STRING,
    blob_sha=STRING,
    size=BIGINT,
    content=STRING,
    content_truncated=BOOLEAN,
    error=STRING,
)

DEBUG = _struct(
    extract_repo_full_name=STRING,
    extract_clone_url=STRING,
    extract_pr_number=BIGINT,
    extract_base_sha=STRING,
    extract_head_sha=STRING,
    repo_dir=STRING,
    git_error=STRING,
    git_stderr_tail=STRING,
)

CODE = _struct(
    status=STRING,
    reason=STRING,
    repo_full_name=STRING,
    pr_number=BIGINT,
    base_sha=STRING,
    head_sha=STRING,
    merge_base=STRING,
    used_base_sha=STRING,
    used_head_sha=STRING,
    discussion_event_count=INT,
    touched_files=T.ArrayType(STRING),
    touched_files_truncated=BOOLEAN,
    repo_files_at_base=T.ArrayType(STRING),
    repo_files_at_base_truncated=BOOLEAN,
    compare_diff=STRING,
    compare_diff_truncated=BOOLEAN,
    commit_count=INT,
    commits_truncated=BOOLEAN,
    commits=T.ArrayType(CODE_COMMIT),
    base_files_at_base=T.ArrayType(FILE),
    base_files_at_base_truncated=BOOLEAN,
    debug=DEBUG,
)


#: Structs that payloads are read as.
PAYLOADS = {
    "user": USER, "pull_request": PULL_REQUEST, "issue": ISSUE, "comment": COMMENT, "review": REVIEW, "push": PUSH, "status": STATUS, "check_run": CHECK_RUN,
    "check_suite": CHECK_SUITE,
}


def event_struct(name: str) -> T.StructType:
    """A struct of the event table, such as "pull_request"."""
    return PAYLOADS[name]


#: Event types.
DIRECT_TYPES = ["PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent", "IssueCommentEvent"]
CHECK_RUN_TYPES = ["CheckRunEvent", "check_run"]
CHECK_SUITE_TYPES = ["CheckSuiteEvent", "check_suite"]
STATUS_TYPES = ["StatusEvent", "status"]
CHECK_TYPES = CHECK_RUN_TYPES + CHECK_SUITE_TYPES
SHA_TYPES = ["CommitCommentEvent", *STATUS_TYPES, *CHECK_TYPES]
PR_TYPES = [*DIRECT_TYPES, *SHA_TYPES, "PushEvent"]

#: Keys of an object that are not "extra" although no field holds them, and those of events and payloads.
SILENT_KEYS = {"issue": ["pull_request"], "push": ["push_id"]}
EVENT_KEYS = ["id", "type", "actor", "repo", "repo_id", "repo_name", "created_at", "public", "payload", "org"]
PAYLOAD_KEYS = [
    "action", "number", "pull_request", "issue", "comment", "review", "check_run", "check_suite", "sha", "state", "context", "description", "target_url", "ref",
    "before", "head", "size", "distinct_size", "commits", "push_id",
]
