"""Queries of the event engine and the SQL they are held against.

``open`` in names and SQL stands for all merged pull requests with a snapshot:
the attaching queries use these, since the quality filter leaves too few to
tell the four ways apart.
"""

from __future__ import annotations

import os
import subprocess

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lens
from .functions import coerce, text
from .functions.schemas import DIRECT_TYPES
from .operators import attach, landed, quality, snapshot
from .plans import enrich, group, shard
from .sources import sinks
from .sources.scratch import new_path

QUERIES: dict = {}
SQL: dict = {}


def _query(sql: str | None = None, lens_sql: bool = True):
    """Register a function as query, with its SQL after the CTEs of the lens."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"WITH {lens.SQL}{sql}" if lens_sql else sql
        return f

    return keep


def _events(spark: SparkSession, sf_dir: str, keep_extra: bool = False, columns: list[str] | None = None) -> DataFrame:
    return shard.events(lens.lines(spark, sf_dir), lens.BUCKETS, keep_extra, columns)


_STAGE1: dict[tuple[str, str], str] = {}


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two tables of stage 1, written once in a session, as stage 2 reads them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGE1:
        root = new_path(spark, "stage1")
        sinks.write_events(_events(spark, sf_dir), root)
        _STAGE1[key] = root
    coerce.configure(spark)
    return tuple(sinks.read_events(spark, sinks.event_table(spark, _STAGE1[key], n)) for n in ("pr_events", "other_events"))


def _open(pr: DataFrame) -> DataFrame:
    """All merged pull requests. They grow with the events, and Spark takes a few columns of so wide rows for far less than they are: joins with them are to merge, not to send them to all tasks."""
    return snapshot.snapshots(pr).where("pull_request.merged").hint("merge")


def _counted(rows: DataFrame) -> DataFrame:
    """Attached rows to counts and sorted event ids of each pull request."""
    return rows.groupBy("repo_id", F.col("pr_number").alias("pr_number")).agg(
        F.count("*").alias("n_events"), F.array_join(F.array_sort(F.collect_list("event_id")), ",").alias("event_ids")
    )


_COUNTED = "SELECT repo_id, pr::BIGINT AS pr_number, count(*) AS n_events, string_agg(eid, ',' ORDER BY eid) AS event_ids FROM {} GROUP BY repo_id, pr"


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s2_latest_snapshot(spark, sf_dir)


@_query("SELECT type, count(*) AS n FROM e GROUP BY type")
def s1_relevance_filter(spark, sf_dir):
    """Events that concern pull requests, by type."""
    return _events(spark, sf_dir, columns=["type"]).groupBy("type").agg(F.count("*").alias("n"))


@_query("SELECT ((repo_id - 75) % 7 + 7) % 7 AS repo_bucket, kind IN ('view', 'click', 'signup') AS direct, count(*) AS n FROM e GROUP BY ALL")
def s1_bucket_histogram(spark, sf_dir):
    """Buckets of negative ids too, and the split in two tables."""
    events = shard.events(lens.lines(spark, sf_dir, shift=75), 7, columns=["repo_bucket", "type"])
    return events.select(F.col("repo_bucket").cast("long").alias("repo_bucket"), F.col("type").isin(DIRECT_TYPES).alias("direct")).groupBy("repo_bucket", "direct").agg(F.count("*").alias("n"))


_VALUES = ['1', '1.9', '-1.9', '"12"', '"-12"', '"x"', "true", "null", "9223372036854775808", '"true"', "{}", "[1]", "1e3"]


@_query(
    "SELECT c.v AS v, c.i AS as_int, c.s AS as_string, c.b AS as_bool, count(*) AS n FROM raw JOIN (VALUES "
    """(0, '1', 1, NULL, NULL), (1, '1.9', 1, NULL, NULL), (2, '-1.9', -1, NULL, NULL), (3, '"12"', 12, '12', NULL), (4, '"-12"', NULL, '-12', NULL), (5, '"x"', NULL, 'x', NULL),
    (6, 'true', NULL, NULL, true), (7, 'null', NULL, NULL, NULL), (8, '9223372036854775808', NULL, NULL, NULL), (9, '"true"', NULL, 'true', NULL), (10, '{}', NULL, NULL, NULL),
    (11, '[1]', NULL, NULL, NULL), (12, '1e3', 1000, NULL, NULL)) c(id, v, i, s, b) ON raw.event_id % 13 = c.id GROUP BY ALL"""
)
def s1_strict_coercion(spark, sf_dir):
    """Values count only with the type that is asked for."""
    coerce.configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.element_at(F.array(*map(F.lit, _VALUES)), (F.col("event_id") % len(_VALUES) + 1).cast("int")).alias("v"))
    rows = rows.withColumn("j", coerce.parsed(F.concat(F.lit('{"x":'), F.col("v"), F.lit("}"))))
    return rows.select("v", coerce.bigint("j", "$.x").alias("as_int"), coerce.string("j", "$.x").alias("as_string"), coerce.boolean("j", "$.x").alias("as_bool")).groupBy("v", "as_int", "as_string", "as_bool").agg(F.count("*").alias("n"))


@_query(
    """SELECT eid AS event_id, CASE WHEN k % 10 = 0 THEN '{"zzz":' || k || '}' END AS event_extra, CASE WHEN k % 9 = 0 THEN '{"more":' || k || '}' END AS payload_extra FROM e"""
)
def s1_extra_keys(spark, sf_dir):
    """Members that no field reads."""
    events = _events(spark, sf_dir, True, ["event_id", "event_extra_json", "payload_extra_json"])
    return events.select("event_id", F.decode("event_extra_json", "UTF-8").alias("event_extra"), F.decode("payload_extra_json", "UTF-8").alias("payload_extra"))


@_query(
    """SELECT eid AS event_id, CASE WHEN kind IN ('view', 'click', 'signup') THEN pr::BIGINT END AS pr_number, array_to_string(checks, ',') AS checks,
    CASE WHEN kind = 'error' THEN sha END AS join_sha, CASE WHEN is_push THEN push_ref END AS push_ref, CASE WHEN is_push AND k % 5 <> 0 THEN sha END AS push_head,
    CASE WHEN is_push THEN 'c' || event_id END AS push_shas FROM e"""
)
def s1_join_helpers(spark, sf_dir):
    """What events are attached by."""
    columns = ["event_id", "direct_pr_number", "check_pr_numbers", "join_sha", "push_ref", "push_head", "push_commit_shas"]
    return _events(spark, sf_dir, columns=columns).select(
        "event_id", F.col("direct_pr_number").alias("pr_number"), F.array_join("check_pr_numbers", ",").alias("checks"), "join_sha", "push_ref", "push_head", F.array_join("push_commit_shas", ",").alias("push_shas")
    )


@_query("SELECT repo_id, pr::BIGINT AS pr_number, k % 3 = 0 AS merged, sha AS head_sha, 'T' || k AS title, updated_at FROM snap")
def s2_latest_snapshot(spark, sf_dir):
    """The snapshot of each pull request that changed last (A1)."""
    pr, _ = _tables(spark, sf_dir)
    snap = F.col("pull_request")
    return snapshot.snapshots(pr).select("repo_id", "pr_number", snap["merged"].alias("merged"), snap["head"]["sha"].alias("head_sha"), snap["title"].alias("title"), snap["updated_at"].alias("updated_at"))


@_query("SELECT repo_id, pr::BIGINT AS pr_number, array_to_string(participants, ',') AS participants FROM snap")
def s2_participants(spark, sf_dir):
    """Who took part (A4)."""
    pr, _ = _tables(spark, sf_dir)
    return snapshot.snapshots(pr).select("repo_id", "pr_number", F.array_join("participants", ",").alias("participants"))


@_query("SELECT repo_id, pr::BIGINT AS pr_number, array_to_string(head_refs, ',') AS head_refs, array_to_string(head_shas, ',') AS head_shas, repo_id AS head_repo_id FROM snap")
def s2_head_refs_shas(spark, sf_dir):
    """Branches and commits that were heads."""
    pr, _ = _tables(spark, sf_dir)
    return snapshot.snapshots(pr).select("repo_id", "pr_number", F.array_join("head_refs", ",").alias("head_refs"), F.array_join("head_shas", ",").alias("head_shas"), "head_repo_id")


@_query(
    """SELECT * FROM (WITH bodies AS (SELECT repo_id, pr, CASE WHEN is_pr THEN body ELSE 'Issue ' || k END AS body, CASE WHEN is_pr THEN updated_at ELSE created_at END AS told, created_at, eid FROM direct),
    first AS (SELECT *, row_number() OVER (PARTITION BY repo_id, pr, body ORDER BY created_at, eid) AS n FROM bodies)
    SELECT repo_id, pr::BIGINT AS pr_number, count(*) AS n_versions, string_agg(eid || '@' || told, ',' ORDER BY created_at, eid) AS versions
    FROM first WHERE n = 1 GROUP BY repo_id, pr HAVING count(*) > 1)""",
)
def s2_body_versions(spark, sf_dir):
    """Different bodies by first occurrence."""
    pr, _ = _tables(spark, sf_dir)
    v = F.col("pr_body_versions")
    shown = F.array_join(F.transform(v, lambda x: F.concat(x["event_id"], F.lit("@"), x["at"])), ",")
    return snapshot.body_versions(pr).select("repo_id", "pr_number", F.size(v).cast("long").alias("n_versions"), shown.alias("versions"))


@_query("SELECT repo_id, pr::BIGINT AS pr_number, base_ref, k % 20 AS changed_files, body FROM good")
def s2_quality_filter(spark, sf_dir):
    """Pull requests that are kept."""
    pr, _ = _tables(spark, sf_dir)
    snap = F.col("pull_request")
    return quality.kept(snapshot.snapshots(pr)).select("repo_id", "pr_number", snap["base"]["ref"].alias("base_ref"), snap["changed_files"].cast("int").alias("changed_files"), snap["body"].alias("body"))


@_query(_COUNTED.format("by_direct"))
def s2_attach_direct(spark, sf_dir):
    """Events with a number of their own."""
    pr, _ = _tables(spark, sf_dir)
    return _counted(attach.by_number(pr, _open(pr)))


@_query(_COUNTED.format("by_check"))
def s2_attach_check(spark, sf_dir):
    """Checks by the numbers they list."""
    pr, other = _tables(spark, sf_dir)
    return _counted(attach.by_number(other, _open(pr)))


@_query(_COUNTED.format("by_push"))
def s2_attach_push(spark, sf_dir):
    """Pushes by branch and commits."""
    pr, other = _tables(spark, sf_dir)
    return _counted(attach.by_branch(other, _open(pr)))


@_query(_COUNTED.format("by_sha"))
def s2_attach_sha_unique(spark, sf_dir):
    """Commits that are one pull request's head in a bucket."""
    pr, other = _tables(spark, sf_dir)
    return _counted(attach.by_commit(other, _open(pr)))


@_query(_COUNTED.format("cascade_"))
def s2_attach_cascade(spark, sf_dir):
    """The first way that yields a candidate."""
    pr, other = _tables(spark, sf_dir)
    return _counted(attach.attached(pr.unionByName(other), _open(pr)))


@_query("SELECT repo_id, pr::BIGINT AS pr_number, array_to_string(shas, ',') AS shas FROM landed")
def s2_landed_inference(spark, sf_dir):
    """Commits of merged pull requests without merge commit, from all pushes."""
    pr, other = _tables(spark, sf_dir)
    found = landed.with_landed(snapshot.snapshots(pr), pr.unionByName(other)).where("landed_inferred")
    return found.select("repo_id", "pr_number", F.array_join("landed_commit_shas", ",").alias("shas"))


_ROWS = """, picked AS (SELECT g.repo_id, g.pr, g.k, l.shas FROM good g JOIN landed l USING (repo_id, pr)),
    attached AS (SELECT c.* FROM cascade_ c JOIN picked USING (repo_id, pr)),
    kept_heads AS (SELECT p.repo_id, p.pr, s.bucket, unnest(s.head_shas) AS sha FROM picked p JOIN snap s USING (repo_id, pr)),
    own_sha AS (SELECT bucket, sha, min(repo_id) AS repo_id, min(pr) AS pr FROM kept_heads GROUP BY bucket, sha HAVING count(*) = 1),
    all_events AS (
        SELECT repo_id, pr, eid, created_at, src FROM by_direct UNION ALL SELECT repo_id, pr, eid, created_at, src FROM by_check
        UNION ALL SELECT repo_id, pr, eid, created_at, src FROM by_push
        UNION ALL SELECT h.repo_id, h.pr, s.eid, s.created_at, 1 FROM e s JOIN own_sha h ON h.sha = s.sha AND h.bucket = s.bucket WHERE s.kind = 'error' AND s.checks IS NULL
    ),
    listed AS (SELECT repo_id, pr, count(*) AS n, string_agg(eid, ',' ORDER BY src, created_at, eid) AS ids FROM all_events GROUP BY repo_id, pr)"""


@_query(
    _ROWS + """ SELECT p.repo_id, p.pr::BIGINT AS pr_number, 'T' || p.k AS title, array_to_string(p.shas, ',') AS landed_shas, p.shas[1] AS landed_sha, coalesce(l.n, 0) AS n_events, coalesce(l.ids, '') AS event_ids
    FROM picked p LEFT JOIN listed l USING (repo_id, pr)"""
)
def s2_pr_rows(spark, sf_dir):
    """All of stage 2, with inference from all pushes."""
    pr, other = _tables(spark, sf_dir)
    rows = group.pull_request_rows(pr, other, inference_source="all")
    return rows.select(
        "repo_id",
        "pr_number",
        F.col("pull_request.title").alias("title"),
        F.array_join("landed_commit_shas", ",").alias("landed_shas"),
        F.col("landed_commit_sha").alias("landed_sha"),
        F.size("events").cast("long").alias("n_events"),
        F.array_join(F.transform("events", lambda x: x["id"]), ",").alias("event_ids"),
    )


@_query("SELECT (SELECT count(*) FROM raw) AS lines, 0::BIGINT AS bad_lines, count(*) AS events_kept, count(*) FILTER (kind IN ('view', 'click', 'signup')) AS kept_pr, count(*) FILTER (kind NOT IN ('view', 'click', 'signup')) AS kept_other FROM e")
def s1_stats(spark, sf_dir):
    """Counts of stage 1."""
    return shard.statistics(lens.lines(spark, sf_dir), _events(spark, sf_dir, columns=["type"]))


@_query(
    """SELECT (SELECT count(*) FROM e) AS events_seen, (SELECT count(*) FROM open) AS prs_kept, 0::BIGINT AS inferred_used, count(*) AS attachments, count(DISTINCT eid) AS events_attached FROM cascade_"""
)
def s2_stats(spark, sf_dir):
    """Counts of stage 2."""
    pr, other = _tables(spark, sf_dir)
    events = pr.withColumn("src_rank", F.lit(0)).unionByName(other.withColumn("src_rank", F.lit(1)))
    kept = _open(pr).withColumn("landed_inferred", F.lit(False))
    return group.statistics(events, kept, attach.attached(events, kept))


@_query(
    _ROWS + """ SELECT p.repo_id, p.pr::BIGINT AS pr_number, count(d.eid)::INTEGER AS discussion_event_count
    FROM picked p LEFT JOIN by_direct d USING (repo_id, pr) GROUP BY ALL"""
)
def s3_discussion_count(spark, sf_dir):
    """Nested events of the types that carry a number."""
    pr, other = _tables(spark, sf_dir)
    rows = group.pull_request_rows(pr, other, inference_source="all")
    return rows.select("repo_id", "pr_number", enrich.discussion_count(F.col("events")).alias("discussion_event_count"))


@_query(
    _ROWS + """ SELECT p.repo_id, p.pr::BIGINT AS pr_number, 'r/' || p.repo_id AS repo, md5('b' || p.repo_id) AS base_sha, s.sha AS head_sha, 'https://github.com/r/' || p.repo_id || '.git' AS clone_url,
    'r__' || p.repo_id AS safe FROM picked p JOIN snap s USING (repo_id, pr)"""
)
def s3_extract_fields(spark, sf_dir):
    """What stage 3 reads of a row."""
    pr, other = _tables(spark, sf_dir)
    rows = group.pull_request_rows(pr, other, inference_source="all")
    w = enrich.wanted(rows)
    return rows.select("repo_id", "pr_number", w["repo"].alias("repo"), w["base"].alias("base_sha"), w["head"].alias("head_sha"), text.clone_url(w["repo"]).alias("clone_url"), text.path_safe(w["repo"]).alias("safe"))


@_query("SELECT event_id, CASE WHEN k % 2 = 0 THEN 'https://***:***@h.example/r' || k ELSE 'https://h.example/r' || k END AS url FROM raw")
def s3_redact_url(spark, sf_dir):
    """URLs without user and password."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    url = F.when(F.col("k") % 2 == 0, F.concat(F.lit("https://me:secret@h.example/r"), F.col("k").cast("string"))).otherwise(F.concat(F.lit("https://h.example/r"), F.col("k").cast("string")))
    return rows.select("event_id", text.redacted_url(url).alias("url"))


@_query(
    r"SELECT doc_id, (octet_length(encode(text)) > 1000)::BOOLEAN AS truncated, length(replace(replace(substr(regexp_replace(text, '[^\x01-\x7F]', '?', 'g'), 1, 1000), chr(10), ' '), chr(9), ' '))::INTEGER AS n, "
    "least(len(string_split(text, chr(10))), 3)::INTEGER AS n_lines, len(string_split(text, chr(10))) > 3 AS lines_truncated FROM documents",
    lens_sql=False,
)
def s3_truncate(spark, sf_dir):
    """Byte and item caps over whole documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain, _ = text.capped(F.regexp_replace("text", r"[^\x01-\x7F]", "?").cast("binary"), 1000)
    _, cut = text.capped(F.col("text").cast("binary"), 1000)
    some, more = text.limited(F.split("text", "\n", -1), 3)
    return docs.select("doc_id", cut.alias("truncated"), F.length(plain).alias("n"), F.size(some).alias("n_lines"), more.alias("lines_truncated"))


@_query("SELECT s.repo_id, s.pr::BIGINT AS pr_number FROM snap s WHERE NOT EXISTS (SELECT 1 FROM snap d WHERE d.repo_id = s.repo_id AND d.pr = s.pr AND d.k % 2 = 0)")
def s3_resume_antijoin(spark, sf_dir):
    """Rows that an earlier run has not written (K7)."""
    pr, _ = _tables(spark, sf_dir)
    rows = snapshot.snapshots(pr).select("repo_id", "pr_number", F.col("pull_request.title").alias("title"))
    done = rows.where(F.substring("title", 2, 9).cast("int") % 2 == 0)
    return sinks.remaining(rows, done).select("repo_id", "pr_number")


def _repository(path: str) -> tuple[str, str]:
    """A repository of three commits, the last as head of pull requests 0 to 9; the SHAs of the first and the last."""
    os.makedirs(path)
    env = os.environ | {"GIT_AUTHOR_NAME": "a", "GIT_AUTHOR_EMAIL": "a@example.com", "GIT_COMMITTER_NAME": "a", "GIT_COMMITTER_EMAIL": "a@example.com"}
    run = lambda *a: subprocess.run(["git", "-C", path, *a], check=True, capture_output=True, env=env).stdout.decode().strip()
    run("init", "-q", "-b", "main")
    run("config", "uploadpack.allowFilter", "true")
    run("config", "uploadpack.allowAnySHA1InWant", "true")
    shas = []
    for n, (name, content) in enumerate((("a.txt", "one\n"), ("a.txt", "one\ntwo\n"), ("dir/b.txt", "three\n"))):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "w") as f:
            f.write(content)
        run("add", "-A")
        run("commit", "-q", "-m", f"commit {n}")
        shas.append(run("rev-parse", "HEAD"))
    for n in range(10):
        run("update-ref", f"refs/pull/{n}/head", shas[-1])
    return shas[0], shas[-1]
