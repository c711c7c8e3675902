"""Archive events made of the table ``events``: the same arithmetic as JSON lines and as SQL.

The JSON goes through the real parsing and operators; the SQL states the answer
from the table's own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


def lines(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """``value``: a JSON line for each event; ``shift`` is taken from repository ids."""
    # the table is a single row group, archives are many files
    e = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(spark.sparkContext.defaultParallelism)
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.withColumn("k", k).withColumn("repo", F.col("user_id") - shift).withColumn("pr", F.col("k") % 5)
    kind = F.col("event_type")
    k = F.col("k")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    branch = F.when(k % 4 == 0, "main").when(k % 4 == 1, "master").when(k % 4 == 2, "main").otherwise("dev")
    sha = F.md5(text(F.col("user_id") % 40, "-", k % 15, "-", k % 4))
    body = text("This change fixes #", k, F.when(k % 2 == 0, text(" and #", k + 1)).otherwise(""), F.when(k % 11 == 0, " Bump x").otherwise(""))
    is_pr = kind.isin("view", "click")
    pr = F.struct(
        F.col("pr").alias("number"),
        text("T", k).alias("title"),
        body.alias("body"),
        (k % 3 == 0).alias("merged"),
        F.when(k % 6 == 0, text("m", k)).alias("merge_commit_sha"),
        F.date_format("ts", "yyyy-MM-dd'T'00:00:00'Z'").alias("updated_at"),
        (k % 20).alias("changed_files"),
        F.struct(branch.alias("ref"), F.md5(text("b", F.col("user_id"))).alias("sha"), F.struct(F.col("repo").alias("id"), text("r/", F.col("repo")).alias("full_name")).alias("repo")).alias("base"),
        F.struct(text("f", k % 4).alias("ref"), sha.alias("sha"), F.struct(F.col("repo").alias("id")).alias("repo")).alias("head"),
    )
    number = lambda c: F.struct(c.alias("number"))
    payload = F.struct(
        F.lit("done").alias("action"),
        F.when(kind == "view", F.col("pr")).alias("number"),
        F.when(is_pr, pr).alias("pull_request"),
        F.when(kind == "signup", F.struct(F.col("pr").alias("number"), text("Issue ", k).alias("body"), F.when(k % 4 != 0, F.struct(F.lit("x").alias("url"))).alias("pull_request"))).alias("issue"),
        F.when(kind == "signup", F.struct(k.alias("id"), text("Comment ", k).alias("body"))).alias("comment"),
        F.when(kind == "purchase", F.when(k % 4 == 0, "refs/heads/main").when(k % 4 == 2, "refs/heads/master").otherwise(text("refs/heads/f", k % 4))).alias("ref"),
        F.when((kind == "purchase") & (k % 5 != 0), sha).alias("head"),
        F.when(kind == "purchase", F.array(F.struct(text("c", F.col("event_id")).alias("sha"), text("Fix #", F.col("pr")).alias("message"), F.struct(text("u", k % 7).alias("name")).alias("author")))).alias("commits"),
        F.when((kind == "error") & (k % 2 == 0), F.struct(k.alias("id"), sha.alias("head_sha"), F.when(k % 3 == 0, F.array(number(F.col("pr")), number(k % 3), number(F.col("pr")))).otherwise(F.array().cast("array<struct<number:int>>")).alias("pull_requests"))).alias("check_run"),
        F.when((kind == "error") & (k % 2 == 1), sha).alias("sha"),
        F.when(k % 9 == 0, k).alias("more"),
    )
    name = F.when(kind == "view", "PullRequestEvent").when(kind == "click", "PullRequestReviewEvent").when(kind == "signup", "IssueCommentEvent").when(kind == "purchase", "PushEvent").when(k % 2 == 0, "CheckRunEvent").otherwise("StatusEvent")
    event = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(k % 50 == 49, "WatchEvent").otherwise(name).alias("type"),
        F.struct(F.col("repo").alias("id"), text("r/", F.col("repo")).alias("name")).alias("repo"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.lit(True).alias("public"),
        F.struct(text("u", k % 7).alias("login"), (k % 7).alias("id")).alias("actor"),
        payload.alias("payload"),
        F.when(k % 10 == 0, k).alias("zzz"),
    )
    return e.select(F.to_json(event).alias("value"))


#: One row for each relevant event, as CTE ``e``.
SQL = """
raw AS (
    SELECT event_id, event_id::VARCHAR AS eid, user_id, user_id AS repo_id, event_type AS kind, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
e AS (
    SELECT *, k % 5 AS pr, repo_id % 16 AS bucket, 'u' || (k % 7) AS login,
        CASE kind WHEN 'view' THEN 'PullRequestEvent' WHEN 'click' THEN 'PullRequestReviewEvent' WHEN 'signup' THEN 'IssueCommentEvent'
            WHEN 'purchase' THEN 'PushEvent' ELSE CASE WHEN k % 2 = 0 THEN 'CheckRunEvent' ELSE 'StatusEvent' END END AS type,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at, strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' AS updated_at,
        md5((user_id % 40) || '-' || (k % 15) || '-' || (k % 4)) AS sha,
        CASE k % 4 WHEN 0 THEN 'main' WHEN 1 THEN 'master' WHEN 2 THEN 'main' ELSE 'dev' END AS base_ref,
        'This change fixes #' || k || CASE WHEN k % 2 = 0 THEN ' and #' || (k + 1) ELSE '' END || CASE WHEN k % 11 = 0 THEN ' Bump x' ELSE '' END AS body,
        kind IN ('view', 'click') AS is_pr, kind = 'purchase' AS is_push,
        CASE k % 4 WHEN 0 THEN 'refs/heads/main' WHEN 2 THEN 'refs/heads/master' ELSE 'refs/heads/f' || (k % 4) END AS push_ref,
        CASE WHEN kind = 'error' AND k % 2 = 0 AND k % 3 = 0 THEN CASE WHEN k % 5 = 0 THEN [0] ELSE [k % 5, 0] END END AS checks
    FROM raw WHERE k % 50 <> 49 AND NOT (kind = 'signup' AND k % 4 = 0)
),
direct AS (SELECT * FROM e WHERE kind IN ('view', 'click', 'signup')),
latest AS (SELECT repo_id, pr, arg_max(event_id, row(updated_at, created_at, eid)) AS event_id FROM direct WHERE is_pr GROUP BY ALL),
gathered AS (
    SELECT repo_id, pr, list(DISTINCT login ORDER BY login) AS participants,
        coalesce(list(DISTINCT 'refs/heads/f' || (k % 4) ORDER BY 'refs/heads/f' || (k % 4)) FILTER (is_pr), []) AS head_refs,
        coalesce(list(DISTINCT sha ORDER BY sha) FILTER (is_pr), []) AS head_shas
    FROM direct GROUP BY ALL
),
snap AS (
    SELECT e.repo_id, e.pr, e.bucket, e.k, e.sha, e.base_ref, e.body, e.updated_at, g.participants, g.head_refs, g.head_shas
    FROM latest l JOIN e USING (event_id) JOIN gathered g ON g.repo_id = e.repo_id AND g.pr = e.pr
),
landed AS (
    SELECT s.repo_id, s.pr, list('c' || p.event_id ORDER BY p.created_at, p.eid) AS shas
    FROM snap s JOIN e p ON p.is_push AND p.repo_id = s.repo_id AND p.push_ref = 'refs/heads/' || s.base_ref
    WHERE s.k % 3 = 0 AND s.k % 6 <> 0 AND (contains('fix #' || p.pr, '#' || s.pr) OR list_contains(s.participants, p.login))
    GROUP BY ALL
),
good AS (
    SELECT * FROM snap
    WHERE k % 3 = 0 AND base_ref IN ('main', 'master') AND length(body) > 10 AND k % 20 BETWEEN 1 AND 15 AND NOT contains(lower(body), 'bump') AND k % 2 = 1
),
inferred AS (SELECT g.*, l.shas FROM good g JOIN landed l USING (repo_id, pr)),
open AS (SELECT * FROM snap WHERE k % 3 = 0),
by_direct AS (SELECT p.repo_id, p.pr, d.eid, d.created_at, 0 AS src FROM open p JOIN direct d USING (repo_id, pr)),
by_check AS (
    SELECT p.repo_id, p.pr, c.eid, c.created_at, 1 AS src
    FROM (SELECT *, unnest(checks) AS number FROM e WHERE checks IS NOT NULL) c JOIN open p ON p.repo_id = c.repo_id AND p.pr = c.number
),
by_push AS (
    SELECT p.repo_id, p.pr, u.eid, u.created_at, 1 AS src
    FROM e u JOIN open p ON u.is_push AND p.repo_id = u.repo_id AND list_contains(p.head_refs, u.push_ref)
    WHERE CASE WHEN u.k % 5 <> 0 THEN list_contains(p.head_shas, u.sha) ELSE list_contains(p.head_shas, 'c' || u.event_id) END
),
heads AS (
    SELECT bucket, sha, min(repo_id) AS repo_id, min(pr) AS pr FROM (SELECT bucket, repo_id, pr, unnest(head_shas) AS sha FROM open) GROUP BY bucket, sha HAVING count(*) = 1
),
by_sha AS (
    SELECT h.repo_id, h.pr, s.eid, s.created_at, 1 AS src FROM e s JOIN heads h ON h.sha = s.sha AND h.bucket = s.bucket
    WHERE s.kind = 'error' AND s.checks IS NULL
),
cascade_ AS (SELECT * FROM by_direct UNION ALL SELECT * FROM by_check UNION ALL SELECT * FROM by_push UNION ALL SELECT * FROM by_sha)
"""
