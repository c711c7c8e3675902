"""Queries over lines, files, nested rows and git, each with the SQL that it is held against."""

from __future__ import annotations

import os

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import lens, wide
from .functions import coerce, events, text
from .functions import schemas as S
from .operators import attach, gitops, landed, snapshot
from .plans import enrich, group, shard
from .registry import _ROWS, _query, _repository, _tables
from .sources import archive, commits, sinks
from .sources.scratch import new_path, stored
from .streaming import ingest
from .streaming import snapshots as kept


def _wide(spark: SparkSession, sf_dir: str, keep_extra: bool = False, columns: list[str] | None = None) -> DataFrame:
    return shard.events(wide.lines(spark, sf_dir), 16, keep_extra, columns)


@_query(
    f"SELECT event_id::VARCHAR AS event_id, {wide.type_sql()} AS type, 't' || event_id AS created_at, true AS public, 'done' AS action, {wide.actor_sql()} AS actor, "
    + ", ".join(f"{wide.sql(p)} AS {p}" for p in wide.PAYLOADS)
    + " FROM events",
    lens_sql=False,
)
def s1_payloads(spark, sf_dir):
    """All twelve types with all fields of all payload structs."""
    rows = _wide(spark, sf_dir, columns=["event_id", "type", "created_at", "public", "action", "actor", *wide.PAYLOADS])
    return rows.select("event_id", "type", "created_at", "public", "action", *[F.to_json(c).alias(c) for c in ("actor", *wide.PAYLOADS)])


_EXTRAS = {
    "actor": "actor.user_extra_json", "pr": "pull_request.pr_extra_json", "base": "pull_request.base.ref_extra_json", "repo": "pull_request.head.repo.repo_extra_json",
    "license": "pull_request.base.repo.license.license_extra_json", "milestone": "pull_request.milestone.milestone_extra_json", "label": "pull_request.labels[0].label_extra_json",
    "issue": "issue.issue_extra_json", "comment": "comment.comment_extra_json", "review": "review.review_extra_json", "push": "push.push_extra_json",
    "commit": "push.commits[0].commit_extra_json", "author": "push.commits[0].author.author_extra_json", "status": "status.status_extra_json", "run": "check_run.check_run_extra_json",
    "run_pr": "check_run.pull_requests[0].check_pr_ref_extra_json", "suite": "check_suite.check_suite_extra_json",
}
_HAVE = {
    "actor": range(12), "pr": (0, 1, 2), "base": (0, 1, 2), "repo": (0, 1, 2), "license": (0, 1, 2), "milestone": (0, 1, 2), "label": (0, 1, 2), "issue": (3,), "comment": (2, 3, 4),
    "review": (1,), "push": (11,), "commit": (11,), "author": (11,), "status": (5, 6), "run": (7, 8), "run_pr": (7, 8), "suite": (9, 10),
}
#: Of pushes and statuses the struct is read from the payload itself, so the event's own members are extra there.
_MORE = {"push": '"action":"done","number":7@,', "status": '"action":"done","number":7@,'}


@_query(
    "SELECT event_id::VARCHAR AS event_id, "
    + ", ".join(f"CASE WHEN event_id % 12 IN ({', '.join(map(str, _HAVE[n]))}) THEN replace('{{{_MORE.get(n, '')}\"zz\":@}}', '@', event_id::VARCHAR) END AS {n}" for n in _EXTRAS)
    + " FROM events",
    lens_sql=False,
)
def s1_nested_extras(spark, sf_dir):
    """Members that no field reads, of every struct."""
    rows = _wide(spark, sf_dir, True, ["event_id", "actor", *wide.PAYLOADS])
    return rows.select("event_id", *[F.decode(F.expr(path), "UTF-8").alias(n) for n, path in _EXTRAS.items()])


#: Lines by event_id modulo 14; ``@`` is the event's number. What comes of them: repository id and name, or nothing.
_LINES = [
    ('{"id":"@","type":"PushEvent","repo":{"id":@,"name":"o/r@"},"payload":{"ref":"x"}}', "event_id", "'o/r' || event_id"),
    ('{"id":"@","type":"PushEvent","repo":{"id":@', None, None),
    ("", None, None),
    ("   ", None, None),
    ('[{"id":"@","type":"PushEvent","repo":{"id":1}}]', None, None),
    ("null", None, None),
    ('{"id":"@","type":"PushEvent","repo_id":@,"repo_name":"top@","payload":{}}', "event_id", "'top' || event_id"),
    ('{"id":"@","type":"PushEvent","repo":{"id":"x","name":""},"repo_id":"0@","repo_name":"n"}', "event_id", "''"),
    ('{"id":"@","type":"PushEvent","repo":{"name":"o/r"},"payload":{}}', None, None),
    (' \t{"id":"@","type":"StatusEvent","repo":{"id":-@},"payload":[]} ', "-event_id", "NULL"),
    ('{"id":"@","type":"WatchEvent","repo":{"id":1},"payload":{}}', None, None),
    ('{"id":"@","type":"IssueCommentEvent","repo":{"id":2},"payload":{"issue":{"number":3}}}', None, None),
    ('{"id":"@","type":"IssueCommentEvent","repo":{"id":2},"payload":{"issue":{"number":3,"pull_request":null}}}', "2", "NULL"),
    ('{"id":"@","type":"PushEvent","repo":{"id":2},"payload":[1]}', None, None),
]


def _odd_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    listed = F.element_at(F.array(*[F.lit(x) for x, _, _ in _LINES]), (F.col("event_id") % len(_LINES) + 1).cast("int"))
    return e.select("event_id", F.replace(listed, F.lit("@"), F.col("event_id").cast("string")).alias("value"))


_KEPT = [k for k, (_, repo, _) in enumerate(_LINES) if repo]
_CASE = lambda at: "CASE event_id % 14 " + " ".join(f"WHEN {k} THEN {_LINES[k][at]}" for k in _KEPT) + " END"


@_query(
    f"SELECT event_id::VARCHAR AS event_id, repo_id, repo_name, ((repo_id % 16) + 16) % 16 AS repo_bucket FROM (SELECT event_id, ({_CASE(1)})::BIGINT AS repo_id, {_CASE(2)} AS repo_name FROM events WHERE event_id % 14 IN ({', '.join(map(str, _KEPT))}))",
    lens_sql=False,
)
def s1_odd_lines(spark, sf_dir):
    """Blank, malformed and other lines; where the repository comes from; payloads that are no objects."""
    rows = shard.events(_odd_lines(spark, sf_dir).select("value"), 16, columns=["event_id", "repo_id", "repo_name", "repo_bucket"])
    return rows.withColumn("repo_bucket", F.col("repo_bucket").cast("long"))


@_query(
    f"""SELECT count(*) FILTER (event_id % 14 NOT IN (2, 3)) AS lines, count(*) FILTER (event_id % 14 = 1) AS bad_lines, count(*) FILTER (event_id % 14 IN ({', '.join(map(str, _KEPT))})) AS events_kept,
    count(*) FILTER (event_id % 14 = 12) AS kept_pr, count(*) FILTER (event_id % 14 IN (0, 6, 7, 9)) AS kept_other FROM events""",
    lens_sql=False,
)
def s1_observed(spark, sf_dir):
    """Counts of stage 1 with malformed lines, observed in the pass that writes the tables."""
    source = _folder(spark, sf_dir)
    counts = shard.run(spark, source, new_path(spark, "observed"), 16)
    names = ["lines", "bad_lines", "events_kept", "kept_pr", "kept_other"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


#: Names that archives get by event_id modulo 5; the last doesn't match.
_NAMES = ["a.json.gz", "deep/b.jsonl.gz", "deep/er/c.ndjson.gz", "d.json.gz", "e.txt.gz"]


def _folder(spark: SparkSession, sf_dir: str, by_name: bool = False) -> str:
    """A folder of gzipped archives of odd lines, each in order of events; by_name: under the names above, else each once under a name that matches."""
    root = new_path(spark, "archives")
    names = _NAMES if by_name else _NAMES[:4]
    rows = _odd_lines(spark, sf_dir).withColumn("part", (F.col("event_id") % len(names)).cast("int"))
    rows.repartition(len(names), "part").sortWithinPartitions("part", "event_id").select("part", "value").write.partitionBy("part").option("compression", "gzip").text(f"{root}-made")
    # Spark gives no names to files: they are moved, in whatever store they lie
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for k, name in enumerate(names):
        to = path(f"{root}/{name}")
        store.mkdirs(to.getParent())
        for status in store.globStatus(path(f"{root}-made/part={k}/part-*")) or []:
            store.rename(status.getPath(), to)
    return root


@_query(
    """SELECT ['a.json.gz', 'b.jsonl.gz', 'c.ndjson.gz', 'd.json.gz'][event_id % 5 + 1] AS file, count(*) AS lines, count(*) FILTER (event_id % 14 = 1) AS bad,
    min(event_id) FILTER (event_id % 14 = 0) AS first_good
    FROM (SELECT *, count(*) FILTER (event_id % 14 = 1) OVER (PARTITION BY event_id % 5 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events)
    WHERE event_id % 5 < 4 AND coalesce(before, 0) < 7 GROUP BY event_id % 5""",
    lens_sql=False,
)
def s1_archives(spark, sf_dir):
    """Archives found by three patterns at any depth, each up to its seventh malformed line."""
    rows = archive.within_budget(archive.lines(spark, _folder(spark, sf_dir, True)), 7)
    number = F.regexp_extract("value", r'"id":"(\d+)"', 1)
    good = F.col("value").startswith('{"id"') & F.col("value").contains('"payload":{"ref":"x"}}')
    file = F.substring_index("path", "/", -1)
    return rows.groupBy(file.alias("file")).agg(
        F.count("*").alias("lines"), F.count_if((F.trim("value") != "") & coerce.parsed(F.col("value")).isNull()).alias("bad"), F.min(F.when(good, number.cast("long"))).alias("first_good")
    )


def _harmed(spark: SparkSession, root: str, sf_dir: str) -> str:
    """A copy of a folder of archives: the first is followed by the header of another member that never comes, the second by four bytes that are none."""
    out, jvm, conf = new_path(spark, "harmed"), spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    source = path(f"{sf_dir}/events.parquet")
    held = source.getFileSystem(conf)
    one = source if held.getFileStatus(source).isFile() else [s.getPath() for s in held.listStatus(source) if s.getPath().getName().endswith(".parquet")][0]
    for k, name in enumerate(_NAMES[:4]):
        here, there = path(f"{root}/{name}"), path(f"{out}/{name}")
        store = here.getFileSystem(conf)
        if not store.exists(here):
            continue
        to = store.create(there, True)
        more = [(store, here, 10)] if k == 0 else [(held, one, 4)] if k == 1 else []
        given = store.open(here)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(given, to, 65536, False)
        given.close()
        for fs, what, size in more:
            given = fs.open(what)
            to.write(given.readNBytes(size))
            given.close()
        to.close()
    return out


@_query(
    """SELECT ['a.json.gz', 'b.jsonl.gz', 'c.ndjson.gz', 'd.json.gz'][event_id % 4 + 1] AS file, count(*) AS lines, count(*) FILTER (event_id % 14 = 1) AS bad,
    CASE event_id % 4 WHEN 0 THEN 'truncated' WHEN 1 THEN 'Error -3 while decompressing data: incorrect header check' END AS reason,
    (SELECT count(DISTINCT event_id % 4) FROM events WHERE event_id % 4 < 2) AS bad_files FROM events GROUP BY event_id % 4""",
    lens_sql=False,
)
def s1_damaged_archives(spark, sf_dir):
    """Archives of which two are damaged: all lines before the damage, where and why they end, and how many stage 1 counts."""
    root = _harmed(spark, _folder(spark, sf_dir), sf_dir)
    rows = stored(archive.checked(spark, root), "lines")
    counts = shard.run(spark, root, new_path(spark, "counted"), 16, count_damage=True)
    bad = F.col("value").isNotNull() & (F.trim("value") != "") & coerce.parsed(F.col("value")).isNull()
    return rows.groupBy(F.substring_index("path", "/", -1).alias("file")).agg(
        F.count("value").alias("lines"), F.count_if(bad).alias("bad"), F.max("damage.reason").alias("reason"), F.lit(counts["bad_files"]).cast("long").alias("bad_files")
    )


@_query(
    f"""SELECT CASE WHEN event_id % 14 = 12 THEN 'pr_events' ELSE 'other_events' END AS kind, ((repo_id % 16) + 16) % 16 AS repo_bucket, count(*) AS n
    FROM (SELECT event_id, ({_CASE(1)})::BIGINT AS repo_id FROM events WHERE event_id % 14 IN ({', '.join(map(str, _KEPT))})) GROUP BY ALL""",
    lens_sql=False,
)
def s1_stream(spark, sf_dir):
    """Stage 1 as a stream over the same archives, both tables written exactly once (O1, K3)."""
    out = new_path(spark, "stream")
    for query in ingest.start(ingest.events(spark, _folder(spark, sf_dir), 16, files_per_trigger=2), f"{out}/tables", f"{out}/state"):
        query.awaitTermination()
    parts = [sinks.read_events(spark, f"{out}/tables/{kind}").select(F.lit(kind).alias("kind"), F.col("repo_bucket").cast("long").alias("repo_bucket")) for kind in ("pr_events", "other_events")]
    return parts[0].union(parts[1]).groupBy("kind", "repo_bucket").agg(F.count("*").alias("n"))


@_query(
    """SELECT kind IN ('view', 'click', 'signup') AS direct, lpad((repo_id % 16)::VARCHAR, 4, '0') AS folder, count(*) AS n, 0::BIGINT AS out_of_order FROM e GROUP BY ALL"""
)
def s1_files_in_order(spark, sf_dir):
    """Folders of buckets, and rows in files by repository, time and id (K1, K2, L1)."""
    pr, other = _tables(spark, sf_dir)
    parts = []
    for table, direct in ((pr, True), (other, False)):
        where = table.select("repo_id", "created_at", "event_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        parts.append(where.withColumn("direct", F.lit(direct)))
    key = F.struct(*[c.alias(n) for c, n in zip(sinks.scan_order(), "abc", strict=True)])
    rows = parts[0].union(parts[1]).withColumn("key", key).withColumn("before", F.lag("key").over(Window.partitionBy("file").orderBy("at")))
    return rows.groupBy("direct", F.regexp_extract("file", "repo_bucket=([0-9]+)", 1).alias("folder")).agg(F.count("*").alias("n"), F.count_if(F.col("before") > F.col("key")).alias("out_of_order"))


@_query("SELECT repo_id, pr::BIGINT AS pr_number, k % 3 = 0 AS merged, sha AS head_sha, 'T' || k AS title, updated_at, array_to_string(participants, ',') AS participants, true AS several FROM snap")
def s2_stream_snapshots(spark, sf_dir):
    """The latest snapshots kept over a stream of the direct events, some files a trigger, later events first (A1, A4)."""
    pr, _ = _tables(spark, sf_dir)
    source, out = new_path(spark, "late"), new_path(spark, "kept")
    # files by time, the last of them first: what comes later has to leave what came before alone
    late = pr.repartitionByRange(6, F.desc("created_at")).withColumn("file", F.spark_partition_id())
    late.write.partitionBy("file").parquet(f"{source}-made")
    for k in range(6):
        spark.read.schema(S.EVENT).parquet(f"{source}-made/file={k}").coalesce(1).write.mode("append").parquet(source)
    kept.start(kept.events(spark, source, files_per_trigger=1), out, new_path(spark, "state")).awaitTermination()
    triggers = spark.read.parquet(out).agg(F.countDistinct("trigger")).first()[0]
    snap = F.col("pull_request")
    return kept.current(spark, out).select(
        "repo_id", "pr_number", snap["merged"].alias("merged"), snap["head"]["sha"].alias("head_sha"), snap["title"].alias("title"), snap["updated_at"].alias("updated_at"),
        F.array_join("participants", ",").alias("participants"), F.lit(triggers > 1).alias("several"),
    )


@_query("SELECT kind IN ('view', 'click', 'signup') AS direct, lpad((repo_id % 16)::VARCHAR, 4, '0') AS folder, count(*) AS n, 2::BIGINT AS versions FROM e WHERE repo_id % 3 = 0 GROUP BY ALL")
def s1_second_run(spark, sf_dir):
    """Both tables written again from a third of the repositories: readers find the second version alone, whole (K1, K3)."""
    root = new_path(spark, "stage1")
    rows = stored(shard.events(lens.lines(spark, sf_dir), lens.BUCKETS), "events")
    for some in (rows, rows.where("repo_id % 3 = 0")):
        sinks.write_events(some, root)
    parts = []
    for name, direct in (("pr_events", True), ("other_events", False)):
        table = sinks.read_events(spark, sinks.event_table(spark, root, name))
        parts.append(table.select(F.lit(direct).alias("direct"), F.regexp_extract(F.col("_metadata.file_path"), "repo_bucket=([0-9]+)", 1).alias("folder")))
    versions = len(sinks.superseded(spark, root)) + 1
    return parts[0].union(parts[1]).groupBy("direct", "folder").agg(F.count("*").alias("n"), F.lit(versions).cast("long").alias("versions"))


@_query(
    """SELECT direct, count(*) AS n, true AS small, true AS skipped, sum(CASE WHEN repo_id = least THEN 1 ELSE 0 END)::BIGINT AS of_least
    FROM (SELECT repo_id, kind IN ('view', 'click', 'signup') AS direct, min(repo_id) OVER (PARTITION BY kind IN ('view', 'click', 'signup')) AS least FROM e) GROUP BY direct"""
)
def s1_row_groups(spark, sf_dir):
    """Row groups of 20 rows at most, as footers tell; of those, few may hold the smallest repository id, and a scan for it finds all its rows (K1)."""
    root = new_path(spark, "groups")
    sinks.write_events(shard.events(lens.lines(spark, sf_dir), lens.BUCKETS), root, row_group_rows=20)
    parts = []
    for name, direct in (("pr_events", True), ("other_events", False)):
        at = sinks.event_table(spark, root, name)
        groups = stored(sinks.row_groups(spark, at, "repo_id"), "footers")
        least = groups.agg(F.min("least")).first()[0]
        found = sinks.read_events(spark, at).where(F.col("repo_id") == F.lit(least)).agg(F.count("*").alias("of_least"))
        shown = groups.agg(F.sum("rows").alias("n"), (F.max("rows") <= 20).alias("small"), (2 * F.count_if(F.lit(least).between(F.col("least"), F.col("most"))) < F.count("*")).alias("skipped"))
        parts.append(shown.join(F.broadcast(found)).select(F.lit(direct).alias("direct"), "n", "small", "skipped", "of_least"))
    return parts[0].union(parts[1])


@_query("SELECT repo_id % 16 AS repo_bucket, type, count(*) AS n FROM e WHERE kind IN ('purchase', 'error') AND repo_id % 16 IN (3, 5, 11) GROUP BY ALL")
def s2_bucket_scan(spark, sf_dir):
    """Some columns of some buckets, named in a list; other folders aren't opened."""
    _, other = _tables(spark, sf_dir)
    root = other.inputFiles()[0].rsplit("/repo_bucket=", 1)[0]
    some = sinks.read_events(spark, root, sinks.bucket_list("11, 3,5,3"))
    return some.groupBy(F.col("repo_bucket").cast("long").alias("repo_bucket"), "type").agg(F.count("*").alias("n"))


@_query("SELECT DISTINCT repo_id % 16 AS repo_bucket FROM direct")
def s2_buckets(spark, sf_dir):
    """Distinct buckets of the table of direct events, from its folders."""
    pr, _ = _tables(spark, sf_dir)
    root = pr.inputFiles()[0].rsplit("/repo_bucket=", 1)[0]
    return sinks.buckets_of(spark, root).select(F.col("repo_bucket").cast("long").alias("repo_bucket"))


@_query("SELECT user_id, array_to_string(list_distinct_in_order, ',') AS ks FROM (SELECT user_id, list(k ORDER BY first) AS list_distinct_in_order FROM (SELECT user_id, k, min(event_id) AS first FROM raw WHERE k % 4 <> 0 GROUP BY user_id, k) GROUP BY user_id)")
def s1_unique_array(spark, sf_dir):
    """Distinct in order of first occurrence, nulls aside; null if none is left."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    some = rows.withColumn("k", F.when(F.col("k") % 4 != 0, F.col("k")))
    listed = some.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "k"))).alias("all"))
    return listed.select("user_id", F.array_join(events._unique(F.transform("all", lambda x: x["k"])), ",").alias("ks")).where("ks is not null")


@_query(
    _ROWS
    + """, shown AS (
        SELECT a.repo_id, a.pr AS of_pr, v.repo_id AS event_repo, a.src, v.eid, v.created_at, v.kind, v.type, v.k, v.pr, v.sha, v.checks, v.is_push, v.push_ref, v.event_id, v.login
        FROM all_events a JOIN e v ON v.eid = a.eid JOIN picked p ON p.repo_id = a.repo_id AND p.pr = a.pr
    )
    SELECT repo_id, of_pr::BIGINT AS pr_number, row_number() OVER (PARTITION BY repo_id, of_pr ORDER BY src, created_at, eid)::INTEGER AS pos, eid AS id, type, created_at, true AS public,
        '{"login":"' || login || '","id":' || (k % 7) || '}' AS actor, event_repo AS event_repo_id, 'r/' || event_repo AS event_repo_name, 'done' AS action,
        CASE WHEN kind IN ('view', 'click', 'signup') THEN pr::BIGINT END AS number,
        CASE WHEN kind = 'signup' THEN '{"number":' || pr || '}' END AS issue,
        CASE WHEN kind = 'signup' THEN '{"id":' || k || ',"body":"Comment ' || k || '"}' END AS comment,
        CASE WHEN is_push THEN '{"ref":"' || push_ref || '"' || CASE WHEN k % 5 <> 0 THEN ',"head":"' || sha || '"' ELSE '' END || ',"commits":[{"sha":"c' || event_id || '","message":"Fix #' || pr || '","author":{"name":"' || login || '"}}]}' END AS push,
        CASE WHEN kind = 'error' AND k % 2 = 1 THEN '{"sha":"' || sha || '"}' END AS status,
        CASE WHEN kind = 'error' AND k % 2 = 0 THEN '{"id":' || k || ',"head_sha":"' || sha || '"}' END AS check_run,
        CASE WHEN kind = 'error' AND k % 2 = 0 AND k % 3 = 0 THEN '{"pull_requests":[' || replace('{"check_pr_ref_extra_json":null,"head_sha":null,"number":@,"url":null}', '@', (pr)::VARCHAR) || ',' || replace('{"check_pr_ref_extra_json":null,"head_sha":null,"number":@,"url":null}', '@', (k % 3)::VARCHAR) || ',' || replace('{"check_pr_ref_extra_json":null,"head_sha":null,"number":@,"url":null}', '@', (pr)::VARCHAR) || ']}' END AS check_extra,
        '{"direct_pr_number":' || CASE WHEN kind IN ('view', 'click', 'signup') THEN pr::VARCHAR ELSE 'null' END
            || ',"check_pr_numbers":' || CASE WHEN checks IS NULL THEN 'null' ELSE '[' || array_to_string(checks, ',') || ']' END
            || ',"join_sha":' || CASE WHEN kind = 'error' THEN '"' || sha || '"' ELSE 'null' END
            || ',"push_ref":' || CASE WHEN is_push THEN '"' || push_ref || '"' ELSE 'null' END
            || ',"push_head":' || CASE WHEN is_push AND k % 5 <> 0 THEN '"' || sha || '"' ELSE 'null' END
            || ',"push_commit_shas":' || CASE WHEN is_push THEN '["c' || event_id || '"]' ELSE 'null' END || '}' AS extra
    FROM shown"""
)
def s2_nested_events(spark, sf_dir):
    """The events of each row, in order, with their payloads and what was merged to their extras."""
    pr, other = _tables(spark, sf_dir)
    rows = group.pull_request_rows(pr, other, inference_source="all")
    e = rows.select("repo_id", "pr_number", F.posexplode("events").alias("pos", "e")).select("repo_id", "pr_number", (F.col("pos") + 1).alias("pos"), "e.*")
    plain = e.withColumn("check_extra", F.decode("check_run.check_run_extra_json", "UTF-8")).withColumn("check_run", F.col("check_run").dropFields("check_run_extra_json"))
    structs = ["actor", "issue", "comment", "push", "status", "check_run"]
    return plain.select(
        "repo_id", "pr_number", "pos", "id", "type", "created_at", "public", "event_repo_id", "event_repo_name", "action", "number", "check_extra",
        *[F.to_json(c).alias(c) for c in structs], F.decode("event_extra_json", "UTF-8").alias("extra"),
    )


@_query(
    "SELECT n AS part, CASE WHEN n = 0 THEN '{\"a\":1,\"b\":2,\"c\":null}' WHEN n = 1 THEN '{\"b\":2,\"c\":null}' ELSE '{\"a\":1}' END AS merged, count(*) AS k FROM (SELECT event_id % 3 AS n FROM events) GROUP BY n",
    lens_sql=False,
)
def s1_merged_extras(spark, sf_dir):
    """JSON objects merged, the right one first; what isn't an object counts as empty."""
    coerce.configure(spark)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("event_id") % 3).alias("part"))
    have = F.when(F.col("part") == 0, '{"a":1,"b":"old"}').when(F.col("part") == 1, "{broken").otherwise('{"a":1}').cast("binary")
    add = F.when(F.col("part") < 2, F.map_from_arrays(F.array(F.lit("b"), F.lit("c")), F.array(F.lit(2).cast("variant"), F.lit(None).cast("variant"))))
    merged = F.decode(coerce.merged_json(coerce.json_map(have), add), "UTF-8")
    return rows.groupBy("part").agg(F.count("*").alias("k"), F.first(merged).alias("merged"))


@_query(
    """SELECT event_id, repeat('é', least(n, 2)) || CASE WHEN n > 2 THEN '�' ELSE '' END AS head, n > 2 AS cut, repeat('é', least(n, 2)) AS tail, n = 8 AS is_commit,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS instant, n = 1 AS no_instant FROM (SELECT event_id, ts, event_id % 9 AS n FROM events)""",
    lens_sql=False,
)
def s3_bytes(spark, sf_dir):
    """Caps and tails of bytes that fall inside a character, SHAs, times."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", (F.col("event_id") % 9).cast("int").alias("n"))
    data = F.repeat(F.lit("é"), F.col("n")).cast("binary")
    head, cut = text.capped(data, 5)
    sha = F.when(F.col("n") == 8, F.repeat(F.lit("a0"), F.lit(20))).when(F.col("n") == 7, F.repeat(F.lit("A0"), F.lit(20))).when(F.col("n") == 6, F.repeat(F.lit("a0"), F.lit(21)))
    told = text.instant(F.when(F.col("n") == 1, "when").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return rows.select(
        "event_id", head.alias("head"), cut.alias("cut"), text.tail(data, 4).alias("tail"), text.is_commit(sha).alias("is_commit"),
        F.date_format(F.coalesce(told, F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("instant"), told.isNull().alias("no_instant"),
    )


_NESTED = ["issue", "comment", "review", "check_run", "check_suite"]
_PR_REF = '{"check_pr_ref_extra_json":null,"head_sha":%s,"number":1@,"url":%s}'


@_query(
    "SELECT event_id::VARCHAR AS id, event_id AS event_repo_id, 'o/r' || event_id AS event_repo_name, "
    + ", ".join(f"{wide.sql(n, S.NESTED_EVENT[n].dataType)} AS {n}" for n in _NESTED)
    + """, CASE WHEN event_id % 12 IN (2, 3, 4) AND event_id % 3 <> 0 THEN '{"commit_id":"commit_id ' || event_id || ' é"}' END AS moved_commit,
    CASE WHEN event_id % 12 BETWEEN 7 AND 10 THEN replace(CASE WHEN event_id % 3 = 0 THEN '{"pull_requests":[ODD]}' ELSE '{"pull_requests":[EVEN]}' END, '@', event_id::VARCHAR) END AS moved_refs,
    CASE event_id % 12 WHEN 0 THEN ('7' || event_id)::BIGINT WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN NULL WHEN 9 THEN NULL WHEN 10 THEN NULL WHEN 11 THEN NULL
        ELSE ('1' || event_id)::BIGINT END AS number FROM events""".replace("ODD", _PR_REF % ("null", "null")).replace("EVEN", _PR_REF % ('"head_sha @ é"', '"url @ é"')),
    lens_sql=False,
)
def s2_nested_structs(spark, sf_dir):
    """Events of all types as elements of a row: payloads by the narrower schema, what has no field there in extras."""
    # without inner extras, as the struct has none either, but for what is moved
    rows = _wide(spark, sf_dir).select(attach.nested_event().alias("e")).select("e.*")
    moved = rows.withColumn("moved_commit", F.decode("comment.comment_extra_json", "UTF-8")).withColumn("moved_refs", F.decode(F.coalesce("check_run.check_run_extra_json", "check_suite.check_suite_extra_json"), "UTF-8"))
    shown = [F.to_json(F.col(n).dropFields(f"{n}_extra_json")).alias(n) for n in _NESTED]
    return moved.select("id", "event_repo_id", "event_repo_name", *shown, "moved_commit", "moved_refs", "number")


@_query(
    f"SELECT event_id, n < {len(text.BUMP_TERMS)} AS bump FROM (SELECT event_id, event_id % {len(text.BUMP_TERMS) + 3} AS n FROM events)",
    lens_sql=False,
)
def s2_bump_terms(spark, sf_dir):
    """Every word of trivial updates, in upper case amid a text; and texts without."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    listed = [f"xx {t.upper()}yy" for t in text.BUMP_TERMS] + ["a bu mp", "upgrade the dependency", ""]
    title = F.element_at(F.array(*map(F.lit, listed)), (F.col("event_id") % len(listed) + 1).cast("int"))
    return rows.select("event_id", text.mentions_bump(title).alias("bump"))


def _pr_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pr, other = _tables(spark, sf_dir)
    return stored(group.pull_request_rows(pr, other, inference_source="all"), "rows")


@_query(_ROWS + " SELECT lpad((p.repo_id % 16)::VARCHAR, 4, '0') AS folder, count(*) AS n, true AS small, 0::BIGINT AS out_of_order, (SELECT count(*) FROM picked) AS footers FROM picked p GROUP BY 1")
def s2_files_in_order(spark, sf_dir):
    """Files of pull requests: seven rows at most, by repository and number; counts from footers."""
    out = new_path(spark, "prs")
    sinks.write_pr_rows(_pr_rows(spark, sf_dir), out, rows_per_file=7)
    rows = spark.read.parquet(out).select("repo_id", "pr_number", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    rows = rows.withColumn("key", F.struct("repo_id", "pr_number")).withColumn("before", F.lag("key").over(Window.partitionBy("file").orderBy("at")))
    small = sinks.files_of(spark, out).agg(F.max("rows")).first()[0] or 0
    return rows.groupBy(F.regexp_extract("file", "repo_bucket=([0-9]+)", 1).alias("folder")).agg(
        F.count("*").alias("n"), F.lit(small <= 7).alias("small"), F.count_if(F.col("before") > F.col("key")).alias("out_of_order"), F.lit(sinks.row_count(spark, out)).alias("footers")
    )


def _on(base: str, head: str):
    """Rows whose pull request is about two commits of the repository made for this."""
    pr = F.col("pull_request")
    with_ = lambda side, sha: pr[side].withField("sha", F.lit(sha)).withField("repo", pr["base"]["repo"])
    return pr.withField("base", with_("base", base)).withField("head", with_("head", head))


@_query(
    _ROWS
    + """, told AS (SELECT p.repo_id, p.pr, count(d.eid)::INTEGER AS n FROM picked p LEFT JOIN by_direct d USING (repo_id, pr) GROUP BY ALL)
    SELECT repo_id, pr::BIGINT AS pr_number, 'ok' AS status, 2 AS commit_count, n AS discussion_event_count, 'a.txt,dir/b.txt' AS touched, 'a.txt' AS tree, 'one' AS base_file, 'missing' AS new_file,
        'commit 1,commit 2' AS subjects, true AS patches, true AS diff, false AS cut, true AS from_base, 'https://github.com/r/' || repo_id || '.git' AS hosted FROM told"""
)
def s3_git_enrich(spark, sf_dir):
    """All rows of stage 2 with code from a repository made for this: clone, head, merge base, commits, patches, diff, tree, files."""
    where = _shared_folder(spark)
    base, head = _repository(f"{where}/r.git")
    rows = _pr_rows(spark, sf_dir).withColumn("pull_request", _on(base, head)).withColumn("hosted", F.transform(F.array(F.col("pull_request.base.repo.full_name")), text.clone_url)[0])
    done = enrich.enriched(rows, clone_url=lambda name: f"file://{where}/r.git")
    c = F.col("code")
    files = F.map_from_entries(F.transform(c["base_files_at_base"], lambda f: F.struct(f["path"], F.coalesce(f["error"], F.rtrim(F.regexp_replace(f["content"], "\n", ""))))))
    return done.select(
        "repo_id", "pr_number", c["status"].alias("status"), c["commit_count"].alias("commit_count"), c["discussion_event_count"].alias("discussion_event_count"),
        F.array_join(c["touched_files"], ",").alias("touched"), F.array_join(c["repo_files_at_base"], ",").alias("tree"), files["a.txt"].alias("base_file"), files["dir/b.txt"].alias("new_file"),
        F.array_join(F.transform(c["commits"], lambda x: x["subject"]), ",").alias("subjects"), F.forall(c["commits"], lambda x: x["patch"].contains("diff --git") & ~x["patch_truncated"]).alias("patches"),
        (c["compare_diff"].contains("+two") & c["compare_diff"].contains("+++ b/dir/b.txt")).alias("diff"), (c["compare_diff_truncated"] | c["touched_files_truncated"]).alias("cut"),
        (c["merge_base"] == base).alias("from_base"), "hosted",
    )


def _shared_folder(spark: SparkSession) -> str:
    """A new folder that git can open as well as Spark: only where the session's shared folder is one of the machine's file system."""
    where = new_path(spark, "git")
    if "://" in where and not where.startswith("file://"):
        raise ValueError("queries that make a repository need a shared folder that git can open")
    return where.removeprefix("file://").removeprefix("file:")


@_query(
    _ROWS
    + """ SELECT repo_id, p.pr::BIGINT AS pr_number, CASE p.pr % 5 WHEN 0 THEN 'skip' WHEN 1 THEN 'error' WHEN 2 THEN 'error' ELSE 'ok' END AS status,
        CASE p.pr % 5 WHEN 0 THEN 'missing_repo_or_pr_or_base' WHEN 1 THEN 'git_clone_or_fetch_failed' WHEN 2 THEN 'git_diff_names_failed' END AS reason,
        CASE p.pr % 5 WHEN 3 THEN 1 WHEN 4 THEN 2 END AS commit_count, CASE p.pr % 5 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS n_files,
        CASE p.pr % 5 WHEN 3 THEN 'a.txt' WHEN 4 THEN 'a.txt,dir/b.txt' END AS touched FROM picked p"""
)
def s3_git_cases(spark, sf_dir):
    """All rows of stage 2, by number with one lack or another: no repository, one that can't be cloned, a base that isn't there, limits, a head that only its reference knows."""
    where = _shared_folder(spark)
    base, head = _repository(f"{where}/r.git")
    rows, case = _pr_rows(spark, sf_dir), F.pmod("pr_number", F.lit(5))
    pr, repo = F.col("pull_request"), F.col("pull_request.base.repo")
    named = repo.withField("full_name", F.when(case == 0, None).when(case == 1, "r/none").otherwise(repo["full_name"]))
    of = lambda side, sha: pr[side].withField("sha", sha).withField("repo", named)
    asked = pr.withField("base", of("base", F.when(case == 2, "f" * 40).otherwise(base))).withField("head", of("head", F.when(case == 4, "e" * 40).otherwise(head)))
    rows = stored(rows.withColumn("pull_request", asked), "cases")
    url = lambda name: f"file://{where}/{'none' if name == 'r/none' else 'r.git'}"
    few = enrich.enriched(rows.where("pmod(pr_number, 5) = 3"), gitops.Limits(commits=1, touched_files=1), clone_url=url)
    rest = enrich.enriched(rows.where("pmod(pr_number, 5) <> 3"), clone_url=url)
    c = F.col("code")
    return few.union(rest).select(
        "repo_id", "pr_number", c["status"].alias("status"), c["reason"].alias("reason"), c["commit_count"].alias("commit_count"), F.size(c["base_files_at_base"]).alias("n_files"),
        F.nullif(F.array_join(c["touched_files"], ","), F.lit("")).alias("touched"),
    )


def _given(spark: SparkSession, sf_dir: str, where: str) -> str:
    """The rows of stage 2, about two commits of a repository made at ``where``, as a bucketed table."""
    base, head = _repository(f"{where}/r.git")
    given = new_path(spark, "prs")
    sinks.write_pr_rows(_pr_rows(spark, sf_dir).withColumn("pull_request", _on(base, head)), given)
    return given


@_query(_ROWS + " SELECT repo_id % 16 AS repo_bucket, count(*) AS n, count(*) AS distinct_rows, true AS noted FROM picked GROUP BY 1")
def s3_resumed(spark, sf_dir):
    """Three runs of stage 3, the first over half of the buckets: every row once, and every bucket noted as done."""
    where = _shared_folder(spark)
    given, out = _given(spark, sf_dir, where), new_path(spark, "code")
    for buckets in (list(range(8)), None, None):
        enrich.run(spark, given, out, buckets, clone_url=lambda name: f"file://{where}/r.git")
    rows = commits.committed(spark, out).withColumn("repo_bucket", F.col("repo_bucket").cast("long"))
    noted = set(commits.finished(spark, out, sinks.read_bucketed(spark, given)))
    counted = rows.groupBy("repo_bucket").agg(F.count("*").alias("n"), F.countDistinct("repo_id", "pr_number").alias("distinct_rows"))
    return counted.withColumn("noted", F.col("repo_bucket").isin([int(b) for b in noted]))


@_query(_ROWS + " SELECT repo_id % 16 AS repo_bucket, count(*) AS n, count(*) AS distinct_rows, CASE WHEN repo_id % 16 IN (1, 5) THEN 'first' ELSE 'second' END AS read_by FROM picked GROUP BY ALL")
def s3_killed_run(spark, sf_dir):
    """A run of stage 3 over four buckets that dies in the third, and one over all: what the first committed isn't read from git again, every row is there once."""
    where = _shared_folder(spark)
    given, out = _given(spark, sf_dir, where), new_path(spark, "code")
    os.symlink(f"{where}/r.git", f"{where}/first.git")

    def dies(name: str) -> str:
        if int(name.removeprefix("r/")) % 16 >= 9:
            raise RuntimeError("as if the machine had gone")
        return f"file://{where}/first.git"

    try:
        enrich.run(spark, given, out, [1, 5, 9, 13], rows_per_commit=1, clone_url=dies)
    except PySparkException:
        pass
    enrich.run(spark, given, out, clone_url=lambda name: f"file://{where}/r.git")
    rows = commits.committed(spark, out).withColumn("repo_bucket", F.col("repo_bucket").cast("long"))
    first = F.col("code.debug.extract_clone_url").endswith("first.git")
    return rows.groupBy("repo_bucket", F.when(first, "first").otherwise("second").alias("read_by")).agg(F.count("*").alias("n"), F.countDistinct("repo_id", "pr_number").alias("distinct_rows"))


@_query(
    _ROWS
    + """, shares AS (SELECT p.repo_id % 10 <> 0 AS hot, count(*) AS n FROM picked p GROUP BY 1)
    SELECT hot, n, n AS ok, n AS as_unsplit, true AS spread FROM shares"""
)
def s3_hot_repository(spark, sf_dir):
    """Rows of stage 2 of which nine in ten are of one repository: no task has more than half of it, and the code read is that of an unsplit run."""
    where = _shared_folder(spark)
    base, head = _repository(f"{where}/r.git")
    hot = F.col("repo_id") % 10 != 0
    rows = _pr_rows(spark, sf_dir).withColumn("pull_request", _on(base, head)).withColumn("at", F.xxhash64("repo_id", "pr_number")).withColumn("hot", hot)
    # numbers of one repository differ
    rows = rows.withColumn("repo_id", F.when(hot, -1).otherwise(F.col("repo_id")).cast("long")).withColumn("pr_number", F.pmod("at", F.lit(1_000_000_007)))
    rows = stored(rows, "hot")
    url = lambda name: f"file://{where}/r.git"
    said = F.xxhash64(F.col("code").dropFields("debug"))
    split = stored(enrich.enriched(rows, clone_url=url, least_chunk=1).select("hot", "at", said.alias("said"), F.col("code.status").alias("status"), F.spark_partition_id().alias("task")), "split")
    whole = enrich.enriched(rows, clone_url=url, least_chunk=1 << 30).select("at", said.alias("unsplit"))
    by_task = split.groupBy("hot", "task").agg(F.count("*").alias("n")).groupBy("hot").agg((~F.col("hot") | (F.sum("n") < 8) | (F.max("n") <= F.sum("n") / 2)).alias("spread"))
    each = split.join(whole, "at").groupBy("hot").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("said") == F.col("unsplit")).alias("as_unsplit"))
    return each.join(by_task, "hot").select("hot", "n", "ok", "as_unsplit", "spread")


@_query(
    """SELECT (SELECT count(*) FROM e) AS events_seen, (SELECT count(*) FROM kept_) AS prs_kept, (SELECT count(*) FROM kept_ WHERE k % 6 <> 0) AS inferred_used, count(*) AS attachments, count(DISTINCT eid) AS events_attached
    FROM by_direct JOIN kept_ USING (repo_id, pr)""".replace("SELECT (SELECT", ", kept_ AS (SELECT s.repo_id, s.pr, s.k FROM snap s LEFT JOIN landed l USING (repo_id, pr) WHERE s.k % 3 = 0 AND (s.k % 6 = 0 OR l.shas IS NOT NULL))\n    SELECT (SELECT", 1)
)
def s2_stats_inferred(spark, sf_dir):
    """Counts of stage 2 where landed commits are inferred."""
    pr, other = _tables(spark, sf_dir)
    kept = landed.with_landed(snapshot.snapshots(pr), pr.unionByName(other))
    seen = pr.withColumn("src_rank", F.lit(0)).unionByName(other.withColumn("src_rank", F.lit(1)))
    return group.statistics(seen, kept, attach.by_number(pr.withColumn("src_rank", F.lit(0)), kept))

