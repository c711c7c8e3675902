import json
import random

import pytest

from mergeweave.functions import text
from mergeweave.operators import attach, quality, snapshot
from mergeweave.operators.landed import with_landed
from mergeweave.plans import group, shard
from mergeweave.sources import sinks

from .helpers import event, lines, opened, pull, tables


def snap(spark, events):
    return {(r["repo_id"], r["pr_number"]): r for r in snapshot.snapshots(tables(spark, events)[0]).collect()}


def test_latest_snapshot_and_ties(spark):
    day = "2024-01-02T00:00:00Z"
    events = [
        opened(1, pull(1, title="old"), id="1"),
        opened(1, pull(1, title="tie, earlier", updated_at=day), id="2", at="2024-01-02T01:00:00Z"),
        opened(1, pull(1, title="tie, later", updated_at=day, merged=None), id="3", at="2024-01-02T02:00:00Z"),
        opened(2, pull(2, title="created", updated_at=None, created_at=day), id="4"),
        opened(2, pull(2, title="neither", updated_at="", created_at=None), id="5", at="2025-01-01T00:00:00Z"),
        event("IssueCommentEvent", {"issue": {"number": 3, "pull_request": {}}}, id="6"),
        event("IssueCommentEvent", {"issue": {"number": 1, "pull_request": {}}}, id="7", actor={"login": "bob"}),
    ]
    random.Random(1).shuffle(events)
    got = snap(spark, events)
    assert got.keys() == {(10, 1), (10, 2)}
    assert got[10, 1]["pull_request"]["title"] == "tie, later" and got[10, 1]["pull_request"]["merged"] is None
    assert got[10, 2]["pull_request"]["title"] == "created"
    assert got[10, 1]["participants"] == ["ann", "bob"] and got[10, 1]["head_refs"] == ["refs/heads/topic"] and got[10, 1]["head_shas"] == ["a" * 40]


def test_last_event_decides_head_repository(spark):
    gone = pull(1, head={"ref": "t", "sha": "s", "repo": None}, updated_at="2020-01-01T00:00:00Z")
    got = snap(spark, [opened(1, id="1"), opened(1, gone, id="2", at="2024-02-01T00:00:00Z")])[10, 1]
    assert got["head_repo_id"] is None and got["pull_request"]["head"]["ref"] == "topic"


def test_body_versions(spark):
    events = [
        opened(1, pull(1, body="one"), id="1", at="2024-01-01T00:00:01Z"),
        opened(1, pull(1, body="two", updated_at=None), id="2", at="2024-01-01T00:00:02Z"),
        opened(1, pull(1, body="one"), id="3", at="2024-01-01T00:00:03Z"),
        event("IssueCommentEvent", {"issue": {"number": 1, "pull_request": {}, "body": "three"}}, id="4", at="2024-01-01T00:00:04Z"),
        opened(2, pull(2), id="5"),
        opened(2, pull(2), id="6"),
    ]
    rows = snapshot.body_versions(tables(spark, events)[0]).collect()
    assert [(v["source"], v["at"], v["event_id"], v["body"]) for v in rows[0]["pr_body_versions"]] == [
        ("pull_request", "2024-01-01T00:00:00Z", "1", "one"), ("pull_request", "2024-01-01T00:00:02Z", "2", "two"), ("issue", "2024-01-01T00:00:04Z", "4", "three"),
    ]
    assert len(rows) == 1


FILTER = [
    ({}, True), ({"merged": None}, False), ({"merged": False}, False), ({"base": {"ref": "master"}}, True), ({"base": {"ref": "dev"}}, False), ({"base": None}, False),
    ({"body": "  \t1234567890 \n"}, False), ({"body": " 12345678901　"}, True), ({"body": None}, False), ({"title": None}, True),
    ({"title": "BUMP it"}, False), ({"body": "please upgrade Dependencies now"}, False), ({"body": "chore(deps): all things"}, False), ({"body": "a renovated house!"}, False), ({"body": "an update of dependency"}, True),
    ({"changed_files": 0}, False), ({"changed_files": 1}, True), ({"changed_files": 15}, True), ({"changed_files": 16}, False), ({"changed_files": None}, False),
    ({"body": "fixes #1 and #1 again"}, True), ({"body": "fixes #1 and #2 again"}, False), ({"body": "fixes #1 and a#2 #3b x_#4"}, True),
]


def test_quality_filter(spark):
    events = [opened(k, pull(k, **over), id=str(k)) for k, (over, _) in enumerate(FILTER)]
    kept = quality.kept(snapshot.snapshots(tables(spark, events)[0]))
    assert {r["pr_number"] for r in kept.collect()} == {k for k, (_, ok) in enumerate(FILTER) if ok}


def test_every_bump_term(spark):
    df = spark.createDataFrame([(f"x {t.upper()} y",) for t in text.BUMP_TERMS] + [(None,), ("clean",)], "t string")
    assert [r[0] for r in df.select(text.mentions_bump(df["t"])).collect()] == [True] * 20 + [False] * 2


def attaching():
    a, b = "a" * 40, "b" * 40
    prs = [
        opened(1, pull(1), id="p1"),
        opened(2, pull(2, head={"ref": "two", "sha": b, "repo": {"id": 10}}), id="p2"),
        opened(3, pull(3, merged=False), id="p3"),
        opened(1, pull(1, head={"ref": "topic", "sha": b, "repo": {"id": 26}}), id="q1", repo=26),
        opened(4, pull(4, head={"ref": "", "sha": "", "repo": {"id": 10}}), id="p4"),
    ]
    push = lambda id, ref, head=None, shas=(), repo=10: event("PushEvent", {"ref": f"refs/heads/{ref}", "head": head, "commits": [{"sha": s} for s in shas]}, id=id, repo=repo)
    check = lambda id, sha, numbers, kind="check_run": event(kind, {kind: {"head_sha": sha, "pull_requests": [{"number": n} for n in numbers]}}, id=id)
    others = [
        check("c1", a, [1, 2, 3]), check("c2", a, [3]), check("c3", a, []), check("c4", b, []), check("c5", "z", [], "check_suite"),
        push("u1", "topic", a), push("u2", "topic", "x"), push("u3", "topic", None, ["y", a]), push("u4", "topic", None, ["y"]), push("u5", "topic"), push("u6", "none", a), push("u7", "topic", a, repo=26),
        push("u8", "topic", b, repo=26),
        event("status", {"sha": a}, id="s1"), event("StatusEvent", {"sha": b}, id="s2"), event("status", {"sha": ""}, id="s3"), event("CommitCommentEvent", {"comment": {"commit_id": a}}, id="s4"),
        event("IssueCommentEvent", {"issue": {"number": 99, "pull_request": {}}}, id="d1"), event("status", {"sha": a}, id="s5", repo=11),
    ]
    return prs + others


def test_ways_of_attaching(spark):
    pr, other = tables(spark, attaching())
    kept = snapshot.snapshots(pr).where("pull_request.merged")
    rows = attach.attached(pr.unionByName(other), kept).collect()
    got = {}
    for r in rows:
        got.setdefault(r["event_id"], set()).add((r["repo_id"], r["pr_number"]))
    one, two, far, four = (10, 1), (10, 2), (26, 1), (10, 4)
    assert got == {
        "p1": {one}, "p2": {two}, "q1": {far}, "p4": {four}, "c1": {one, two}, "c3": {one}, "u1": {one}, "u3": {one}, "u5": {one}, "u8": {far}, "s1": {one}, "s4": {one},
    }
    # commit b is the head of two in one bucket (10 and 26 modulo 16); in sixteen more buckets of one
    apart, rest = tables(spark, attaching(), buckets=17)
    kept = snapshot.snapshots(apart).where("pull_request.merged")
    assert {r["event_id"] for r in attach.by_commit(rest, kept).collect()} == {"c3", "c4", "s1", "s2", "s4"}
    assert {r["event_id"] for r in attach.by_commit(rest, kept, bucket_local=False).collect()} == {"c3", "s1", "s4", "s5"}


def test_ways_exclude_each_other(spark):
    pr, other = tables(spark, attaching())
    flags = pr.unionByName(other).select(*[f().cast("int").alias(n) for n, f in (("a", attach.is_direct), ("b", attach.is_check), ("c", attach.is_push), ("d", attach.is_sha))])
    assert flags.where("a + b + c + d > 1").count() == 0


def landing():
    push = lambda id, at, commits, ref="main": event("PushEvent", {"ref": f"refs/heads/{ref}", "commits": commits}, id=id, at=at)
    return [
        opened(12, pull(12, merge_commit_sha=None), id="1"),
        opened(13, pull(13, merge_commit_sha=""), id="2", actor={"login": "eve"}),
        opened(14, pull(14), id="3"),
        push("4", "2024-01-03T00:00:00Z", [{"sha": "late", "message": "see #12"}, {"sha": "eve1", "message": None, "author": {"username": "", "name": "eve"}}]),
        push("5", "2024-01-02T00:00:00Z", [{"sha": "part", "message": "see #123"}, {"sha": "late", "message": "PULL REQUEST #12"}, {"message": "#12"}]),
        push("6", "2024-01-02T00:00:00Z", [{"sha": "else", "message": "#12"}], ref="dev"),
    ]


def test_landing(spark):
    pr, other = tables(spark, landing())
    snaps = snapshot.snapshots(pr)
    got = {r["pr_number"]: (r["landed_commit_sha"], r["landed_commit_shas"], r["landed_inferred"]) for r in with_landed(snaps, pr.unionByName(other)).collect()}
    assert got == {12: ("part", ["part", "late"], True), 13: ("eve1", ["eve1"], True), 14: ("m1", ["m1"], False)}
    # as the original: no push is among the events that it infers from
    assert {r["pr_number"] for r in with_landed(snaps, pr).collect()} == {14}


def test_rows(spark, tmp_path):
    events = attaching() + [opened(1, pull(1, body="Another body, long enough"), id="p0", at="2023-01-01T00:00:00Z")]
    pr, other = tables(spark, events, keep_extra=True)
    rows = {(r["repo_id"], r["pr_number"]): r for r in group.pull_request_rows(pr, other).collect()}
    assert rows.keys() == {(10, 1), (10, 2), (10, 4), (26, 1)}
    one = rows[10, 1]
    assert [e["id"] for e in one["events"]] == ["p0", "p1", "c1", "c3", "s1", "s4", "u1", "u3", "u5"]
    assert len(one["pr_body_versions"]) == 2 and one["pull_request"]["merged_by"] is None
    by = {e["id"]: e for e in one["events"]}
    assert by["p1"]["number"] == 1 and by["c1"]["number"] is None and by["c1"]["event_repo_id"] == 10
    extra = json.loads(by["c1"]["event_extra_json"])
    assert extra == {"direct_pr_number": None, "check_pr_numbers": [1, 2, 3], "join_sha": "a" * 40, "push_ref": None, "push_head": None, "push_commit_shas": None}
    refs = json.loads(by["c1"]["check_run"]["check_run_extra_json"])["pull_requests"]
    assert [r["number"] for r in refs] == [1, 2, 3]
    assert json.loads(by["s4"]["comment"]["comment_extra_json"]) == {"commit_id": "a" * 40}
    frame = group.pull_request_rows(pr, other)
    sinks.write_pr_rows(frame, str(tmp_path / "prs"), rows_per_file=1)
    back = sinks.read_bucketed(spark, str(tmp_path / "prs"))
    assert back.count() == 4 and len(list((tmp_path / "prs/repo_bucket=0010").glob("*.parquet"))) == 4


def test_row_without_events_keeps_an_empty_list_and_schema(spark):
    from mergeweave.functions import schemas

    pr, other = tables(spark, [opened(1, id="1")])
    frame = group.pull_request_rows(pr, other)
    assert [(f.name, f.dataType.simpleString()) for f in frame.drop("repo_bucket").schema] == [(f.name, f.dataType.simpleString()) for f in schemas.PR_ROW]
    assert len(frame.first()["events"]) == 1
    assert group.pull_request_rows(pr.limit(0), other).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_order_of_input_doesn_t_matter(spark, seed):
    events = attaching() + landing()
    random.Random(seed).shuffle(events)
    pr, other = tables(spark, events)
    got = sorted((r["repo_id"], r["pr_number"], tuple(e["id"] for e in r["events"])) for r in group.pull_request_rows(pr, other, "all").collect())
    pr, other = tables(spark, attaching() + landing())
    assert got == sorted((r["repo_id"], r["pr_number"], tuple(e["id"] for e in r["events"])) for r in group.pull_request_rows(pr, other, "all").collect())


def test_statistics(spark):
    rows = lines(spark, [opened(1, id="1"), "{", event("PushEvent", {}, id="2")])
    assert shard.statistics(rows, shard.events(rows, 8)).first()[:] == (3, 1, 2, 1, 1)


def test_all_merged_pull_requests_are_not_sent_to_all_tasks(spark, data):
    from mergeweave import registry

    for query in (registry.s2_stats, registry.s2_attach_cascade):
        found = query(spark, data)
        assert found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
