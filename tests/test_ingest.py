import gzip
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mergeweave.functions import schemas
from mergeweave.functions.coerce import at, bigint, boolean, configure, extras, parsed, project, string
from mergeweave.plans import shard
from mergeweave.sources import archive, sinks
from mergeweave.streaming import ingest

from .helpers import event, lines, opened, pull, write_gz


def model(value):
    """What reading a JSON value as integer, string and boolean gives."""
    i = None
    if isinstance(value, bool):
        pass
    elif isinstance(value, (int, float)):
        i = int(value)
    elif isinstance(value, str) and value.isascii() and value.isdigit():
        i = int(value)
    if i is not None and not -(2**63) <= i < 2**63:
        i = None
    return i, value if isinstance(value, str) else None, value if isinstance(value, bool) else None


VALUES = [1, 0, -3, 1.0, 1.9, -1.9, 1e3, 2.5e-7, "12", "-12", "x", "", "1.5", True, False, None, 2**63 - 1, 2**63, -(2**63), {}, {"a": 1}, [], [1], "true", "９"]


def test_coercion(spark):
    configure(spark)
    rows = [(k, json.dumps({"x": v})) for k, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "k int, j string").withColumn("v", parsed("j"))
    got = {r[0]: r[1:] for r in df.select("k", bigint("v", "$.x"), string("v", "$.x"), boolean("v", "$.x")).collect()}
    for k, v in enumerate(VALUES):
        want = model(v) if v != "９" else (None, "９", None)
        assert tuple(got[k]) == want, v
    missing = spark.createDataFrame([("{}",)], "j string").withColumn("v", parsed("j"))
    assert tuple(missing.select(bigint("v", "$.x"), string("v", "$.x"), boolean("v", "$.x")).first()) == (None, None, None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.booleans(), st.none(), st.text(max_size=5), st.integers(-(2**40), 2**40)), min_size=1, max_size=8))
def test_coercion_of_anything(spark, values):
    rows = [(k, json.dumps({"x": v})) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, j string").withColumn("v", parsed("j"))
    got = {r[0]: tuple(r[1:]) for r in df.select("k", bigint("v", "$.x"), string("v", "$.x"), boolean("v", "$.x")).collect()}
    assert got == {k: model(v) for k, v in enumerate(values)}


def test_objects_and_lists(spark):
    configure(spark)
    objects = ["{}", '{"unknown":1}', "null", "5", '{"user":{"login":"a","id":"3"},"labels":[{"name":"x","zz":[1]},3,{},null],"title":7}', '{"labels":{}}', '{"labels":[]}']
    df = spark.createDataFrame([(k, f'{{"p":{o}}}') for k, o in enumerate(objects)], "k int, j string").withColumn("v", parsed("j"))
    got = {r["k"]: r["p"] for r in df.select("k", project("v", "$.p", schemas.event_struct("pull_request"), True).alias("p")).collect()}
    assert got[0] is None and got[2] is None and got[3] is None
    assert got[1]["title"] is None and json.loads(got[1]["pr_extra_json"]) == {"unknown": 1}
    assert got[4]["user"]["login"] == "a" and got[4]["user"]["id"] == 3 and got[4]["title"] is None
    assert [x and x["name"] for x in got[4]["labels"]] == ["x", None, None, None]
    assert json.loads(got[4]["labels"][0]["label_extra_json"]) == {"zz": [1]}
    assert got[5]["labels"] is None and got[6]["labels"] == []


def test_lines_that_give_no_row(spark):
    bad = ["", "   ", "{", "[1]", "3", '"x"', "null", json.dumps(event("WatchEvent", {})), json.dumps(event("PushEvent", {}, repo=None)), json.dumps({"type": 5}), json.dumps(event("PushEvent", [1]))]
    good = [event("PushEvent", None, id="a"), event("PushEvent", [], id="b"), '{"type":"PushEvent","type":"status","repo_id":"77","repo_name":"q","id":"c"}']
    got = {r["event_id"]: r for r in shard.events(lines(spark, bad + good), 8).collect()}
    assert got.keys() == {"a", "b", "c"}
    assert got["c"]["type"] == "status" and got["c"]["repo_id"] == 77 and got["c"]["repo_bucket"] == 77 % 8 and got["c"]["repo_name"] == "q"


def test_issue_comments_need_the_key(spark):
    issues = [{"number": 3, "pull_request": {"url": "u"}}, {"number": 4, "pull_request": None}, {"number": 5}, None, 6]
    rows = shard.events(lines(spark, [event("IssueCommentEvent", {"issue": i}, id=str(k)) for k, i in enumerate(issues)]), 8).collect()
    assert {r["event_id"]: r["direct_pr_number"] for r in rows} == {"0": 3, "1": 4}
    assert all("pull_request" not in r["issue"].asDict() for r in rows)


def test_helpers_of_types(spark):
    refs = [{"number": 2}, {"number": "3"}, {"number": None}, 9, {"number": 2}]
    commits = [{"sha": "x"}, {"sha": ""}, {"sha": "y"}, {"sha": "x"}, 4, {"sha": 5}]
    sent = [
        event("CheckRunEvent", {"check_run": {"head_sha": "h", "pull_requests": refs}}, id="run"),
        event("check_suite", {"check_suite": {"head_sha": "g", "pull_requests": []}}, id="suite"),
        event("PushEvent", {"ref": "refs/heads/t", "head": "k", "commits": commits, "push_id": 8, "odd": 1}, id="push"),
        event("status", {"sha": "s", "state": "ok"}, id="status"),
        event("CommitCommentEvent", {"comment": {"commit_id": "c", "body": "b"}}, id="comment"),
        event("PullRequestReviewEvent", {"pull_request": {"number": 6}, "review": {"id": 1}}, id="review", repo=-3),
        opened(9, id="pr", org={"a": 1}, more=2),
    ]
    got = {r["event_id"]: r for r in shard.events(lines(spark, sent), 8, keep_extra=True).collect()}
    assert got["run"]["check_pr_numbers"] == [2, 3] and got["run"]["join_sha"] == "h" and got["suite"]["check_pr_numbers"] is None and got["suite"]["join_sha"] == "g"
    p = got["push"]
    assert (p["push_ref"], p["push_head"], p["push_commit_shas"], p["join_sha"]) == ("refs/heads/t", "k", ["x", "y"], None)
    assert len(p["push"]["commits"]) == 6 and json.loads(p["push"]["push_extra_json"]) == {"odd": 1} and json.loads(p["payload_extra_json"]) == {"odd": 1}
    assert got["status"]["join_sha"] == "s" and got["comment"]["join_sha"] == "c" and got["comment"]["comment"]["commit_id"] == "c"
    assert got["review"]["direct_pr_number"] == 6 and got["review"]["repo_bucket"] == 5 and got["review"]["pull_request"]["number"] == 6
    assert got["pr"]["direct_pr_number"] == 9 and json.loads(got["pr"]["event_extra_json"]) == {"more": 2}


def test_schema_is_the_table_s(spark):
    made = shard.events(lines(spark, [opened()]), 8)
    assert [(f.name, f.dataType.simpleString()) for f in made.schema] == [(f.name, f.dataType.simpleString()) for f in schemas.EVENT]
    assert [len(x.fields) for x in (schemas.EVENT, schemas.PR_ROW, schemas.CODE, schemas.NESTED_EVENT)] == [25, 11, 22, 17]


def test_sources_and_tables(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    write_gz(tmp_path / "in/a.json.gz", [opened(1, id="1"), "{bad", event("PushEvent", {}, id="2", repo=11)])
    write_gz(tmp_path / "in/deep/b.ndjson.gz", [opened(2, id="3", repo=-1)])
    write_gz(tmp_path / "in/c.txt.gz", [opened(3, id="4")])
    whole = gzip.compress("".join(json.dumps(opened(1, id=f"z{k}")) + "\n" for k in range(3000)).encode())
    (tmp_path / "in/d.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    assert archive.line_statistics(archive.lines(spark, str(tmp_path / "in"), "*.json.gz")).first()[:] == (3, 1)
    counts = shard.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), buckets=8)
    assert counts["lines"] >= 3 and counts["bad_lines"] >= 1 and counts["kept_pr"] + counts["kept_other"] == counts["events_kept"]
    at_ = sinks.event_table(spark, str(tmp_path / "out"), "pr_events")
    pr = sinks.read_events(spark, at_)
    ids = {r["event_id"] for r in pr.collect()}
    assert {"1", "3", "z0"} <= ids and "4" not in ids and "2" not in ids
    assert os.path.isdir(f"{at_}/repo_bucket=0007")
    assert [r["repo_bucket"] for r in sinks.buckets_of(spark, at_).collect()] == [2, 7]
    one = sinks.read_events(spark, at_, [7])
    assert {r["event_id"] for r in one.collect()} == {"3"}
    assert "PartitionFilters: [" in one._jdf.queryExecution().toString() and sinks.row_count(spark, sinks.event_table(spark, str(tmp_path / "out"), "other_events")) == 1
    assert sinks.bucket_list(" 3,1,,3") == [3, 1] and sinks.bucket_list("") is None


def test_budget_of_bad_lines(spark, tmp_path):
    write_gz(tmp_path / "a.json.gz", [opened(1, id="1"), "{", opened(1, id="2"), "{", opened(1, id="3"), "{"])
    rows = archive.within_budget(archive.lines(spark, str(tmp_path)), 2)
    assert sorted(r["event_id"] for r in shard.events(rows, 8).collect()) == ["1", "2"]
    plan = rows._jdf.queryExecution().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_budget_over_many_files_and_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        want = {}
        for n in range(9):
            sent = ["{" if (k * (n + 1)) % 5 == 1 else "" if k % 7 == 0 else json.dumps({"k": k}) for k in range(40)]
            write_gz(tmp_path / f"{n}.json.gz", sent)
            bad, kept = 0, []
            for x in sent:
                if bad < 3:
                    kept.append(x)
                bad += x == "{"
            want[f"{n}.json.gz"] = kept
        for source in (archive.lines, archive.checked):
            got = {}
            for r in archive.within_budget(source(spark, str(tmp_path)), 3).collect():
                got.setdefault(r["path"].rpartition("/")[2], []).append(r["value"])
            assert got == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_damage_of_files(spark, tmp_path):
    text = "".join(f"line {k} é\n" for k in range(40_000)).encode()
    whole = gzip.compress(text)
    broken = bytearray(whole)
    broken[len(whole) // 2] ^= 0xFF
    files = {
        "ok": whole, "two": gzip.compress(b"a\n") + gzip.compress(b"b\nc"), "padded": gzip.compress(b"a\n") + bytes(600), "cut": whole[: len(whole) // 2], "crc": whole[:-8] + bytes(4) + whole[-4:], "broken": bytes(broken), "not": b"plain", "none": b"",
        "bomb": gzip.compress(b"x" * 30_000_000 + b"\n"),
    }
    for name, raw in files.items():
        (tmp_path / f"{name}.json.gz").write_bytes(raw)
    rows = archive.checked(spark, str(tmp_path))
    name = lambda r: r["path"].rpartition("/")[2].removesuffix(".json.gz")
    bad = {name(r): r for r in archive.damaged_files(rows).collect()}
    assert set(bad) == {"cut", "crc", "broken", "not"}
    assert bad["cut"]["reason"] == "truncated" and "data check" in bad["crc"]["reason"] and "header" in bad["not"]["reason"]
    assert bad["crc"]["lines"] == 40_000 and bad["crc"]["at"] == len(text) and bad["not"]["lines"] == 0
    lines_ = {}
    for r in rows.where("value is not null").collect():
        lines_.setdefault(name(r), []).append(r["value"])
    assert lines_["ok"] == text.decode().split("\n")[:-1] and lines_["two"] == ["a", "b", "c"] and lines_["padded"] == ["a"] and len(lines_["bomb"][0]) == 30_000_000
    # whatever came out before the damage, up to the last complete line
    assert 0 < bad["cut"]["lines"] == len(lines_["cut"]) and lines_["cut"] == lines_["ok"][: len(lines_["cut"])] and bad["cut"]["at"] < len(text)
    assert len(lines_["broken"]) > 10_000
    counts = shard.run(spark, str(tmp_path), str(tmp_path / "out"), buckets=4, count_damage=True)
    assert counts["bad_files"] == 4 and counts["lines"] == sum(map(len, lines_.values()))


def test_stream(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for n in range(2):
        write_gz(src / f"{n}.json.gz", [opened(1, id=f"a{n}"), event("PushEvent", {}, id=f"b{n}")])
        for q in ingest.start(ingest.events(spark, str(src), 8), str(out), str(tmp_path / "check")):
            assert q.awaitTermination(120)
    got = [sorted(r["event_id"] for r in sinks.read_events(spark, str(out / n)).collect()) for n in ("pr_events", "other_events")]
    assert got == [["a0", "a1"], ["b0", "b1"]]


def test_extras_are_null_without_keeping(spark):
    df = spark.createDataFrame([('{"a":1}',)], "j string").withColumn("v", parsed("j"))
    assert df.select(extras("v", "$", [], False)).first()[0] is None
    assert df.select(at(df["v"], "$.zz").isNull()).first()[0]


@pytest.mark.parametrize("ids", [range(-9, 9)])
def test_buckets_are_never_negative(spark, ids):
    rows = shard.events(lines(spark, [opened(1, pr=pull(), repo=i, id=str(i)) for i in ids]), 7).collect()
    assert {int(r["event_id"]): r["repo_bucket"] for r in rows} == {i: i % 7 for i in ids}


def test_many_row_groups_take_no_more_than_their_rows_ask_for(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = spark.range(300).selectExpr("1 as repo_bucket", "id as repo_id")
    sinks.write_bucketed(rows, out, ["repo_id"], 1_000_000, parts=1, row_group_rows=2, look_up=("repo_id",))
    groups = sinks.row_groups(spark, out, "repo_id").collect()
    assert len(groups) == 150 and all(g["rows"] == 2 for g in groups) and max(g["row_group"] for g in groups) < sinks.GROUPS_PER_FILE
    # a filter of a megabyte for each group would take 150
    assert sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet")) < 1_000_000
    assert spark.read.parquet(out).where("repo_id = 7").count() == 1
    whole = str(tmp_path / "whole")
    sinks.write_bucketed(rows, whole, ["repo_id"], 1_000_000, parts=1, look_up=("repo_id",))
    assert sum(f.stat().st_size for f in (tmp_path / "whole").rglob("*.parquet")) < 200_000 and spark.read.parquet(whole).where("repo_id = 7").count() == 1
