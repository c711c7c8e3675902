import gzip
import json


def pull(number=1, **over):
    """A snapshot with what the filters ask for."""
    return {
        "id": 5, "number": number, "title": "A title", "body": "A body that is long enough", "merged": True, "merge_commit_sha": "m1",
        "updated_at": "2024-01-01T00:00:00Z", "changed_files": 3,
        "base": {"ref": "main", "sha": "b" * 40, "repo": {"id": 10, "full_name": "o/r"}},
        "head": {"ref": "topic", "sha": "a" * 40, "repo": {"id": 10}},
    } | over


def event(kind, payload, id="1", repo=10, at="2024-01-01T00:00:00Z", **over):
    return {"id": id, "type": kind, "repo": {"id": repo, "name": "o/r"}, "created_at": at, "public": True, "actor": {"login": "ann", "id": 7}, "payload": payload} | over


def opened(number=1, pr=None, **how):
    return event("PullRequestEvent", {"action": "closed", "number": number, "pull_request": pull(number) if pr is None else pr}, **how)


def lines(spark, events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "value string")


def write_gz(path, events):
    with gzip.open(path, "wt") as f:
        for e in events:
            f.write((e if isinstance(e, str) else json.dumps(e)) + "\n")


def tables(spark, events, buckets=16, keep_extra=False):
    from mergeweave.functions.schemas import DIRECT_TYPES
    from mergeweave.plans import shard

    # as in practice the tables are written before they are read
    rows = shard.events(lines(spark, events), buckets, keep_extra).collect()
    from mergeweave.functions.schemas import EVENT

    direct = [r for r in rows if r["type"] in DIRECT_TYPES]
    other = [r for r in rows if r["type"] not in DIRECT_TYPES]
    return spark.createDataFrame(direct, EVENT), spark.createDataFrame(other, EVENT)
