import itertools

from mergeweave.functions import schemas
from mergeweave.operators.snapshot import snapshots
from mergeweave.plans import shard
from mergeweave.streaming import snapshots as kept

from .helpers import event, lines, opened, pull


def sent():
    at = lambda k: f"2024-01-0{k}T00:00:00Z"
    return [
        [opened(1, pr=pull(1, title="third", updated_at=at(3)), id="3", at=at(3)), opened(2, pr=pull(2, title="only"), id="9")],
        [opened(1, pr=pull(1, title="first", updated_at=at(1)), id="1", at=at(1)), event("IssueCommentEvent", {"issue": {"number": 1, "pull_request": {}}, "comment": {"id": 1}}, id="5", at=at(4), actor={"login": "bob", "id": 8})],
        [opened(1, pr=pull(1, title="second", updated_at=at(2)), id="2", at=at(2))],
    ]


def shown(df):
    return sorted((r["pr_number"], r["pull_request"]["title"], tuple(r["participants"]), tuple(r["head_refs"])) for r in df.collect())


def test_any_order_of_files_gives_the_batch_s_result(spark, tmp_path):
    parts = [spark.createDataFrame(shard.events(lines(spark, part), 16).collect(), schemas.EVENT) for part in sent()]
    want = shown(snapshots(parts[0].union(parts[1]).union(parts[2])))
    assert [w[1] for w in want] == ["third", "only"] and want[0][2] == ("ann", "bob")
    for n, order in enumerate(list(itertools.permutations(range(3)))[::2]):
        source, out, state = (str(tmp_path / f"{x}{n}") for x in ("in", "out", "state"))
        assert kept.current(spark, out) is None
        for k in order:  # a trigger for each file, over restarts
            parts[k].write.mode("append").parquet(source)
            kept.start(kept.events(spark, source), out, state).awaitTermination()
        assert shown(kept.current(spark, out)) == want
        kept.compacted(spark, out, f"{out}-small")
        assert shown(kept.current(spark, f"{out}-small")) == want
