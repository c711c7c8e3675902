import os
import subprocess

import pytest
from pyspark.sql import functions as F

from mergeweave.functions import schemas, text
from mergeweave.operators import gitops
from mergeweave.plans import enrich
from mergeweave.sources import commits, sinks


@pytest.fixture(scope="module")
def origin(tmp_path_factory):
    """A repository with a base, a branch with two commits as head of request 7, and odd files."""
    path = str(tmp_path_factory.mktemp("git") / "o.git")
    os.makedirs(path)
    env = os.environ | {f"GIT_{w}_{x}": v for w in ("AUTHOR", "COMMITTER") for x, v in (("NAME", "n"), ("EMAIL", "n@example.com"))}

    def git(*a):
        return subprocess.run(["git", "-C", path, *a], check=True, capture_output=True, env=env).stdout.decode().strip()

    def put(name, content):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "wb") as f:
            f.write(content)

    git("init", "-q", "-b", "main")
    for k in ("allowFilter", "allowAnySHA1InWant"):
        git("config", f"uploadpack.{k}", "true")
    put("a.txt", b"one\n")
    put("bin", b"\xff\xfe\x00")
    put("é.txt", b"accent\n")
    put("dir/x", b"x\n")
    git("add", "-A")
    git("commit", "-qm", "first")
    base = git("rev-parse", "HEAD")
    git("checkout", "-qb", "topic")
    put("a.txt", b"one\ntwo\n")
    put("new.txt", b"new\n")
    put("é.txt", b"changed\n")
    git("add", "-A")
    git("commit", "-qm", "second: subject")
    git("rm", "-qr", "dir")
    put("dir", b"now a file\n")
    put("bin", b"\xff")
    git("add", "-A")
    git("commit", "-qm", "third")
    head = git("rev-parse", "HEAD")
    git("update-ref", "refs/pull/7/head", head)
    git("checkout", "-q", "main")
    return path, base, head


def want(base, head, repo="o/r", number=7):
    return gitops.Wanted(repo, number, base, head, 2)


def at(origin, tmp_path, **how):
    return lambda name: gitops.Repository(str(tmp_path / "c" / name.replace("/", "__")), f"file://{origin[0]}", **how)


def test_enriched_row(origin, tmp_path):
    _, base, head = origin
    code = gitops.enrich(want(base, head), at(origin, tmp_path), gitops.Limits())
    assert code["status"] == "ok" and code["merge_base"] == base and code["used_head_sha"] == head and code["commit_count"] == 2
    assert [c["subject"] for c in code["commits"]] == ["second: subject", "third"] and "+two" in code["commits"][0]["patch"]
    assert "+two" in code["compare_diff"] and not code["compare_diff_truncated"]
    files = {f["path"]: f for f in code["base_files_at_base"]}
    assert files["a.txt"]["content"] == "one\n" and files["a.txt"]["size"] == 4 and files["new.txt"]["error"] == "missing"
    assert files["bin"]["content"] == "��\x00" and files["bin"]["size"] == 3
    # git quotes the name, so it isn't found; what comes after the folder is still read right
    assert files['"\\303\\251.txt"']["error"] == "missing" and files["dir"]["error"] == "not_blob:tree" and files["dir/x"]["content"] == "x\n"
    assert set(code) == set(schemas.CODE.fieldNames())


def test_exact_paths(origin, tmp_path):
    _, base, head = origin
    code = gitops.enrich(want(base, head), at(origin, tmp_path, exact_paths=True), gitops.Limits())
    assert {f["path"]: f["content"] for f in code["base_files_at_base"]}["é.txt"] == "accent\n"


def test_limits(origin, tmp_path):
    _, base, head = origin
    code = gitops.enrich(want(base, head), at(origin, tmp_path), gitops.Limits(1, 10, 20, 3, 2, 1, 2))
    assert code["commit_count"] == 1 and code["commits_truncated"] and code["commits"][0]["patch_truncated"] and code["commits"][0]["subject"] == "second: su"
    assert len(code["compare_diff"].encode()) == 20 and code["compare_diff_truncated"] and len(code["touched_files"]) == 3 and code["touched_files_truncated"]
    assert len(code["repo_files_at_base"]) == 2 and code["repo_files_at_base_truncated"] and code["base_files_at_base_truncated"]
    assert code["base_files_at_base"][0]["content"] == "on" and code["base_files_at_base"][0]["content_truncated"]
    free = gitops.enrich(want(base, head), at(origin, tmp_path), gitops.Limits(0, 0, 0, 0, 0, 0, 0))
    assert free["status"] == "ok" and not free["commits_truncated"]


def test_failures(origin, tmp_path):
    _, base, head = origin
    skip = gitops.enrich(want(None, head), at(origin, tmp_path), gitops.Limits())
    assert (skip["status"], skip["reason"], skip["discussion_event_count"]) == ("skip", "missing_repo_or_pr_or_base", 2)
    lost = gitops.enrich(want(base, head), lambda n: gitops.Repository(str(tmp_path / "x"), "file:///nowhere"), gitops.Limits())
    assert lost["reason"] == "git_clone_or_fetch_failed" and "rc=" in lost["debug"]["git_error"]
    wrong = gitops.enrich(want("f" * 40, head), at(origin, tmp_path), gitops.Limits())
    assert wrong["reason"] == "git_diff_names_failed" and wrong["merge_base"] is None and wrong["used_base_sha"] == "f" * 40
    unknown = gitops.enrich(want(base, "e" * 40), at(origin, tmp_path), gitops.Limits())
    assert unknown["status"] == "ok" and unknown["used_head_sha"] == head
    nohead = gitops.enrich(want(base, head, number=8), at(origin, tmp_path), gitops.Limits())
    assert nohead["status"] == "ok" and "fetch" in nohead["debug"]["git_stderr_tail"]


def test_timeout():
    done = gitops.git("version", timeout=0)
    assert done.code == 124 and b"[TIMEOUT]" in done.err


def test_answers_that_break_off(tmp_path, monkeypatch):
    """A stand-in for git that says what it is told to."""
    fake = tmp_path / "bin" / "git"
    fake.parent.mkdir()
    monkeypatch.setenv("PATH", f"{fake.parent}:{os.environ['PATH']}")

    def says(check, batch):
        fake.write_text(f"#!/bin/sh\ncase \"$*\" in *--batch-check*) printf '{check}' ;; *) printf '{batch}' ;; esac\n")
        fake.chmod(0o755)
        return gitops.Repository(str(tmp_path), "u").files(["a", "b"])

    assert says("", "") == {"a": "truncated: no header"}
    assert says("x blob 9\\n", "x blob 9\\nabc") == {"a": "truncated: payload", "b": "truncated: no header"}
    assert says("what\\nx blob 1\\n", "x blob 1\\nx\\n") == {"a": "bad header: what", "b": ("x", 1, b"x", False)}
    assert says("x blob 1\\ny blob 1\\n", "x blob 1\\nx\\n") == {"a": ("x", 1, b"x", False), "b": "truncated: no header"}
    assert says("x tree 1\\nb missing\\n", "") == {"a": "not_blob:tree", "b": "missing"}
    fake.write_text("#!/bin/sh\nexit 3\n")
    assert gitops.Repository(str(tmp_path), "u").files(["a"]) == {"a": "cat-file rc=3"}


def test_memory_is_bounded_by_the_caps(tmp_path):
    """A diff and a file of 300 MB each, read with caps of 1 MB by a process that may have 200 MB more than it starts with."""
    import sys

    path = str(tmp_path / "big")
    script = f"""
import os, resource, subprocess, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from mergeweave.operators import gitops
env = os.environ | {{f"GIT_{{w}}_{{x}}": v for w in ("AUTHOR", "COMMITTER") for x, v in (("NAME", "n"), ("EMAIL", "n@example.com"))}}
git = lambda *a: subprocess.run(["git", "-C", {path!r}, *a], check=True, capture_output=True, env=env).stdout.decode().strip()
os.makedirs({path!r})
git("init", "-q", "-b", "main")
open({path!r} + "/f", "w").write("small\\n")
git("add", "-A"); git("commit", "-qm", "one")
a = git("rev-parse", "HEAD")
with open({path!r} + "/f", "w") as f:
    for k in range(300):
        f.write(f"line {{k}} " + "x" * 999_980 + "\\n")
git("-c", "core.compression=0", "-c", "core.bigFileThreshold=2g", "add", "-A"); git("commit", "-qm", "two")
b = git("rev-parse", "HEAD")
r = gitops.Repository({path!r} + "/.git", "u")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
diff, cut = r.diff(a, b, 1_000_000)
assert cut and len(diff) == 1_000_000
patch, cut = r.patch(b, 1_000_000)
assert cut and patch.startswith("two")
blob, size, raw, cut = r.files([f"{{b}}:f"], 1_000_000)[f"{{b}}:f"]
assert cut and len(raw) == 1_000_000 and size > 290_000_000
grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
assert grown < 100, grown
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300)


def test_mirrors(origin, tmp_path):
    path, base, head = origin
    one, two = gitops.Mirrors(str(tmp_path / "m")), gitops.Mirrors(str(tmp_path / "m"))
    at_ = one.enter("r", f"file://{path}")
    assert two.enter("r", f"file://{path}") == at_ and os.path.isdir(f"{at_}/objects")
    repo = gitops.Repository(str(tmp_path / "own"), f"file://{path}", mirror=at_)
    code = gitops.enrich(want(base, head), lambda _: repo, gitops.Limits())
    plain = gitops.enrich(want(base, head), at(origin, tmp_path), gitops.Limits())
    assert os.path.isfile(tmp_path / "own/objects/info/alternates")
    assert {k: v for k, v in code.items() if k != "debug"} == {k: v for k, v in plain.items() if k != "debug"}
    one.leave("r")
    assert os.path.isdir(at_)
    # a process that is gone holds nothing
    open(f"{at_}.users/999999999-x", "w").close()
    two.leave("r")
    assert not os.path.exists(at_)
    assert gitops.Mirrors(str(tmp_path / "m")).enter("gone", "file:///nowhere") is None


def rows(spark, origin, numbers):
    _, base, head = origin
    repo = "struct('o/r' as full_name, 1L as id)"
    return spark.createDataFrame([(n,) for n in numbers], "n long").selectExpr(
        "1L as repo_id", "3 as repo_bucket", "n as pr_number", f"struct(n as number, struct('{base}' as sha, {repo} as repo) as base, struct('{head}' as sha, {repo} as repo) as head) as pull_request",
        "array(struct('IssueCommentEvent' as type), struct('PushEvent' as type)) as events",
    )


def test_frame(spark, origin):
    path = origin[0]
    got = enrich.enriched(rows(spark, origin, [7, 8]), clone_url=lambda n: f"file://{path}", batch=1).orderBy("pr_number").collect()
    assert [(r["pr_number"], r["code"]["status"], r["code"]["discussion_event_count"], r["code"]["commit_count"]) for r in got] == [(7, "ok", 1, 2), (8, "ok", 1, 2)]
    assert enrich.enriched(rows(spark, origin, []), clone_url=lambda n: f"file://{path}").count() == 0


def test_resume(spark, origin, tmp_path):
    path, out = origin[0], str(tmp_path / "out")
    told = []
    for numbers in ([7], [7, 8], [7, 8]):
        rows(spark, origin, numbers).write.mode("overwrite").partitionBy("repo_bucket").parquet(str(tmp_path / "in"))
        told.append(enrich.run(spark, str(tmp_path / "in"), out, clone_url=lambda n: f"file://{path}"))
    assert told == [{"ok": 1, "skip": 0, "error": 0}, {"ok": 1, "skip": 0, "error": 0}, {"ok": 0, "skip": 0, "error": 0}]
    assert sorted(r["pr_number"] for r in commits.committed(spark, out).collect()) == [7, 8]
    assert commits.committed(spark, str(tmp_path / "none")) is None


def test_what_a_dead_run_left_counts_for_nothing(spark, origin, tmp_path):
    path, given, out = origin[0], str(tmp_path / "in"), str(tmp_path / "out")
    rows(spark, origin, [7, 8]).write.partitionBy("repo_bucket").parquet(given)
    # as if a run had died between its data and its entry in the log
    lost = commits.folder(out, commits.new_commit())
    sinks.append_bucketed(enrich.enriched(sinks.read_bucketed(spark, given), clone_url=lambda n: f"file://{path}"), lost, ["repo_id", "pr_number"], 10)
    assert commits.committed(spark, out) is None and commits.forgotten(spark, out) == [lost]
    enrich.run(spark, given, out, clone_url=lambda n: f"file://{path}")
    assert sorted(r["pr_number"] for r in commits.committed(spark, out).collect()) == [7, 8]
    assert commits.forgotten(spark, out) == [lost]


def test_packing_and_groups():
    assert enrich.packed([5, 1, 1, 1, 4], 2) == [0, 1, 0, 1, 1]
    assert enrich.packed([], 3) == []
    assert enrich.grouped([(3, 5), (1, 4), (2, 4), (9, 100), (10, 1)], 8) == [[1, 2], [3], [9], [10]]


def test_a_hot_repository_is_spread_and_shares_a_mirror(spark, origin, tmp_path):
    path, root = origin[0], tmp_path / "clones"
    root.mkdir()
    few = rows(spark, origin, list(range(40)))
    split = enrich.enriched(few, clone_url=lambda n: f"file://{path}", clone_root=str(root), least_chunk=1).select("pr_number", F.col("code").dropFields("debug").alias("code"), F.spark_partition_id().alias("task")).collect()
    whole = enrich.enriched(few, clone_url=lambda n: f"file://{path}", least_chunk=1000).select("pr_number", F.col("code").dropFields("debug").alias("code")).collect()
    assert len({r["task"] for r in split}) >= 6
    assert {r["pr_number"]: r["code"] for r in split} == {r["pr_number"]: r["code"] for r in whole} and len(split) == 40
    assert not [x for d, _, files in os.walk(root) for x in files if not x.endswith(".lock")]


def test_rows_without_repository_spread(spark):
    some = spark.range(200).selectExpr("id", "cast(null as long) as k")
    parts = enrich.dealt(some, "k", "id", rows_per_task=20).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 200 and max(r["count"] for r in parts) < 60


def test_scalars(spark):
    df = spark.createDataFrame([("https://u:p@h/x", b"\xff\xe9abc" + b"z" * 5000, ["a", "b"], "", "q")], "u string, b binary, l array<string>, e string, f string")
    cut, was = text.capped(df["b"], 3)
    few, more = text.limited(df["l"], 1)
    got = df.select(text.redacted_url(df["u"]), cut, was, few, more, text.first_of(df["e"], df["f"]), text.tail(df["b"], 4), text.path_safe(text.clone_url(df["f"])), text.is_commit(df["f"]), text.instant(df["f"])).first()
    assert got[:] == ("https://***:***@h/x", "��a", True, ["a"], True, "q", "zzzz", "https:____github.com__q.git", False, None)
    assert df.select(*text.capped(df["b"], 0), *text.limited(df["l"], 0)).first()[1] is False


def counted(monkeypatch):
    """The git commands that are run from now on."""
    ran, one, pipe = [], gitops.git, gitops.Pipe.__enter__
    monkeypatch.setattr(gitops, "git", lambda *a, **k: (ran.append(a[0]), one(*a, **k))[1])
    monkeypatch.setattr(gitops.Pipe, "__enter__", lambda self: (ran.append(self.args[0]), pipe(self))[1])
    return ran


def test_what_git_said_about_ids_is_not_asked_again(origin, tmp_path, monkeypatch):
    _, base, head = origin
    wants = [want(base, head), want("f" * 40, head), want(base, "e" * 40), want(base, head, number=8), want(head, base)] * 6
    bare = lambda code: {k: v for k, v in code.items() if k != "debug"} | {"tail": code["debug"]["git_stderr_tail"]}
    alone = [bare(gitops.enrich(w, at(origin, tmp_path / str(k)), gitops.Limits())) for k, w in enumerate(wants[:5])] * 6
    ran, repo = counted(monkeypatch), at(origin, tmp_path)("o/r")
    assert [bare(gitops.enrich(w, lambda _: repo, gitops.Limits())) for w in wants] == alone
    assert ran.count("clone") == 1 and ran.count("fetch") == 2 and len(ran) < 60
    gone = gitops.Repository(str(tmp_path / "gone"), "file:///nowhere")
    assert gone.ready() == gone.ready() != "" and ran.count("clone") == 2


def test_answers_are_bounded_and_failures_hold_until_objects_come():
    answers = gitops.Answers(1000)
    for k in range(100):
        assert answers.keep(("x", k), "a" * 100) == "a" * 100
    assert answers.held <= 1000 and 0 < len(answers.good) < 10 and answers.get(("x", 99)) and answers.get(("x", 0)) is None
    answers.keep(("big",), "a" * 2000)
    assert answers.get(("big",)) is None and answers.get(("x", 99))


def test_heads_are_fetched_at_once(origin, tmp_path, monkeypatch):
    """Those that are there by one command, and of the others git is asked about one; all as if asked one by one."""
    path, _, head = origin
    for n in (17, 18, 19, 20):
        subprocess.run(["git", "-C", path, "update-ref", f"refs/pull/{n}/head", head], check=True)
    one, all_ = at(origin, tmp_path / "one")("o/r"), at(origin, tmp_path / "all")("o/r")
    assert one.ready() == all_.ready() == ""
    numbers = [*range(16, 22), 7, *range(100, 140)]
    told = [(one.pull_head(n), one.notes[:], one.notes.clear()) for n in numbers]
    ran = counted(monkeypatch)
    all_.expect(numbers)
    assert [(all_.pull_head(n), all_.notes[:], all_.notes.clear()) for n in numbers] == told
    assert [t[0] for t in told[:7]] == [None, head, head, head, head, None, head] and len(ran) == 4


def test_repositories_of_one_url_share_a_clone(spark, origin):
    path = origin[0]
    some = rows(spark, origin, list(range(60))).withColumn("repo_id", F.col("pr_number")).withColumn("number", F.lit(7))
    some = some.withColumn("pull_request", F.col("pull_request").withField("base", F.col("pull_request.base").withField("repo.full_name", F.concat(F.lit("o/r"), F.col("pr_number"))))).drop("number")
    none = lambda name: f"file://{path}" if int(name[3:]) % 6 else "file:///nowhere"
    got = enrich.enriched(some, clone_url=none).select("pr_number", "code.status", "code.debug.repo_dir", F.spark_partition_id().alias("task")).collect()
    assert [r["status"] for r in sorted(got)] == ["ok" if n % 6 else "error" for n in range(60)]
    # one clone a task, whatever stands between
    assert len({r["repo_dir"] for r in got if r["status"] == "ok"}) == len({r["task"] for r in got if r["status"] == "ok"})
