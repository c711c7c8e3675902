import hashlib
import random
import zlib
from functools import cache

import pytest

from mergeweave.llm import repair
from mergeweave.llm.queries import op11_repair

SPACE = " \t\n\x0b\x0c\r"


def harm(rows):
    out = []
    for conv, turn, role, text in rows:
        told = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
KEEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def fix(turns, faults):
    """By definition, turn by turn and state by state: (cost, audit, turns)."""
    n = len(turns)

    @cache
    def best(i, q, inserts=0):
        found = [(0, "", ())] if i == n and q in ("", "a") else []
        if inserts < 3:
            c, a, out = best(i, NEXT[q], inserts + 1)
            role = {"u": "user", "a": "assistant"}[NEXT[q]]
            found.append((c + 2, "I" + a, ((role, ""), *out)))
        if i < n:
            role, text = turns[i]
            c, a, out = best(i + 1, q)
            found.append((c + 3, "D" + a, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 1 if faults[i] == "truncated" else 0
                if (q, role[:1]) in KEEPS:
                    c, a, out = best(i + 1, KEEPS[q, role[:1]])
                    found.append((c + more, "K" + a, ((role, text), *out)))
                c, a, out = best(i + 1, NEXT[q])
                found.append((c + 2 + more, "R" + a, (({"u": "user", "a": "assistant"}[NEXT[q]], text), *out)))
        return min(found, default=(1 << 40, "", ()))

    return best(0, "")


def brute(rows, ids):
    out = []
    for conv in ids:
        own = sorted((r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in rows if r[0] == conv)
        turns, faults, seen = [(r, t) for _, _, r, t in own], [], set()
        for r, t in turns:
            said = t.rstrip(SPACE)
            faults.append("blank" if not said else "duplicate" if (r, t) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((r, t))
        told = [x[1] for x in own if x[0]]
        gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:], strict=False))
        cost, audit, fixed = fix(tuple(turns), tuple(faults))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def drawn(seed, conversations=120):
    r = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(r.choice([0, 1, 1, 2, 3, 5, 8, 13])):
            role = r.choice(["system", "user", "assistant", "user", "assistant", "user", "assistant", "tool", "", None, "uncle"])
            text = r.choice(["Yes.", "No", "Why? ", "", " \n", None, f"{turn}!", f"{turn}", "é."])
            at = r.choice([turn, turn, turn, turn, None, turn // 2, turn * 3 - 5])
            rows += [(conv if conv else None, at, role, text)] * r.choice([1, 1, 1, 1, 2, 3])
    return rows


def table(spark, rows, parts=3):
    more = "part long, whole string, copies string, cut long, time long, fate long"
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, 4) for r in rows], f"conv_id long, turn long, role string, text string, {more}").repartition(parts)


def shown(df):
    return sorted((tuple(r) for r in df.select("conv_id", *repair._TOTALS, "audit", "repaired_sha256").collect()), key=str)


@pytest.mark.parametrize(("rows", "size"), [(1 << 16, 8_000_000), (3, 8_000_000), (1, 8_000_000), (1 << 16, 4)])
def test_as_by_definition(spark, rows, size):
    given = drawn(rows + size)
    ids = {r[0] for r in given}
    assert shown(repair.report(table(spark, given), rows=rows, size=size)) == brute(given, ids)


def test_damage_and_given_table(spark, data):
    given = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert shown(op11_repair(spark, data)) == brute(harm(given), {r[0] for r in given})
    odd = drawn(5)
    made = repair.damaged(table(spark, odd)).collect()
    assert sorted((tuple(r) for r in made), key=str) == sorted(harm(odd), key=str)
    ids = table(spark, odd)
    assert shown(repair.report(repair.damaged(ids), ids)) == brute(harm(odd), {r[0] for r in odd})


def test_repaired_turns(spark):
    given = drawn(11)
    rows = repair.repaired(table(spark, given)).orderBy("part", "seq", "pos").collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv in {r[0] for r in given}:
        got = by.get(conv, [])
        initials = "".join(role[0] for role, _ in got).removeprefix("s")
        assert initials == "ua" * (len(initials) // 2)
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in got).encode()).hexdigest() == brute(given, {conv})[0][-1]


def test_hot_conversation_and_hot_row(spark):
    r = random.Random(3)
    given = [(7, k, r.choice(["user", "assistant", "user", "assistant", "system"]), r.choice([f"{k}.", f"{k}", "", "same."])) for k in range(4000)]
    given += [(7, 2, "user", "copy.")] * 3000 + [(k, 0, "user", "Hello.") for k in range(100, 400)]
    parts = repair.segments(table(spark, given, 6), rows=500)
    assert parts.where("conv_id = 7").count() >= 8
    import sys

    sys.setrecursionlimit(40_000)
    got, want = shown(repair.report(table(spark, given, 6), rows=500)), brute_of_long(given)
    assert got == want


def brute_of_long(rows):
    """``brute`` without recursion: the same rules, from the last turn on, with audits as linked lists cut to ranks."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r[1], r[2], r[3]) for r in rows if r[0] == conv)
        seen, faults = set(), []
        for _, r, t in own:
            said = t.rstrip(SPACE)
            faults.append("blank" if not said else "duplicate" if (r, t) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((r, t))
        # state -> (cost, audit, turns); audits are compared as strings
        left = {"": (0, "", None), "s": (4, "II", (("user", ""), (("assistant", ""), None))), "u": (2, "I", (("assistant", ""), None)), "a": (0, "", None)}
        for i in range(len(own) - 1, -1, -1):
            _, role, text = own[i]
            now = {}
            for q in left:
                c, a, o = left[q]
                found = [(c + 3, "D" + a, o)]
                if faults[i] not in ("blank", "duplicate"):
                    more = faults[i] == "truncated"
                    if (q, role[:1]) in KEEPS:
                        c, a, o = left[KEEPS[q, role[:1]]]
                        found.append((c + more, "K" + a, ((role, text), o)))
                    c, a, o = left[NEXT[q]]
                    found.append((c + 2 + more, "R" + a, (({"u": "user", "a": "assistant"}[NEXT[q]], text), o)))
                now[q] = min(found, key=lambda x: x[:2])
            for _ in range(3):
                for q in now:
                    c, a, o = now[NEXT[q]]
                    now[q] = min(now[q], (c + 2, "I" + a, (({"u": "user", "a": "assistant"}[NEXT[q]], ""), o)), key=lambda x: x[:2])
            left = now
        cost, audit, o = left[""]
        fixed = []
        while o:
            fixed.append(o[0])
            o = o[1]
        told = [x[0] for x in own]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, max(told) - min(told) + 1 - len(set(told)), *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def test_empty_and_long(spark):
    none = table(spark, []).limit(0)
    assert repair.report(none).count() == 0 and repair.report(none, none).count() == 0
    given = [(1, 0, "user", "x" * 3_000_000), (1, 1, "assistant", "y" * 2_000_000 + "."), (2, 0, "system", "Be.")]
    assert shown(repair.report(table(spark, given))) == brute(given, {1, 2})
