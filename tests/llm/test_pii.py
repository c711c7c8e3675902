import hashlib
import itertools
import math
import random
import re
from collections import Counter

from mergeweave.llm import pii

from .helpers import ODD, ODD_IDS, SCHEMA, docs, prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


TRICKY = [
    "mail a.b+c@x-y.example.com, a@b.c_d@e.f and a@b a@b.c.d. @x.y",
    "é\U0001f600 10.0.0.255 1.2.3.256.7.8.9 0255.1.1.1 1.2.3.4.5.6.7.8 9999999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 4111  1111 1 2 4111111111111111",
    "+1 (555) 123-4567 +49.30.1234567 +1 +12 34 +1234567890123456 ++1 555 123 4567) +1 555 123 4567+1 555 123 4568",
    "x" * 30_000 + "1" * 40_000 + "a." * 9000 + "@b" + ".c" * 9000,
    "+4111 1111 1111 1111 user%1.2.3.4@host.org",
]


def check(spark, texts, ids=None):
    got = pii.digests(pii.spans(docs(spark, texts, ids))).collect()
    assert len(got) == len(texts)
    ids = range(len(texts)) if ids is None else ids
    want = []
    for i, t in zip(ids, texts):
        base = brute(t)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base)
        want.append((i, *[sum(x[3] == k for x in base) for k in PLAIN], hashlib.sha256(listed.encode()).hexdigest(), listed))
    key = lambda r: (str(r[0]), r[6])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_tricky_texts(spark):
    check(spark, TRICKY)


def test_real_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    check(spark, [r["text"] for r in table], [r["doc_id"] for r in table])


def test_odd_rows_and_empty(spark):
    check(spark, ODD, ODD_IDS)
    assert pii.spans(spark.createDataFrame([], SCHEMA)).count() == 0


def corpus():
    """Five documents in which only "quixotic" tells the address; "common" is everywhere; copies add nothing."""
    texts = [f"{prose(20, k)} Quixotic friend common{k} writes joe@secret.example often common" for k in range(5)]
    texts += [f"{prose(20, 50 + k)} common words" for k in range(40)]
    return texts + ["zanzibar ann@copy.example"] * 6


def test_disclosing_terms(spark):
    texts = corpus()
    table = docs(spark, texts)
    found = pii.spans(table)
    terms = {texts[r["doc_id"]][s["start"] : s["end"]].lower() for r in found.collect() for s in r["terms"]}
    assert terms >= {"quixotic", "friend", "writes", "often"} and "common" not in terms and "zanzibar" not in terms
    base = {r["doc_id"]: r for r in pii.digests(found).collect()}
    assert base[0]["n_email"] == 1 and "term:" in base[0]["spans"] and "term:" not in base[10]["spans"]
    want = brute(texts[0])
    assert base[0]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in want).encode()).hexdigest()
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(table).collect()}
    assert len(clean) == len(texts) and "[email]" in clean[0] and "joe@" not in clean[0] and "uixotic" not in clean[0]
    assert clean[10] == texts[10]


def test_ratio_by_hand(spark):
    texts = corpus() + ["quixotic alone"]
    table = docs(spark, texts)
    found = pii.entities(table)
    got = {r["term"]: r["ratio"] for r in pii.disclosures(table, found).collect()}
    n = len(texts)
    assert abs(got["friend"] - 1) < 1e-9
    assert abs(got["quixotic"] - math.log(5 * n / (6 * 5)) / math.log(n / 5)) < 1e-9 if "quixotic" in got else math.log(5 * n / 30) / math.log(n / 5) < pii.GENERALISE_AT


def test_sanitised_keeps_columns_and_odd_rows(spark):
    out = pii.sanitised(docs(spark, ODD, ODD_IDS))
    assert out.columns == SCHEMA.fieldNames() and out.count() == len(ODD)
    assert {r["text"] for r in out.collect()} == set(ODD)


def test_terms_by_definition(spark):
    """Terms of every strength, of users and of the domains that they share, against the definition: no term that qualifies is pruned, none is added."""
    draw, words = random.Random(5), ["".join(c) for c in itertools.product("bcdf", "aeio", "lmnr")]
    told = {(d, a): f"{x}{y}tell" for d, x in enumerate(("sun", "oak", "elm")) for a, y in enumerate(("one", "two", "six", "ten"))}
    texts, held = [], []
    for i in range(900):
        d = i % 9 if i % 9 < 3 else None
        mine = draw.sample(words, 12) + [w for (e, a), w in told.items() if draw.random() < ((1, 0.9, 0.6, 0.3)[a] if e == d else (0, 0.003, 0.004, 0.01)[a])]
        mail = "" if d is None else f"{'ab'[i % 2]}{'xyz'[d]}@{('sun', 'oak', 'elm')[d]}.example.org"
        texts.append(f"{i} {' '.join(mine)} {i} {mail} {i}")
        held.append([] if d is None else [mail, mail.split("@")[1]])
    beside = [{w for w in re.split("[^a-z]+", t) if len(w) >= pii.TERM} for t in texts]
    n, df_e, df_t = len(texts), Counter(e for x in held for e in x), Counter(w for x in beside for w in x)
    both = Counter((e, w) for x, y in zip(held, beside, strict=True) for e in x for w in y)
    level = math.log(pii.SIGNIFICANCE / sum(both.values()))

    def chance(k, m, q):
        a = k / m
        return -m * (a * math.log(a / q) + ((1 - a) * math.log((1 - a) / (1 - q)) if a < 1 else 0)) if a > q else 0

    want: dict = {}
    for (e, w), k in both.items():
        ratio = math.log(k * n / (df_t[w] * df_e[e])) / math.log(n / df_e[e])
        if ratio >= pii.GENERALISE_AT and min(chance(k, df_e[e], df_t[w] / n), chance(k, df_t[w], df_e[e] / n)) <= level:
            want[w] = max(want.get(w, 0), ratio)
    table = docs(spark, texts)
    got = {r["term"]: r["ratio"] for r in pii.disclosures(table, pii.entities(table)).collect()}
    assert len(want) > 3 and len(want) < len(told) + 9
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
