import math

from pyspark.sql import functions as F

from mergeweave.llm import pii

from .helpers import docs, prose
from .test_pii import brute

SF = "/root/testdata/sf0.01/documents.parquet"


def planted(spark, texts):
    """Real documents of middling length, the first of them changed: id to text."""
    real = spark.read.parquet(SF).select("doc_id", "text")
    ids = [r["doc_id"] for r in real.where("length(text) between 600 and 3000").orderBy("doc_id").limit(len(texts)).collect()]
    table = real
    for i, (a, b) in zip(ids, texts, strict=True):
        table = table.withColumn("text", F.when(F.col("doc_id") == i, F.concat(F.lit(a + " "), F.col("text"), F.lit(" " + b))).otherwise(F.col("text")))
    return ids, spark.createDataFrame([tuple(r) for r in table.collect()], "doc_id long, text string")


def test_planted_term_in_real_documents(spark):
    """A term at the other end of texts, far from the entity that it tells of."""
    _, table = planted(spark, [("Quixotterly", "joe@planted.example")] * 3)
    terms = {r["term"]: r["ratio"] for r in pii.disclosures(table, pii.entities(table)).collect()}
    assert abs(terms["quixotterly"] - 1) < 1e-9 and terms.keys() <= {"quixotterly", "joe", "planted", "example"}  # the entity has words itself


def test_term_of_a_domain_whose_addresses_each_stand_in_one_document(spark):
    ids, table = planted(spark, [("ACMETTERLY", f"p{k}@acmetter.example") for k in range(4)])
    out = {r["doc_id"]: r["text"] for r in pii.sanitised(table).collect()}
    before = {r["doc_id"]: r["text"] for r in table.collect()}
    assert all("acmetter" not in out[i].lower() and out[i].endswith("[email]") for i in ids)
    assert all(len(out[i]) == len(t) for i, t in before.items() if "@" not in (t or "") and not brute(t))


def belongs(kind, value):
    digits = "".join(c for c in value if c.isdigit())
    return {"email": value.split("@")[-1].lower(), "ip": ".".join(value.split(".")[:3]), "card": digits[:6], "phone": digits[:-7]}[kind]


def brute_ratios(texts):
    """The ratio of every term that passes, by definition, for texts without copies and each with other surroundings."""
    import re

    words = [{w for w in re.split(r"[^a-z]+", t.lower()) if len(w) >= pii.TERM} for t in texts]
    held = {}
    for k, t in enumerate(texts):
        for a, _, b, kind in brute(t):
            value = t[a:b]
            own = value.lower() if kind == "email" else value if kind == "ip" else "".join(c for c in value if c.isdigit())
            held.setdefault((0, kind, own), set()).add(k)
            held.setdefault((1, kind, belongs(kind, value)), set()).add(k)
    members = {}
    for k, t in enumerate(texts):
        for a, _, b, kind in brute(t):
            members.setdefault((kind, belongs(kind, t[a:b])), set()).add(t[a:b].lower())
    held = {(level, kind, v): d for (level, kind, v), d in held.items() if level == 0 or len(members[kind, v]) > 1}
    tests = sum(len(words[k]) for docs_ in held.values() for k in docs_)
    n, out = len(texts), {}

    def chance(k, m, q):
        a = k / m
        return -m * (a * math.log(a / q) + ((1 - a) * math.log((1 - a) / (1 - q)) if a < 1 else 0)) if a > q else 0.0

    for docs_ in held.values():
        for term in set().union(*(words[k] for k in docs_)):
            joint = sum(term in words[k] for k in docs_)
            df = sum(term in w for w in words)
            ratio = math.log(joint * n / (df * len(docs_))) / math.log(n / len(docs_)) if len(docs_) < n else 0
            if ratio >= pii.GENERALISE_AT and min(chance(joint, len(docs_), df / n), chance(joint, df, len(docs_) / n)) <= math.log(pii.SIGNIFICANCE / tests):
                out[term] = max(ratio, out.get(term, 0))
    return out


def test_ratios_as_by_definition(spark):
    texts = [f"{prose(12, k)} plain{'' if k % 5 else ' secretly'} filler{chr(97 + k % 7)}" for k in range(260)]
    for k in range(0, 40, 5):
        texts[k] += f" host 10.9.{k}.1 near tower box{k}@corp.example here"
    for k in range(1, 25, 4):
        texts[k] += f" call +49 30 555{k:04d} berlin or +1 212 5550000 uptown once{k}"
    want = brute_ratios(texts)
    table = docs(spark, texts)
    got = {r["term"]: r["ratio"] for r in pii.disclosures(table, pii.entities(table)).collect()}
    assert len(want) >= 4 and got.keys() == want.keys()
    assert all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_parts_make_no_difference(spark, monkeypatch):
    _, table = planted(spark, [("ACMETTERLY", f"p{k}@acmetter.example") for k in range(4)])
    found = pii.entities(table)
    one = sorted(map(tuple, pii.disclosures(table, found).collect()))
    monkeypatch.setattr(pii, "TEXTS", 2)
    monkeypatch.setattr(pii, "BROADCAST_TERMS", 1)
    assert sorted(map(tuple, pii.disclosures(table, found).collect())) == one and one


def test_very_many_matches(spark):
    text = "é " + " ".join(f"a{k}@b.cc" for k in range(3_000))
    got = pii.digests(pii.spans(docs(spark, [text]))).first()
    assert got["n_email"] == 3_000 and got["spans"] == ",".join(f"email:{a}:{b}" for a, _, b, _ in brute(text))


def test_names_of_its_own(spark):
    names = ["cuts", "cut_id", "doc", "id", "own", "done", "new", "__own", "th", "spans", "a.b"]
    table = docs(spark, ["mail me@x.example now", None]).select("doc_id", "text", *[F.lit("x").alias(n) for n in names])
    out = pii.sanitised(table)
    assert out.columns == table.columns
    assert {(r["text"], r["cuts"], r["a.b"]) for r in out.collect()} == {("mail [email] now", "x", "x"), (None, "x", "x")}
