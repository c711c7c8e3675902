"""Documents that every operator must stand, and others to compare with brute force."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        *[T.StructField(n, T.StringType()) for n in ("fp", "score", "node", "th", "key", "rate", "copies", "part", "seq")],
    ]
)

WORDS = "the of and to alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(n, seed=1):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (f"{r.randrange(1000)}" if r.random() < 0.5 else "") for _ in range(n))


def rows(texts, ids=None, sources=None):
    out = []
    for k, t in enumerate(texts):
        i = k if ids is None else ids[k]
        s = "s" if sources is None else sources[k]
        out.append((i, t, None, s, None if t is None else len(t), *["x"] * 9))
    return out


def docs(spark, texts, ids=None, sources=None, parts=3):
    return spark.createDataFrame(rows(texts, ids, sources), SCHEMA).repartition(parts)


ODD = [None, "", " \n\t", "one", "One  two", prose(30), prose(30), prose(20_000, 7), "á \U0001f600 x y\n\nz", "\x00 \x1c q"]
#: The third and last texts come with the same id; one id is missing.
ODD_IDS = [1, 2, 3, 4, 5, 6, 7, 8, None, 3]
