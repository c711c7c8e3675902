"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source with n documents and the target share w of a mixture of ``size``
documents gets the mean repetition rate w * size / n. How often a document
occurs is the inverse of the Poisson distribution with that mean at a number
that is hashed from the seed and what the document is: its doc_id, its text and,
among rows that are equal in both, its place. So each row has a draw of its own, the same in every run and on
every layout of the rows, without any state. Rows are exploded by their counts
and dealt over the cluster by another hash of the same, which no two copies share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import stored

SEED = 42
#: Mean of one draw at most; a larger mean is the sum of several draws, each with a hash of its own, which is a Poisson number again.
LARGEST = 512.0
#: Up to so many cumulative probabilities (8 bytes each) of all sources go to all tasks; beyond, they are joined by a shuffle.
BROADCAST_NUMBERS = 2_000_000
#: Up to so many groups of rows that are equal in doc_id and text (50 bytes each) go to all tasks; beyond, they are joined by a shuffle.
BROADCAST_TWINS = 200_000


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of seed and keys; a null key counts as empty, a further one that is null as none."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(keys[0].cast("string"), F.lit("")), *[k.cast("string") for k in keys[1:]])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: int | None = None) -> DataFrame:
    """``(source, n, rate)``: the mean number of times that a document of each source is to occur.

    weights: target share of each source, of any positive sum; sources that it
    doesn't name get none. Without weights, shares go with n ** power. size:
    documents of the mixture, as many as there are if None. A null source is a
    source of its own and has no weight in ``weights``.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        target = F.pow(F.col("n").cast("double"), F.lit(float(power)))
    elif weights:
        pairs = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        target = F.coalesce(F.when(F.col("source").isNotNull(), F.element_at(pairs, F.col("source"))), F.lit(0.0))
    else:
        target = F.lit(0.0)
    counts = counts.withColumn("target", target)
    # one row, joined to one row for each source
    total = counts.agg(F.sum("target").alias("targets"), F.sum("n").alias("size"))
    wanted = F.col("size").cast("double") if size is None else F.lit(float(size))
    rate = F.when(F.col("targets") > 0, F.col("target") / F.col("targets") * wanted / F.col("n")).otherwise(0.0)
    return counts.join(F.broadcast(total)).select("source", "n", rate.alias("rate"))


def distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... at a Poisson mean of at most ``LARGEST``, as far as they tell from 1 in double precision; summed in logarithms, so that they don't underflow."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    zero = F.struct(F.lit(0.0).alias("lf"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        lf = state["lf"] + F.when(k > 0, F.log(k.cast("double"))).otherwise(0.0)
        at = state["sum"] + F.exp(F.when(k > 0, k * F.log(rate)).otherwise(0.0) - rate - lf)
        return F.struct(lf.alias("lf"), at.alias("sum"), F.concat(state["cdf"], F.array(at)).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(0), last), zero, step)["cdf"]
    return F.when(rate > 0, cdf).otherwise(F.array(F.lit(2.0)))


def identified(docs: DataFrame) -> DataFrame:
    """``(doc, source, identity)`` of each row: a text that no other row has, of doc_id, a hash of the text and, from the second on, the place among rows equal in both.

    Places go from 1 to the number of such rows on any layout. Only rows that
    have equals are numbered: within each task that read them, after those that
    tasks before it read, so a large group stays spread.
    """
    th = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("string").alias("id"), F.col("source"), th.alias("th"))
    twins = stored(rows.groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("t_id"), F.col("th").alias("t_th")), "twins")
    few = twins.limit(BROADCAST_TWINS + 1).count()
    named = F.concat_ws(":", F.coalesce("id", F.lit("")), "th")
    if not few:
        return rows.select("doc", "source", named.alias("identity"))
    same = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("th") == F.col("t_th"))
    twins = F.broadcast(twins) if few <= BROADCAST_TWINS else twins
    alone = rows.join(twins, same, "left_anti").select("doc", "source", named.alias("identity"))
    equal = stored(rows.join(twins, same, "left_semi").withColumn("task", F.spark_partition_id()), "equal")
    counts = equal.groupBy("id", "th", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("id", "th").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("id").alias("s_id"), F.col("th").alias("s_th"), F.col("task").alias("s_task"), before.alias("before"))
    numbered = equal.withColumn("nth", F.row_number().over(Window.partitionBy("id", "th", "task").orderBy(F.lit(0))))
    placed = numbered.join(starts, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("th") == F.col("s_th")) & (F.col("task") == F.col("s_task")))
    place = F.col("before") + F.col("nth")
    return alone.unionByName(placed.select("doc", "source", F.concat_ws(":", named, F.when(place > 1, place.cast("string"))).alias("identity")))


def copies(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: int | None = None, seed: int = SEED) -> DataFrame:
    """``(doc, identity, copies)``: each row of ``docs`` as a struct, what tells it from others, and how often it is to occur."""
    rated = rates(docs, weights, power, size).withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST)).cast("int"))
    cdfs = rated.select(F.col("source").alias("of"), "draws", distribution(F.col("rate") / F.col("draws")).alias("cdf"))
    if (cdfs.agg(F.sum(F.size("cdf") + 4)).first()[0] or 0) <= BROADCAST_NUMBERS:
        cdfs = F.broadcast(cdfs)
    rows = identified(docs).withColumnRenamed("source", "from")
    # the first draw's key is the document's alone
    drawn = F.transform(F.sequence(F.lit(1), F.col("draws")), lambda j: uniform(seed, F.col("identity"), F.when(j > 1, j)))
    count = lambda u: F.size(F.filter("cdf", lambda c: c <= u))
    total = F.aggregate(F.col("drawn"), F.lit(0), lambda n, u: n + count(u))
    joined = rows.join(cdfs, F.col("from").eqNullSafe(F.col("of"))).withColumn("drawn", drawn)
    return joined.select("doc", "identity", F.when(F.element_at("cdf", 1) > 1, F.lit(0)).otherwise(total).alias("copies"))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixture: all columns of ``docs``, ``copy`` (1 and up) and ``shuffle_key`` (long), in the order of that key within each part.

    Rows go to a part by their key's hash and are sorted by it there, so the
    parts one after the other are a random order of the whole. Repeated rows
    and rows without doc_id have a draw each. Null texts (which count as empty
    for the draw) and sources are kept as they are, texts may be of any length. An empty table
    gives an empty mixture. Columns of the input named ``copy`` or
    ``shuffle_key`` are replaced; all other names may occur.
    """
    counted = copies(docs, weights, power, size, seed).where("copies > 0")
    exploded = counted.select("doc", "identity", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    text = F.concat_ws(":", F.lit(str(seed)), F.lit("order"), "identity", F.col("copy").cast("string"))
    keyed = exploded.withColumn("shuffle_key", F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long"))
    dealt = keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc.doc_id", "copy")
    return dealt.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in ("copy", "shuffle_key")], "copy", "shuffle_key")
