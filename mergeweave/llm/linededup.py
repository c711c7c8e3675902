"""Line deduplication by range-partitioned hashes. DataFrame functions only.

Every line gets a 128-bit hash of its key. Hashes are range-partitioned together
with document and position, so that a very common line spreads over as many
parts as it needs, and sorted by hash, document and position. In that order a
part streams the first occurrence of each key in each document; counts of
documents and the very first occurrence follow from these by sums and minima
that combine before they are shuffled. What comes back is no text but a bitmap
for each document, as lengths of alternating runs of kept and dropped lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to so many keys to drop go to all tasks (24 bytes each); beyond, they are joined by a shuffle.
BROADCAST_KEYS = 200_000


def lines_of(text: Column) -> Column:
    """Lines at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def _hash_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def occurrences(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """``(doc_id, th, pos, h1, h2)`` of every line; th is a hash of the text. h1 and h2 are null for keys below ``least_chars`` code points, which are always kept."""
    lines = docs.select("doc_id", _hash_of(F.col("text")).alias("th"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).withColumn("key", key_of(F.col("line")))
    counts = F.length("key") >= least_chars
    return lines.select(
        "doc_id",
        "th",
        "pos",
        F.when(counts, F.xxhash64("key")).alias("h1"),
        F.when(counts, F.xxhash64(F.lit(7), "key")).alias("h2"),
    )


def verdicts(found: DataFrame) -> DataFrame:
    """``(h1, h2, n_docs, doc_id, pos)`` of each key: the documents that have it and its first occurrence by document and position."""
    ranged = found.where("h1 is not null").repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "pos")
    first = ranged.groupBy("h1", "h2", "doc_id").agg(F.min("pos").alias("pos"))
    return first.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "pos")).alias("first")).select("h1", "h2", "n_docs", "first.doc_id", "first.pos")


def bitmaps(docs: DataFrame, min_docs: int = 10, keep: str = "none", least_chars: int = 1) -> DataFrame:
    """``(doc_id, th, n_lines, n_dropped, runs)`` of each document of ``docs(doc_id, text, ...)``; th is a hash of its text.

    Lines whose key occurs in ``min_docs`` documents or more are dropped: all of
    them (keep "none"), or all but the first by document and position ("first").
    runs: lengths of alternating runs of kept and dropped lines, kept first
    (maybe 0). Null or empty texts are one empty line, which stays. Rows that
    share a doc_id count as one document, with a bitmap for each different
    text; so do rows without doc_id. An empty table gives an empty result.
    """
    if keep not in ("none", "first"):
        raise ValueError(keep)
    found = stored(occurrences(docs, least_chars), "lines")
    common = stored(verdicts(found).where(F.col("n_docs") >= min_docs), "keys")
    small = common.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    drop = common.select("h1", "h2", F.col("doc_id").alias("__doc"), F.col("pos").alias("__pos"), F.lit(True).alias("__hit"))
    hashed = found.where("h1 is not null").join(F.broadcast(drop) if small else drop, ["h1", "h2"], "left")
    # of texts that share a doc_id, each keeps its line at the position of the first occurrence
    is_first = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("pos") == F.col("__pos"))
    dropped = F.col("__hit").isNotNull() & (~is_first if keep == "first" else F.lit(True))
    every = hashed.select("doc_id", "th", "pos", dropped.alias("drop")).unionByName(found.where("h1 is null").select("doc_id", "th", "pos", F.lit(False).alias("drop")))
    grouped = every.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct("pos", "drop"))).alias("lines"),
    )
    bits = F.array_join(F.transform("lines", lambda x: F.when(x["drop"], F.lit("0")).otherwise(F.lit("1"))), "")
    runs = F.transform(F.regexp_extract_all(F.col("bits"), F.lit("1++|0++"), F.lit(0)), lambda x: F.length(x))
    return grouped.select(
        "doc_id",
        "th",
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x["drop"])).cast("long").alias("n_dropped"),
        bits.alias("bits"),
    ).select("doc_id", "th", "n_lines", "n_dropped", F.when(F.col("bits").startswith("0"), F.concat(F.array(F.lit(0)), runs)).otherwise(runs).alias("runs"))


def apply(docs: DataFrame, maps: DataFrame) -> DataFrame:
    """``docs`` with ``kept_text`` (the text of its kept lines, joined by line feeds), ``n_lines`` and ``n_dropped``.

    Only bitmaps that drop something are joined; other texts are their own
    result. Columns of ``docs`` with one of these three names are replaced; all
    other names may occur. Repeated rows each have a result. A text is handled
    within its row, however long.
    """
    cut = maps.where("n_dropped > 0").select(F.col("doc_id").alias("cut_id"), F.col("th").alias("cut_th"), F.col("n_dropped").alias("cut_n"), "runs")
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), "text").withColumn("own_th", _hash_of(F.col("text")))
    flags = F.flatten(F.transform("runs", lambda n, i: F.array_repeat(i % 2 == 0, n)))
    joined = rows.join(cut, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("own_th") == F.col("cut_th")), "left").withColumn("lines", lines_of(F.col("text"))).withColumn("flags", flags)
    kept = F.array_join(F.filter("lines", lambda x, i: F.element_at("flags", i + 1)), "\n")
    done = joined.select(
        "doc",
        F.when(F.col("runs").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(kept).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.col("cut_n"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    new = ("kept_text", "n_lines", "n_dropped")
    return done.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c not in new], *new)
