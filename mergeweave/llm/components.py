"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import stored

#: A key with more than this share of the links is hot; there are twice as many hot keys at most as such shares.
SHARE = 256


def matched(rows: DataFrame, by_key: DataFrame, key: str, links: int) -> DataFrame:
    """``rows`` joined to ``by_key(key, n, ...)``, whose n says how many of ``links`` the key has.

    Hot keys, of which there can be no more than ``2 * SHARE``, go to all tasks;
    so no task has to take all rows of one. The rest meets by a shuffle.
    """
    hot = F.col("n") > max(64, links // SHARE)
    few = F.broadcast(by_key.where(hot))
    rest = rows.join(F.broadcast(by_key.where(hot).select(key)), key, "left_anti").join(by_key.where(~hot), key)
    return rows.join(few, key).unionByName(rest)


def _mark(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return row[0], row[1] or 0


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links(a, b)`` of longs to ``(node, root)``: root is the smallest node reachable, rows with node = root are left out.

    Every round is two grouped minima and two joins whose one side has a row for
    each key; the centre of a large star is spread over tasks. Rounds are
    written to the shared folder; their number grows with the logarithm of the
    largest component. Nothing is collected but a count and a checksum. Self
    links and links with a null end are ignored; no links give an empty table.
    """
    links = (
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    now = stored(links, "links")
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = stored(matched(both.where("v > u"), least, "u", mark[0]).select(F.col("v").alias("a"), F.col("m").alias("b")), "large")
        lower = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = (
            matched(large, lower, "a", mark[0])
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(lower.select("a", "m"))
            .distinct()
        )
        now = stored(small, "links")
        before, mark = mark, _mark(now)
        if before == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if mark[0]:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
