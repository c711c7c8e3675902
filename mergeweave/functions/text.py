"""Scalar functions on text, bytes and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of trivial updates.
BUMP_TERMS = [
    "bump", "bumps", "bumped", "bumping", "version bump", "bump version", "dependency bump", "dependencies bump", "dep bump", "deps bump",
    "upgrade dependency", "upgrade dependencies", "update dependency", "update dependencies", "chore: bump", "chore bump", "chore(deps)", "chore(deps):",
    "renovate", "dependabot",
]


def stripped(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def mentions_bump(text: Column) -> Column:
    """Whether a text holds a word of trivial updates, whatever its case; false for null."""
    minimal = [t for t in BUMP_TERMS if not any(o != t and o in t for o in BUMP_TERMS)]
    found = F.lit(False)
    for term in minimal:
        found = found | F.contains(F.lower(text), F.lit(term))
    return F.coalesce(found, F.lit(False))


def issue_references(text: Column) -> Column:
    """Distinct numbers of ``#N`` that no word character stands before."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(?<![A-Za-z0-9_])#(\d+)\b"), F.lit(1)))


def redacted_url(url: Column) -> Column:
    """Without user and password."""
    return F.regexp_replace(url, r"//([^/@]+)@", "//***:***@")


def clone_url(full_name: Column) -> Column:
    return F.concat(F.lit("https://github.com/"), full_name, F.lit(".git"))


def path_safe(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("__"))


def capped(data: Column, limit: int) -> tuple[Column, Column]:
    """Text of at most ``limit`` bytes (0: all), with U+FFFD for what a cut or invalid bytes leave, and whether it was cut."""
    if limit <= 0:
        return F.make_valid_utf8(data.cast("string")), F.lit(False)
    return F.make_valid_utf8(F.substring(data, 1, limit).cast("string")), F.octet_length(data) > limit


def tail(data: Column, limit: int = 4000) -> Column:
    """The last bytes as text."""
    return F.make_valid_utf8(F.substring(data, -limit, limit).cast("string"))


def is_commit(sha: Column) -> Column:
    return F.coalesce(sha.rlike("^[0-9a-f]{40}$"), F.lit(False))


def first_of(*columns: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def instant(text: Column) -> Column:
    """An ISO-8601 text as timestamp, null if it is none."""
    return F.try_to_timestamp(text)


def limited(items: Column, limit: int) -> tuple[Column, Column]:
    """The first ``limit`` items (0 or less: all), and whether there were more."""
    if limit <= 0:
        return items, F.lit(False)
    return F.slice(items, 1, limit), F.size(items) > limit
