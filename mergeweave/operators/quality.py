"""Which pull requests are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import issue_references, mentions_bump, stripped


def worth_keeping(pr: Column) -> Column:
    """Merged into main or master, more than 10 characters of body, 1 to 15 changed files, at most one issue referred to, no trivial update."""
    body = F.coalesce(pr["body"], F.lit(""))
    return F.coalesce(
        pr["merged"]
        & pr["base"]["ref"].isin("main", "master")
        & pr["changed_files"].between(1, 15)
        & (F.length(stripped(body)) > 10)
        & ~mentions_bump(pr["title"])
        & ~mentions_bump(body)
        & (F.size(issue_references(body)) <= 1),
        F.lit(False),
    )


def kept(pr_rows: DataFrame) -> DataFrame:
    return pr_rows.where(worth_keeping(F.col("pull_request")))
