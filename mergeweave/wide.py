"""Archive events of all types with all fields, made of the table ``events``: JSON by a schema's rule, and what must come of it as SQL.

A rule gives each leaf of a schema its value from the event's number: ``@`` in a
template stands for it. The lines hold members in reverse order; every third
event has values of other types than are asked for, of which digits in strings
count and nothing else. The answer is the same template in the schema's order.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import schemas as S

#: Type of an event by its number modulo 12, and the payload's members by the schema that they have.
KINDS = [
    ("PullRequestEvent", {"pull_request": S.PULL_REQUEST}),
    ("PullRequestReviewEvent", {"pull_request": S.PULL_REQUEST, "review": S.REVIEW}),
    ("PullRequestReviewCommentEvent", {"pull_request": S.PULL_REQUEST, "comment": S.COMMENT}),
    ("IssueCommentEvent", {"issue": S.ISSUE, "comment": S.COMMENT}),
    ("CommitCommentEvent", {"comment": S.COMMENT}),
    ("StatusEvent", {"": S.STATUS}),
    ("status", {"": S.STATUS}),
    ("CheckRunEvent", {"check_run": S.CHECK_RUN}),
    ("check_run", {"check_run": S.CHECK_RUN}),
    ("CheckSuiteEvent", {"check_suite": S.CHECK_SUITE}),
    ("check_suite", {"check_suite": S.CHECK_SUITE}),
    ("PushEvent", {"": S.PUSH}),
]
PAYLOADS = ["pull_request", "issue", "comment", "review", "push", "status", "check_run", "check_suite"]


def _value(kind: T.DataType, name: str, odd: bool, given: bool):
    """The template of a value; given: as the line has it, else as it must come out (None: not at all)."""
    if isinstance(kind, T.StructType):
        return _object(kind, odd, given)
    if isinstance(kind, T.ArrayType):
        return [_object(kind.elementType, odd, given)]
    if isinstance(kind, T.LongType):
        return "1@" if odd and given else "#1@#"
    if isinstance(kind, T.BooleanType):
        return ("true" if given else None) if odd else True
    return ("#2@#" if given else None) if odd else f"{name} @ é"


def _object(struct: T.StructType, odd: bool, given: bool) -> dict:
    fields = [f for f in struct.fields if not f.name.endswith("_extra_json")]
    made = {f.name: _value(f.dataType, f.name, odd, given) for f in (reversed(fields) if given else fields)}
    extra = {"zz": "#@#"} if given else {}
    return {k: v for k, v in made.items() if v is not None} | extra


def _text(value) -> str:
    """JSON without spaces; what stands between #s is a number."""
    return json.dumps(value, ensure_ascii=False, separators=(",", ":")).replace('"#', "").replace('#"', "")


def given(number: int, odd: bool) -> str:
    """The line's template of an event type."""
    name, parts = KINDS[number]
    payload: dict = {"action": "done", "number": "#7@#"}
    for member, struct in parts.items():
        made = _object(struct, odd, True)
        payload = payload | made if member == "" else payload | {member: made}
    if "issue" in parts:
        payload["issue"] = {**payload["issue"], "pull_request": None}
    event = {"payload": payload, "actor": _object(S.USER, odd, True), "type": name, "id": "@", "created_at": "t@", "public": True, "repo": {"id": "#@#", "name": "o/r@"}}
    return _text(event)


def expected(number: int, odd: bool, member: str, schema: T.StructType | None = None) -> str | None:
    """The template of a payload struct as it must come out, by another schema if given; None if the type has no such."""
    parts = KINDS[number][1]
    struct = parts.get(member, parts.get("") if member in ("push", "status") and S.event_struct(member) == parts.get("") else None)
    return None if struct is None else _text(_object(schema or struct, odd, False))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: a line for each event of the table; types by event_id modulo 12."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id").repartition(spark.sparkContext.defaultParallelism)
    number, odd = F.col("event_id") % len(KINDS), F.col("event_id") % 3 == 0
    template = F.lit(None).cast("string")
    for k in range(len(KINDS)):
        template = F.when((number == k) & odd, given(k, True)).when((number == k) & ~odd, given(k, False)).otherwise(template)
    return e.select(F.replace(template, F.lit("@"), F.col("event_id").cast("string")).alias("value"))


def _sql_text(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def sql(member: str, schema: T.StructType | None = None) -> str:
    """SQL of a payload struct as JSON, from event_id."""
    texts = [[_sql_text(expected(k, odd, member, schema)) for odd in (True, False)] for k in range(len(KINDS))]
    cases = " ".join(f"WHEN event_id % {len(KINDS)} = {k} THEN CASE WHEN event_id % 3 = 0 THEN {a} ELSE {b} END" for k, (a, b) in enumerate(texts))
    return f"replace(CASE {cases} END, '@', event_id::VARCHAR)"


def actor_sql() -> str:
    return f"replace(CASE WHEN event_id % 3 = 0 THEN {_sql_text(_text(_object(S.USER, True, False)))} ELSE {_sql_text(_text(_object(S.USER, False, False)))} END, '@', event_id::VARCHAR)"


def type_sql() -> str:
    return "CASE event_id % 12 " + " ".join(f"WHEN {k} THEN '{name}'" for k, (name, _) in enumerate(KINDS)) + " END"
