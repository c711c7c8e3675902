"""Strict reading of JSON: a value counts only if it has the type that is asked for.

``from_json`` would turn numbers into strings and drop numbers in strings, so
lines are parsed to VARIANT once and every leaf is guarded by the type it has.
One projector walks a schema and writes the SQL for it. Each object is read once,
into a struct of variants that is bound as the variable of a lambda; the wide
projection is evaluated as it stands, where generated code would outgrow what the
JVM compiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _at(v: str, path: str) -> str:
    return f"try_variant_get({v}, '{path}', 'variant')"


def _string(x: str) -> str:
    return f"CASE WHEN schema_of_variant({x}) = 'STRING' THEN try_variant_get({x}, '$', 'string') END"


def _boolean(x: str) -> str:
    return f"CASE WHEN schema_of_variant({x}) = 'BOOLEAN' THEN try_variant_get({x}, '$', 'boolean') END"


def _bigint(x: str) -> str:
    get = lambda kind: f"try_variant_get({x}, '$', '{kind}')"
    kind = f"schema_of_variant({x})"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {kind} = 'BIGINT' THEN {get('bigint')} "
        f"WHEN startswith({kind}, 'DECIMAL') THEN try_cast({get('decimal(38,18)')} AS BIGINT) "
        f"WHEN {kind} IN ('DOUBLE', 'FLOAT') THEN try_cast({get('double')} AS BIGINT) "
        f"WHEN {kind} = 'STRING' AND {get('string')} RLIKE '^[0-9]+$' THEN try_cast({get('string')} AS BIGINT) END"
    )


_LEAVES = {T.StringType(): _string, T.LongType(): _bigint, T.BooleanType(): _boolean}


def _is_object(x: str) -> str:
    """With a key or more. One level of the object is looked at, not all that is in it. Of anything else the size is null."""
    return f"size(try_variant_get({x}, '$', 'map<string,variant>')) > 0"


def _elements(x: str) -> str:
    return f"try_variant_get({x}, '$', 'array<variant>')"


def _extras(x: str, known: list[str], keep: bool) -> str:
    if not keep:
        return "CAST(NULL AS BINARY)"
    listed = ", ".join(f"'{k}'" for k in known)
    rest = f"map_filter(try_variant_get({x}, '$', 'map<string,variant>'), (k, w) -> k NOT IN ({listed}))"
    return f"CASE WHEN {_is_object(x)} AND size({rest}) > 0 THEN encode(to_json({rest}), 'UTF-8') END"


def _struct(x: str, struct: T.StructType, keep: bool, silent: list[str], depth: int) -> str:
    """SQL of the object ``x`` as ``struct``: one pass gives its members as variants, which are then read by their types."""
    names = [f.name for f in struct.fields if not f.name.endswith("_extra_json")]
    s = f"s{depth}"
    members = ",".join(f"`{n}`:variant" for n in names)
    fields = ", ".join(f"'{f.name}', {_field(x, s, f, names + silent, keep, depth)}" for f in struct.fields)
    some = f"coalesce({', '.join(f'{s}.`{n}`' for n in names)}) IS NOT NULL"
    return f"transform(array(try_variant_get({x}, '$', 'struct<{members}>')), {s} -> CASE WHEN {s} IS NOT NULL AND ({some} OR {_is_object(x)}) THEN named_struct({fields}) END)[0]"


def _field(x: str, s: str, field: T.StructField, known: list[str], keep: bool, depth: int) -> str:
    if field.name.endswith("_extra_json"):
        return _extras(x, known, keep)
    member = f"{s}.`{field.name}`"
    if isinstance(field.dataType, T.StructType):
        return _struct(member, field.dataType, keep, [], depth + 1)
    if isinstance(field.dataType, T.ArrayType):
        inner = f"x{depth + 1}"
        return f"transform({_elements(member)}, {inner} -> {_struct(inner, field.dataType.elementType, keep, [], depth + 1)})"
    return _LEAVES[field.dataType](member)


def project(root: str, path: str, struct: T.StructType, keep: bool, silent: list[str] | None = None) -> Column:
    """The object at ``path`` of the variant column ``root`` as ``struct``: null unless it is an object with a key or more.

    Fields named ``*_extra_json`` hold what no other field reads. Elements of
    lists that are no such objects stay, as nulls.
    """
    return F.expr(_struct(_at(root, path), struct, keep, silent or [], 0) if path != "$" else _struct(root, struct, keep, silent or [], 0))


def at(variant: Column, path: str) -> Column:
    """The part of a variant at a path, null if it isn't there; JSON null is a variant of its own."""
    return F.try_variant_get(variant, path, "variant")


def is_object(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "map<string,variant>").isNotNull()


def parsed_once(lines: DataFrame, line: str, name: str, seen: Observation | None = None) -> DataFrame:
    """The lines that are JSON objects, as the variant column ``name``.

    It comes out of a generator, through which no condition is pushed: else each
    condition on the variant would parse the line again. seen: observes, in the
    same pass, the number of lines that aren't blank and of malformed ones.
    """
    object_ = F.col(line).rlike(r"^[ \t\r\n]*\{")
    rows = lines.where(object_ if seen is None else F.trim(line) != "").select(F.explode(F.array(parsed(F.col(line)))).alias(name), object_.alias("is_object"))
    if seen is not None:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(name).isNull()).alias("bad_lines"))
    return rows.where(F.col("is_object") & F.col(name).isNotNull()).select(name)


def string(root: str, path: str) -> Column:
    """The string at a path of the variant column ``root``; null if it is none."""
    return F.expr(_string(_at(root, path)))


def boolean(root: str, path: str) -> Column:
    return F.expr(_boolean(_at(root, path)))


def bigint(root: str, path: str) -> Column:
    """Integers; other numbers cut towards zero; strings of digits. Anything else, and what overflows, is null."""
    return F.expr(_bigint(_at(root, path)))


def listed(root: str, path: str, leaf: str, kind: str) -> Column:
    """A leaf ("bigint" or "string") of each element of the list at a path; null if there is no list."""
    sql = {"bigint": _bigint, "string": _string}[kind](_at("e", leaf))
    return F.expr(f"transform({_elements(_at(root, path))}, e -> {sql})")


def extras(root: str, path: str, known: list[str], keep: bool) -> Column:
    """JSON bytes of an object's members beyond the known keys; null if there are none, or if they are not kept."""
    return F.expr(f"transform(array({_at(root, path)}), x0 -> {_extras('x0', known, keep)})[0]")


def parsed(line: Column) -> Column:
    """A line as VARIANT; null if it is not JSON. Of repeated keys the last counts (session setting)."""
    return F.try_parse_json(line)


#: Settings that the expressions of this library rely on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.useLargeVarTypes": "true",
}


def configure(spark) -> None:
    """Set what parsing and merging of JSON need in this session."""
    for key in ("spark.sql.variant.allowDuplicateKeys", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(key, SETTINGS[key])


def merged_json(*parts: Column) -> Column:
    """Maps of variants merged to JSON bytes, the right one first; null parts are empty."""
    empty = F.create_map().cast("map<string,variant>")
    return F.encode(F.to_json(F.map_concat(*[F.coalesce(p, empty) for p in parts]), {"ignoreNullFields": "false"}), "UTF-8")


def json_map(blob: Column) -> Column:
    """A JSON object in bytes as map of variants; null if it is none."""
    return F.try_variant_get(F.try_parse_json(F.decode(blob, "UTF-8")), "$", "map<string,variant>")
