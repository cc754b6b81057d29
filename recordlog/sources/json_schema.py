"""JSON Schema as column expressions: the Spark type of a schema, the errors of a value, decoding by schema id.

A schema is compiled once, on the driver, into expressions over a VARIANT: every record is checked inside the
scan's own stage, without Python.  Understood: ``type`` (also lists of types), ``properties``, ``required``,
``additionalProperties`` (true or false), ``items``, ``enum`` and ``const`` of plain values, ``minimum``,
``maximum`` and their exclusive forms, ``minLength``, ``maxLength``, ``pattern`` (a Java pattern, found anywhere),
``minItems``, ``maxItems``.  Any other keyword that would restrict a value is refused when the schema is
compiled, never passed over.
"""
from __future__ import annotations

import json
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = ("null", "boolean", "integer", "number", "string", "array", "object")
ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "format", "deprecated", "readOnly", "writeOnly"}
KEYWORDS = {"type", "properties", "required", "additionalProperties", "items", "enum", "const", "minimum", "maximum", "exclusiveMinimum",
            "exclusiveMaximum", "minLength", "maxLength", "pattern", "minItems", "maxItems"}
BOUNDS = {"minimum": (operator.lt, "below"), "maximum": (operator.gt, "above"),
          "exclusiveMinimum": (operator.le, "not above"), "exclusiveMaximum": (operator.ge, "not below")}
UNKNOWN = -1


def parse(schema: str | dict) -> dict:
    """The schema as a dict, checked for keywords that are not understood."""
    s = json.loads(schema) if isinstance(schema, str) else schema
    if not isinstance(s, dict):
        raise ValueError("a schema is a JSON object")
    if strange := set(s) - KEYWORDS - ANNOTATIONS:
        raise ValueError(f"schema keywords not understood: {', '.join(sorted(strange))}")
    for t in _types(s):
        if t not in TYPES:
            raise ValueError(f"unknown type {t}")
    if not isinstance(s.get("additionalProperties", True), bool):
        raise ValueError("additionalProperties must be true or false")
    if any(isinstance(x, (dict, list)) for x in _choices(s) or []):
        raise ValueError("enum and const take plain values")
    for name, part in s.get("properties", {}).items():
        if any(c in name for c in "\"'\\"):
            raise ValueError(f"property name {name!r} cannot be a path")
        parse(part)
    if "items" in s:
        parse(s["items"])
    return s


def _types(s: dict) -> list[str]:
    t = s.get("type", [])
    return [t] if isinstance(t, str) else list(t)


def _choices(s: dict) -> list | None:
    return [s["const"]] if "const" in s else s.get("enum")


def spark_type(schema: str | dict) -> T.DataType:
    """Spark type of a schema's values; VARIANT where the schema leaves the type open."""
    s = parse(schema)
    kinds = [t for t in _types(s) if t != "null"]
    if set(kinds) == {"integer", "number"}:
        kinds = ["number"]
    if len(kinds) != 1:
        return T.VariantType()
    if kinds[0] == "object":
        parts = s.get("properties")
        return T.StructType([T.StructField(n, spark_type(p)) for n, p in parts.items()]) if parts else T.MapType(T.StringType(), T.VariantType())
    if kinds[0] == "array":
        return T.ArrayType(spark_type(s.get("items", {})))
    return {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}[kinds[0]]


def _as(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _is(v: Column, t: str) -> Column:
    full = F.schema_of_variant(v)
    name = F.split(full, r"[<(]")[0]
    number = _as(v, "double")
    return {"null": v.isNull() | (name == "VOID"), "boolean": name == "BOOLEAN", "string": name == "STRING", "object": name == "OBJECT",
            "array": name == "ARRAY", "number": name.isin("BIGINT", "DECIMAL", "DOUBLE"),
            "integer": (name == "BIGINT") | full.rlike(r"^DECIMAL\([0-9]+,0\)$") | ((name == "DOUBLE") & (number == F.floor(number)))}[t]


def _equal(v: Column, x) -> Column:
    if x is None:
        return _is(v, "null")
    if isinstance(x, bool):
        return _is(v, "boolean") & (_as(v, "boolean") == F.lit(x))
    if isinstance(x, str):
        return _is(v, "string") & (_as(v, "string") == F.lit(x))
    return _is(v, "number") & (_as(v, "double") == F.lit(float(x)))


def _any(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _errors(v: Column, s: dict, path: str) -> Column:
    """Array of messages of one present value; ``v`` is a VARIANT, null for an array's null element."""
    found = []

    def rule(bad: Column, says: str) -> None:
        found.append(F.array(F.when(bad, F.lit(f"{path}: {says}"))))

    if kinds := _types(s):
        rule(~_any(_is(v, t) for t in kinds), f"is not {' or '.join(kinds)}")
        if "integer" in kinds and "number" not in kinds:
            rule(_is(v, "integer") & _as(v, "bigint").isNull(), "does not fit 64 bits")
    if (choices := _choices(s)) is not None:
        rule(~_any(_equal(v, x) for x in choices), "is none of the listed values")
    for k, (beyond, says) in BOUNDS.items():
        if k in s:
            rule(_is(v, "number") & beyond(_as(v, "double"), F.lit(float(s[k]))), f"is {says} {s[k]}")
    text, items = _as(v, "string"), _as(v, "array<variant>")
    if "minLength" in s:
        rule(_is(v, "string") & (F.length(text) < s["minLength"]), f"is shorter than {s['minLength']}")
    if "maxLength" in s:
        rule(_is(v, "string") & (F.length(text) > s["maxLength"]), f"is longer than {s['maxLength']}")
    if "pattern" in s:
        rule(_is(v, "string") & ~text.rlike(s["pattern"]), "does not match its pattern")
    if "minItems" in s:
        rule(F.size(items) < s["minItems"], f"has fewer than {s['minItems']} items")
    if "maxItems" in s:
        rule(F.size(items) > s["maxItems"], f"has more than {s['maxItems']} items")
    if "items" in s:
        found.append(F.flatten(F.transform(items, lambda x: _errors(x, s["items"], f"{path}[]"))))
    keys = F.map_keys(_as(v, "map<string,variant>"))
    for name in s.get("required", []):
        found.append(F.array(F.when(~F.array_contains(keys, name), F.lit(f"{path}.{name}: is required"))))
    if s.get("additionalProperties") is False:
        known = F.array(*[F.lit(n) for n in s.get("properties", {})]).cast("array<string>")
        rule(F.size(F.array_except(keys, known)) > 0, "has properties that are not listed")
    for name, part in s.get("properties", {}).items():
        inner = F.try_variant_get(v, f'$["{name}"]', "variant")
        found.append(F.when(inner.isNotNull(), _errors(inner, part, f"{path}.{name}")))
    none = F.array().cast("array<string>")
    return F.filter(F.concat(none, *[F.coalesce(f, none) for f in found]), lambda e: e.isNotNull())


def errors(value: Column, schema: str | dict) -> Column:
    """Array of what is wrong with a VARIANT by a schema, empty when nothing is; each says where."""
    return _errors(value, parse(schema), "$")


class Schemas:
    """Registered schemas, rows of ``(id, subject, version, schema text)``.

    Every schema becomes one branch of an expression: meant for the schemas of a few topics at a time."""

    def __init__(self, rows: Iterable[tuple[int, str, int, str]]):
        self.rows = sorted(rows)
        ids = [r[0] for r in self.rows]
        if len(set(ids)) < len(ids) or any(i < 0 for i in ids):
            raise ValueError("schema ids must be distinct and not negative")
        self.parsed = {i: parse(text) for i, _, _, text in self.rows}

    def _first(self, hits: list[tuple[Column, int]]) -> Column:
        return F.coalesce(*[F.when(c, F.lit(i)) for c, i in hits], F.lit(UNKNOWN))

    def id_of(self, schema_id: Column, subject: Column, version: Column, text: Column) -> Column:
        """Id of the schema that a request names: by id, else by subject and version (the latest without a
        version), else by its text (white space and order of properties do not count); null when it
        names none, -1 when what it names is not registered."""
        latest = sorted(self.rows, key=lambda r: -r[2])
        named = self._first([((subject == s) & (F.coalesce(version, F.lit(n)) == n), i) for i, s, n, _ in latest])
        given = F.to_json(F.try_parse_json(text))
        same = self._first([(given == F.to_json(F.parse_json(F.lit(t))), i) for i, _, _, t in self.rows])
        known = F.when(schema_id.isin(*self.parsed), schema_id).otherwise(F.lit(UNKNOWN))
        return F.when(schema_id.isNotNull(), known).when(subject.isNotNull(), named).when(text.isNotNull(), same).cast("int")

    def errors(self, value: Column, schema_id: Column) -> Column:
        """Errors of a VARIANT by the schema with that id; without an id every JSON value is valid."""
        out = F.when(schema_id.isNull(), F.array().cast("array<string>"))
        for i, s in self.parsed.items():
            out = out.when(schema_id == i, _errors(value, s, "$"))
        return out.otherwise(F.array(F.lit("$: its schema is not registered")))

    def decode(self, df: DataFrame, col: str = "value", id_col: str = "value_schema_id", on_error: str = "fail") -> DataFrame:
        """``col`` as a VARIANT, checked by the schema in ``id_col``; ``typed`` gives a schema's struct.

        Texts that are not JSON or break their schema follow ``on_error``: ``fail`` raises at the first,
        ``skip`` drops them, ``keep`` keeps them with a null value, the text in ``corrupt_<col>`` and the
        reasons in ``errors_<col>``.  A null value (a tombstone) is valid."""
        if on_error not in ("fail", "skip", "keep"):
            raise ValueError("on_error must be fail, skip or keep")
        text, v, e = F.col(col).cast("string"), F.col("_v"), F.col("_e")
        bad = F.when(text.isNull(), F.array().cast("array<string>")).when(v.isNull(), F.array(F.lit("$: is not JSON"))) \
            .otherwise(self.errors(v, F.col(id_col)))
        d = df.withColumn("_v", F.try_parse_json(text)).withColumn("_e", bad)
        if on_error == "keep":
            d = d.withColumn(f"corrupt_{col}", F.when(F.size(e) > 0, text)).withColumn(f"errors_{col}", e)
        elif on_error == "skip":
            d = d.filter(F.size(e) == 0)
        else:
            stop = F.raise_error(F.concat(F.lit(f"invalid record {col}: "), F.array_join(e, "; ")))
            d = d.filter(F.when(F.size(e) > 0, stop.cast("boolean")).otherwise(F.lit(True)))
        return d.withColumn(col, F.when(F.size(e) == 0, v)).drop("_v", "_e")

    def typed(self, value: Column, schema_id: int) -> Column:
        """A checked VARIANT as the Spark type of one schema."""
        kind = spark_type(self.parsed[schema_id])
        return value if isinstance(kind, T.VariantType) else _as(value, kind.simpleString())
