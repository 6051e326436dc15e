"""Declared schemas with nested objects and lists of objects, compiled to one projection.

A schema is a dictionary: type name -> {field -> spec}, a spec having ``type``, ``required``, ``required_fn``, ``default``,
``default_fn`` and ``enum``. Types are the parsers of ``types``, names of the schema (objects), ``List[...]`` of either.
Objects take flat keys of their parent where they lack them (hoisting); an absent object is a struct of nulls, an absent
list an empty one. Functions named by ``*_fn`` come from a registry of Column builders over the parsed record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.text import is_url, literal_list
from telar.functions.types import PARSERS

Schema = dict[str, dict[str, dict]]
Functions = dict[str, Callable[[Callable[[str], Column]], Column]]
VIOLATION = "array<struct<field:string,message:string>>"
SPARK = {"int": "bigint", "float": "double", "bool": "boolean", "datetime": "timestamp"}


def spark_type(schema: Schema, kind: str) -> str:
    """The Spark type of a declared type."""
    if kind.startswith("List["):
        return f"array<{spark_type(schema, kind[5:-1])}>"
    if kind in schema:
        return "struct<" + ",".join(f"{f}:{spark_type(schema, s['type'])}" for f, s in schema[kind].items()) + ">"
    return SPARK.get(kind, "string")


def dependencies(schema: Schema, name: str) -> list[str]:
    """The objects that ``name`` needs, itself first, each once."""
    out, open_ = [], [name]
    while open_:
        n = open_.pop(0)
        if n not in out:
            out.append(n)
            open_ += [k for s in schema[n].values() if (k := s["type"].removeprefix("List[").removesuffix("]")) in schema]
    return out


def _value(schema: Schema, kind: str, v: Column, parents: list[Column], name: str, zones: list[str]) -> Column:
    """The parsed value of a field of variant ``v``; ``parents`` are the objects whose flat keys nested objects may take."""
    get = lambda o, n: F.try_variant_get(o, f"$['{n}']", "variant")
    if kind.startswith("List["):
        inner = kind[5:-1]
        items = F.try_variant_get(v, "$", "array<variant>")
        if inner in schema:
            return F.coalesce(F.transform(items, lambda x: _object(schema, inner, x, [], zones)), F.array().cast(spark_type(schema, kind)))
        words = F.coalesce(F.try_variant_get(v, "$", "array<string>"), literal_list(F.try_variant_get(v, "$", "string")))
        return F.coalesce(F.transform(words, lambda x: PARSERS[inner](x, zones)), F.array().cast(spark_type(schema, kind)))
    if kind in schema:
        return _object(schema, kind, v, parents, zones)
    return PARSERS[kind](F.try_variant_get(v, "$", "string"), zones)


def _object(schema: Schema, name: str, v: Column, parents: list[Column], zones: list[str]) -> Column:
    fields = []
    for f, spec in schema[name].items():
        own = F.try_variant_get(v, f"$['{f}']", "variant")
        for p in parents:  # the object's own keys win; else a flat key of the same name
            own = F.coalesce(own, F.try_variant_get(p, f"$['{f}']", "variant"))
        fields.append(_value(schema, spec["type"], own, [v, *parents] if spec["type"] in schema else [], f, zones).alias(f))
    return F.struct(*fields)


def _defaulted(schema: Schema, name: str, s: Column, functions: Functions, root: Column) -> Column:
    fields = []
    for f, spec in schema[name].items():
        c = s[f]
        if spec["type"] in schema:
            c = _defaulted(schema, spec["type"], c, functions, root)
        elif "default_fn" in spec:
            c = F.coalesce(c, functions[spec["default_fn"]](lambda path, s=s: s[path]).cast(spark_type(schema, spec["type"])))
        elif spec.get("default") is not None:
            c = F.coalesce(c, F.lit(spec["default"]).cast(spark_type(schema, spec["type"])))
        fields.append(c.alias(f))
    return F.struct(*fields)


def _outside(c: Column, allowed: list[str], many: bool) -> Column:
    return F.exists(c, lambda x: ~x.isin(*allowed)) if many else ~c.isin(*allowed)


def _in_items(schema: Schema, name: str, items: Column, functions: Functions, path: str) -> Column:
    """The violations within the objects of a list."""
    return F.flatten(F.transform(items, lambda x: F.concat(*_violations(schema, name, x, functions, path), F.array().cast(VIOLATION))))


def _violations(schema: Schema, name: str, s: Column, functions: Functions, path: str) -> list[Column]:
    out = []
    for f, spec in schema[name].items():
        kind, c, at = spec["type"], s[f], F.lit(path + f)
        say = lambda cond, text, at=at: F.array_compact(F.array(F.when(cond, F.struct(at.alias("field"), F.lit(text).alias("message")))))
        inner = kind.removeprefix("List[").removesuffix("]")
        empty = F.size(c) == 0 if kind.startswith("List[") else c.isNull()
        if kind in schema:
            out += _violations(schema, kind, c, functions, f"{path}{f}.")
            empty = F.lit(False)
        elif kind.startswith("List[") and inner in schema:
            out.append(_in_items(schema, inner, c, functions, f"{path}{f}[]."))
        if spec.get("required"):
            out.append(say(empty, "required"))
        elif "required_fn" in spec:
            out.append(say(empty & F.coalesce(functions[spec["required_fn"]](lambda p, s=s: s[p]), F.lit(False)), "required"))
        if spec.get("enum"):
            bad = _outside(c, spec["enum"], kind.startswith("List["))
            out.append(say(F.coalesce(bad, F.lit(False)), "not allowed"))
        if kind == "Url":
            out.append(say(c.isNotNull() & ~is_url(c), "no address"))
        elif kind == "List[Url]":
            out.append(say(F.exists(c, lambda x: ~is_url(x)), "no address"))
    return out


def normalized(df: DataFrame, payload: str, schema: Schema, name: str, zones: list[str], keep: list[str], functions: Functions | None = None, strict: bool = False) -> DataFrame:
    """``keep``, ``record`` (the struct of ``name``, parsed, hoisted and defaulted) and ``violations`` of the JSON in ``payload``.

    Fields that the schema doesn't declare are left out; unreadable JSON gives a record of nulls and empty lists.
    ``strict`` raises at the first record with violations; else they are a column to filter by.
    """
    missing = {spec[k] for t in dependencies(schema, name) for spec in schema[t].values() for k in ("default_fn", "required_fn") if k in spec} - set(functions or {})
    if missing:
        raise KeyError(f"unknown functions {sorted(missing)}")
    fns = functions or {}
    t = df.select(*keep, F.try_parse_json(payload).alias("_v"))
    t = t.select(*keep, _object(schema, name, F.col("_v"), [], zones).alias("_r"))
    t = t.select(*keep, _defaulted(schema, name, F.col("_r"), fns, F.col("_r")).alias("record"))
    v = F.concat(*_violations(schema, name, F.col("record"), fns, ""), F.array().cast(VIOLATION))
    if strict:
        v = F.when(F.size(v) > 0, F.raise_error(F.concat(F.lit("violations: "), F.to_json(v))).cast(VIOLATION)).otherwise(v)
    return t.withColumn("violations", v)


def fields_for_prompt(schema: Schema, name: str, essential: bool = False) -> list[tuple[str, str, str]]:
    """(object, field, type) that a prompt describes: of ``name`` and all objects it needs; ``essential`` leaves the others out."""
    return [(t, f, s["type"]) for t in dependencies(schema, name) for f, s in schema[t].items() if not essential or s.get("importance", "essential") == "essential"]


# The composite types of extracted records.
COMPOSITES: Schema = {
    "PeriodDates": {"start": {"type": "datetime"}, "end": {"type": "datetime"}},
    "DateRange": {"date_range": {"type": "PeriodDates"}, "timezone": {"type": "str"}},
    "DateRangeFromUnstructured": {"date_range": {"type": "PeriodDates"}, "timezone": {"type": "str"}, "mention": {"type": "str"}, "precision_days": {"type": "int"}},
    "DateFromUnstructured": {"date": {"type": "datetime"}, "mention": {"type": "str"}, "precision_days": {"type": "int"}},
    "LocationCoords": {"lat": {"type": "float"}, "lon": {"type": "float"}},
    "Location": {c: {"type": "str"} for c in ("country", "state", "city", "neighborhood", "zone", "street", "number", "place_name")},
    "PriceRange": {"mention": {"type": "str"}, "lower": {"type": "float"}, "upper": {"type": "float"}, "currency": {"type": "str"}},
    "Attendance": {"mention": {"type": "str"}, "estimate": {"type": "int"}},
    "VenueCapacity": {"mention": {"type": "str"}, "capacity": {"type": "int"}},
    "CasualtyCount": {"mention": {"type": "str"}, "dead": {"type": "int"}, "injured": {"type": "int"}, "missing": {"type": "int"}},
    "CountMention": {"mention": {"type": "str"}, "count": {"type": "int"}, "confidence_range": {"type": "int"}},
    "PersonReference": {"name": {"type": "str"}, "role": {"type": "str"}, "organization": {"type": "str"}},
}
