"""Declared schemas: typed parsing, defaults and violations, generated as one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.instants import utc_micros
from telar.functions.text import is_url, literal_list

PARSERS = {
    "int": lambda c, z: _number(c).cast("bigint"),
    "float": lambda c, z: _number(c),
    "str": lambda c, z: F.nullif(F.trim(c.cast("string")), F.lit("")),
    "bool": lambda c, z: F.when(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y"), True).when(F.lower(F.trim(c.cast("string"))).isin("false", "0", "no", "n"), False),
    "datetime": lambda c, z: F.timestamp_micros(utc_micros(c.cast("string"), None, z)),
    "Url": lambda c, z: F.nullif(F.trim(c.cast("string")), F.lit("")),
    "EnumStr": lambda c, z: F.nullif(F.trim(c.cast("string")), F.lit("")),
    "List[str]": lambda c, z: literal_list(c),
}


def _number(c: Column) -> Column:
    x = F.trim(c.cast("string"))
    x = F.when(F.lower(x) == "true", "1").when(F.lower(x) == "false", "0").otherwise(x)
    return F.when(x.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,2})?$"), x).cast("double")


@dataclass(frozen=True)
class Field:
    """A declared field: type, source column (its own name unless given), whether it must be filled, default, allowed values."""

    name: str
    type: str = "str"
    source: str | None = None
    required: bool = False
    default: object | None = None
    enum: tuple[str, ...] = ()


def normalized(df: DataFrame, fields: list[Field], zones: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and the declared fields, parsed (unparsable is null) and defaulted, with ``violations``
    (array<struct<field,message>>). Fields not declared are left out; a field without column is null."""
    parsed, bad = [], []
    for f in fields:
        src = f.source or f.name
        raw = F.col(src) if src in df.columns else F.lit(None).cast("string")
        v = PARSERS[f.type](raw, zones)
        if f.default is not None:
            v = F.coalesce(v, F.lit(f.default))
        parsed.append(v.alias(f.name))
        say = lambda cond, text, n=f.name: F.when(cond, F.struct(F.lit(n).alias("field"), F.lit(text).alias("message")))
        if f.required:
            bad.append(say(v.isNull(), "required"))
        if f.enum:
            bad.append(say(v.isNotNull() & ~v.isin(*f.enum), "not allowed"))
        if f.type == "Url":
            bad.append(say(v.isNotNull() & ~is_url(v), "no address"))
    none = F.array().cast("array<struct<field:string,message:string>>")
    return df.select(*keep, *parsed, (F.array_compact(F.array(*bad)) if bad else none).alias("violations"))
