"""Answers of a model, kept as tables by the key of their question: read, reduced to entities, and held against what was asked.

Calls themselves are outside; ``replayed`` joins stored answers, and what has none is left for a caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.text import named_hash, strip_fence

DEPTH = 5


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def entity_list(answer: Column, depth: int = DEPTH) -> Column:
    """The entities of an answer as array<variant>, null where it isn't JSON or is a scalar.

    A list gives its objects; an object with one member is unwrapped, ``depth`` times at most, unless that member is a
    scalar; of an object with several members the only one that is a list of objects; any other object is one entity.
    """
    objects = lambda v: F.filter(F.try_variant_get(v, "$", "array<variant>"), lambda x: _kind(x).startswith("OBJECT"))
    is_list = lambda v: _kind(v).startswith("ARRAY")
    is_object = lambda v: _kind(v).startswith("OBJECT")
    let = lambda v, body: F.element_at(F.transform(F.array(v), body), 1)

    def reduced(v: Column, left: int) -> Column:
        def inside(members: Column) -> Column:
            sole = F.element_at(F.map_values(members), 1)
            lists = F.filter(F.map_values(members), lambda x: is_list(x) & (F.size(F.try_variant_get(x, "$", "array<variant>")) > 0) & (F.size(objects(x)) == F.size(F.try_variant_get(x, "$", "array<variant>"))))
            deeper = let(sole, lambda s: F.when(is_object(s), reduced(s, left - 1))) if left > 0 else F.when(is_object(sole), F.array(sole))
            one = F.when(is_list(sole), objects(sole)).when(is_object(sole), deeper).otherwise(F.array(v))
            return F.when(F.size(members) == 1, one).otherwise(F.when(F.size(lists) == 1, objects(F.element_at(lists, 1))).otherwise(F.array(v)))

        return F.when(is_list(v), objects(v)).when(is_object(v), let(F.try_variant_get(v, "$", "map<string,variant>"), inside))

    return let(F.try_parse_json(strip_fence(answer)), lambda v: F.when(v.isNotNull(), reduced(v, depth)))


def matched_id(answer: Column, allowed: Column) -> Column:
    """The ``match_id`` of an answer if it is one of ``allowed``; else null, which means a new record."""
    got = F.get_json_object(strip_fence(answer), "$.match_id")
    return F.when(F.array_contains(allowed, got), got)


def confirmed_classes(answer: Column, asked: Column) -> Column:
    """The classes of an answer that were asked for, each once, in the answer's order."""
    return F.array_intersect(F.coalesce(F.from_json(F.get_json_object(strip_fence(answer), "$.classes"), "array<string>"), F.array().cast("array<string>")), asked)


def by_supertype(confirmed: DataFrame, types: DataFrame) -> DataFrame:
    """(id, supertype, classes, focused): confirmed classes (id, event_type) grouped by supertype; unknown ones are dropped;
    one class alone is asked for with a focused prompt."""
    t = confirmed.join(types.select("event_type", "supertype"), "event_type").groupBy("id", "supertype").agg(F.array_sort(F.collect_set("event_type")).alias("classes"))
    return t.withColumn("focused", F.size("classes") == 1)


def replayed(questions: DataFrame, answers: DataFrame, fields: list[str]) -> DataFrame:
    """``questions`` with ``key`` (digest of ``fields``) and the stored ``response``, null where none is stored."""
    return questions.withColumn("key", named_hash({f: F.col(f) for f in fields})).join(answers.select("key", "response"), "key", "left")


def rendered(template: Column, values: dict[str, Column]) -> Column:
    """``template`` with each {name} replaced; null values as the empty text."""
    out = template
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v, F.lit("")))
    return out


def turns(template: Column) -> Column:
    """array<struct<role,content>> of a text with headers SYSTEM: and USER: at the starts of lines."""
    parts = F.filter(F.split(template, r"(?m)^(?=(?:SYSTEM|USER):)"), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.struct(F.lower(F.regexp_extract(x, r"^(SYSTEM|USER):", 1)).alias("role"), F.regexp_replace(x, r"^(SYSTEM|USER):\s*|\s+$", "").alias("content")))


def question(incoming: Column, candidates: Column) -> Column:
    """The message that shows an incoming record and its candidates as indented JSON."""
    return F.concat_ws("\n", F.lit("INCOMING:"), F.to_json(incoming, {"pretty": "true"}), F.lit("CANDIDATES:"), F.to_json(candidates, {"pretty": "true"}))


def linking_payload(name: Column, description: Column, identification: Column, start: Column, end: Column, place: dict[str, Column]) -> Column:
    """The JSON of a record as adjudication sees it: what identifies it, its days and its address."""
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return F.to_json(F.struct(identification.alias("description"), F.struct(day(start).alias("start"), day(end).alias("end")).alias("dates"), F.struct(*[c.alias(k) for k, c in place.items()]).alias("address")))


def batch_line(line: Column) -> Column:
    """struct<custom_id,content>: the id and the first answer of a line of a batch's results."""
    return F.struct(F.get_json_object(line, "$.custom_id").alias("custom_id"), F.get_json_object(line, "$.response.body.choices[0].message.content").alias("content"))
