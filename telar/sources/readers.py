"""Readers and writers: JSON arrays and lines, damaged JSON, CSV rules and dimensions, lookups, run artefacts."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from telar.functions.text import parse_list


def read_json(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False, limit: int | None = None) -> DataFrame:
    """A JSON file, a directory or a glob of them; a single object counts as an array of one; ``limit`` rows where given."""
    r = spark.read.option("multiLine", not lines)
    t = (r.schema(schema) if schema else r).json(path)
    return t.limit(limit) if limit is not None else t


def read_damaged(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, damaged lines) of a JSON-lines file; nothing is dropped silently."""
    t = spark.read.text(path).select(F.col("value"), F.from_json("value", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return t.where("r._corrupt IS NULL AND value <> ''").select("r.*").drop("_corrupt"), t.where("r._corrupt IS NOT NULL").select("value")


def balanced_objects(text: str) -> list[str]:
    """The outermost complete {...} of a text, braces in strings left aside; inside an object that never ends, those it holds."""
    out: list[str] = []
    opened: list[tuple[int, int]] = []  # (start, how many of ``out`` came before it)
    in_string = escaped = False
    for i, c in enumerate(text):
        if in_string:
            in_string, escaped = not (c == '"' and not escaped), c == "\\" and not escaped
        elif c == '"':
            in_string, escaped = bool(opened), False
        elif c == "{":
            opened.append((i, len(out)))
        elif c == "}" and opened:
            start, before = opened.pop()
            out[before:] = [text[start : i + 1]]
    return out


@F.pandas_udf(ArrayType(StringType()))
def _recovered(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else balanced_objects(t))


def recovered(texts: DataFrame, column: str) -> DataFrame:
    """``texts`` with ``record``: each readable JSON object within a damaged text, a row each; texts without any leave none."""
    return texts.withColumn("record", F.explode(_recovered(F.col(column)))).where(F.try_parse_json("record").isNotNull())


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of rules: list columns as "a|b"."""
    t = spark.read.option("header", True).csv(path)
    lists = [c for c in ("kw", "phrase", "not_kw", "categories", "dismiss_categories", "document_type") if c in t.columns]
    return t.withColumns({c: parse_list(F.col(c)) for c in lists} | {"enabled": F.coalesce(F.lower("enabled").isin("true", "1", "yes", "sí"), F.lit(True)) if "enabled" in t.columns else F.lit(True)})


def read_dimension(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, all text, the named columns."""
    return spark.read.option("header", True).csv(path).select(*columns)


def looked_up(rows: DataFrame, key: str, stored: DataFrame, path: str, value: str) -> DataFrame:
    """``rows`` with the JSON ``value`` of the one stored row whose JSON member ``path`` is ``key``; of several the first by value."""
    held = stored.select(F.get_json_object(value, path).alias(key), F.col(value)).where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    return rows.join(held, key, "left")


def dated(rows: DataFrame, url: str, dates: DataFrame, date: str, own: str) -> DataFrame:
    """``rows`` whose ``own`` date is null filled by address from ``dates``, of which the first by time counts."""
    first = dates.where(F.col(date).isNotNull()).groupBy(url).agg(F.min(date).alias("_d"))
    return rows.join(first, url, "left").withColumn(own, F.coalesce(own, "_d")).drop("_d")


def events_of(fixture: DataFrame) -> DataFrame:
    """The events of linked fixtures: a column ``events`` of structs, or rows that are events already."""
    return fixture.select(F.inline("events")) if "events" in fixture.columns else fixture


def flattened(t: DataFrame, inner: str) -> DataFrame:
    """``t`` with the members of a struct column as columns."""
    return t.select(*[c for c in t.columns if c != inner], f"{inner}.*")


def snapshot(entities: DataFrame, types: DataFrame, locations: DataFrame, aliases: DataFrame, edges: DataFrame) -> DataFrame:
    """One nested row per entity: its own columns with types[], locations[], aliases[] and related_entity_ids[] (edges of
    either direction), in order, empty where there are none."""
    def listed(t: DataFrame, name: str, item: Column) -> DataFrame:
        return t.groupBy("entity_id").agg(F.array_sort(F.collect_set(item)).alias(name))

    both = edges.select(F.col("ent_id_source").alias("entity_id"), F.col("ent_id_dest").alias("o")).union(edges.select("ent_id_dest", "ent_id_source")).distinct()
    struct = lambda t: F.struct(*[c for c in t.columns if c != "entity_id"])
    out = entities
    for t, name, item in ((types, "types", struct(types)), (locations, "locations", struct(locations)), (aliases, "aliases", F.col("entity_alias")), (both, "related_entity_ids", F.col("o"))):
        have = listed(t, name, item)
        out = out.join(have, "entity_id", "left").withColumn(name, F.coalesce(name, F.array().cast(dict(have.dtypes)[name])))
    return out


def write_json(df: DataFrame, path: str, stamped: bool = False) -> str:
    """A run's artefact as JSON lines; ``stamped`` adds the time to its name, else an older one is replaced. Returns the path."""
    out = f"{path}_{datetime.now(timezone.utc):%Y%m%dT%H%M%S}" if stamped else path
    df.write.mode("overwrite").json(out)
    return out


def publish(df: DataFrame, path: str, trace: Column) -> None:
    """Documents put where the stream reads them, each with its ``trace_id``."""
    df.withColumn("trace_id", F.coalesce(F.col("trace_id"), trace) if "trace_id" in df.columns else trace).write.mode("append").json(path)
