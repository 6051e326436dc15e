"""Idempotent writes as joins: each gives the new state of a table, to be written over the old partition or by foreachBatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.text import named_hash


def last_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of greatest ``order`` of each key, combined before the shuffle; null keys identify nothing, and all stay."""
    cols = rows.columns
    known = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    top = known.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select("_r.*")
    return top.unionByName(rows.where(" OR ".join(f"`{k}` IS NULL" for k in keys)))


def insert_new(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` whose keys it lacks; of repeated new keys the first by ``order``."""
    cols = new.columns
    order = order or cols
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select("_r.*")
    return old.unionByName(first.join(old.select(*keys), keys, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``new`` in place of the rows of ``old`` with the same keys; of repeated new keys the last by ``order`` (all columns
    unless given). Rows without key are inserted."""
    one = last_of(new, keys, order or new.columns)
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(one)


def upsert_in_run(old: DataFrame, new: DataFrame, key: str, run: str) -> DataFrame:
    """The batch write: ``new`` rows enter unless their key was written in the same run."""
    return insert_new(old, new, [key, run])


def merge_accumulators(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, source_ids, _sources, _source_windows): two states of accumulators under one key (unique on each side).

    ``source_ids`` are united, the old first; of ``_sources`` (structs with ``source_id``) each source has one, the old
    one's; ``_source_windows`` are all kept.
    """
    j = old.select(key, *[F.col(c).alias("o_" + c) for c in ("source_ids", "_sources", "_source_windows")]).join(
        new.select(key, *[F.col(c).alias("n_" + c) for c in ("source_ids", "_sources", "_source_windows")]), key, "full_outer")
    kind = dict(old.dtypes)
    both = lambda c: (F.coalesce(F.col("o_" + c), F.array().cast(kind[c])), F.coalesce(F.col("n_" + c), F.array().cast(kind[c])))
    (i1, i2), (s1, s2), (w1, w2) = both("source_ids"), both("_sources"), both("_source_windows")
    known = F.transform(s1, lambda x: x["source_id"])
    ledger = F.concat(s1, F.filter(s2, lambda x: ~F.array_contains(known, x["source_id"])))
    return j.select(key, F.array_union(i1, i2).alias("source_ids"), ledger.alias("_sources"), F.concat(w1, w2).alias("_source_windows"))


def tables(canonicals: DataFrame, run: str) -> dict[str, DataFrame]:
    """The rows that one canonical record is in each table, from (link_id, entity_type, supertype, name, description, status,
    date_start, date_end, formatted_name, geoid, _sources): to be written together by one foreachBatch."""
    c = canonicals
    name = F.coalesce(F.nullif(F.trim("name"), F.lit("")), F.left(F.nullif(F.trim("description"), F.lit("")), F.lit(120)), F.col("entity_type"), F.col("link_id").cast("string"))
    text = F.coalesce(F.nullif(F.trim("description"), F.lit("")), name)
    stamp = F.to_json(F.struct(F.col("link_id").alias("_link_id"), F.lit(run).alias("_link_run")))
    swap = F.col("date_end") < F.col("date_start")
    return {
        "entities": c.select(F.col("link_id").alias("entity_id"), name.alias("name"), text.alias("description"), stamp.alias("metadata")),
        "entities_alias": c.select(F.col("link_id").alias("original_entity_id"), name.alias("entity_alias"), F.col("link_id").alias("current_entity_id")),
        "entity_types": c.select(F.col("link_id").alias("entity_id"), F.explode(F.array_distinct(F.array_compact(F.array("supertype", "entity_type")))).alias("entity_type")),
        "event_properties": c.select(F.col("link_id").alias("event_id"), F.when(swap, F.col("date_end")).otherwise(F.col("date_start")).alias("date_start"), F.when(swap, F.col("date_start")).otherwise(F.col("date_end")).alias("date_end"), "status"),
        "entity_locations": c.where("geoid IS NOT NULL").select(F.col("link_id").alias("entity_id"), "formatted_name", "geoid"),
        "entities_documents": c.select(F.col("link_id").alias("entity_id"), F.inline("_sources")).withColumnRenamed("source_id", "doc_id").dropDuplicates(["entity_id", "doc_id"]),
    }


def refreshed(rows: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """A full refresh: the rows that replace the table, and (n, enabled), the count of all and of those with ``condition``."""
    return rows, rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("enabled"))


def catalog_seed(types: DataFrame, skipped: tuple[str, ...] = ("theme",)) -> DataFrame:
    """(entity_type, entity_kind, parent): the catalogue of (event_type, supertype, category): each supertype once, and each
    leaf under it; the categories in ``skipped`` have no entries."""
    t = types.where(~F.coalesce(F.col("category").isin(*skipped), F.lit(False)))
    parents = t.select(F.col("supertype").alias("entity_type"), F.lit("supertype").alias("entity_kind"), F.lit(None).cast("string").alias("parent")).distinct()
    return parents.unionByName(t.select(F.col("event_type").alias("entity_type"), F.lit("leaf").alias("entity_kind"), F.col("supertype").alias("parent")).distinct())


def resolved(rows: DataFrame, catalog: DataFrame, supertype: str, child: Column) -> DataFrame:
    """``rows`` with ``parent`` and ``child`` of the catalogue: the supertype, then the leaf under that parent; null where it has none."""
    parents = catalog.where("entity_kind = 'supertype'").select(F.col("entity_type").alias("parent"))
    children = catalog.where("entity_kind = 'leaf'").select(F.col("entity_type").alias("child"), F.col("parent").alias("_of"))
    t = rows.withColumn("_child", child).join(parents, F.col(supertype) == F.col("parent"), "left")
    return t.join(children, (F.col("_of") == F.col("parent")) & (F.col("_child") == F.col("child")), "left").drop("_child", "_of")


def union_sources(old: DataFrame, new: DataFrame, key: str, sources: str) -> DataFrame:
    """Accumulated sources: those of ``old`` first, then the further ones of ``new``, each once."""
    none = F.array().cast("array<string>")
    j = old.select(key, F.col(sources).alias("o")).join(new.select(key, F.col(sources).alias("n")), key, "full_outer")
    return j.select(key, F.array_union(F.coalesce("o", none), F.coalesce("n", none)).alias(sources))


def delete_run(old: DataFrame, column: str, run: str) -> DataFrame:
    """``old`` without the rows of a run; null runs stay."""
    return old.where(F.col(column).isNull() | (F.col(column) != run))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """The children of every parent in ``new`` replaced by its rows."""
    return old.join(new.select(parent).distinct(), parent, "left_anti").unionByName(new)


def fill_from(old: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` updated from ``values`` (unique in key) where they have it."""
    v = values.select(key, F.col(column).alias("_v"))
    return old.join(v, key, "left").withColumn(column, F.coalesce("_v", column)).drop("_v")


def ledger(records: DataFrame, doc: str, payload: list[str], outcome: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """One row per (document, hash of the record): ``doc``, ``payload``, ``record_hash`` and the ``outcome`` of its last
    writing by ``order``; records without document leave none."""
    rows = records.where(F.col(doc).isNotNull()).withColumn("record_hash", named_hash({c: F.col(c) for c in payload}))
    if not outcome:
        return rows.dropDuplicates([doc, "record_hash"])
    last = F.max_by(F.struct(*payload, *outcome), F.struct(*(order or outcome)))
    return rows.groupBy(doc, "record_hash").agg(last.alias("_r")).select(doc, "record_hash", "_r.*")
