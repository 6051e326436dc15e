"""Rescue-column ingestion of JSON lines whose fields drift from file to file, and the report of each change.

``ingest`` enforces a target schema: every target field is a typed column, and whatever the schema doesn't know or
can't cast stays in ``_rescued`` as JSON, so nothing is lost. ``replay`` promotes approved field names and shapes from
``_rescued`` into the typed columns. ``changes`` compares the field inventories of consecutive files.

Defined results:
* a line that isn't one JSON object has ``_readable`` false, null columns and no fields; it is kept by ``ingest``;
* a file of which no line is readable has no fields (all of them are removed, then added again);
* null payloads are unreadable; empty tables give empty results; columns of the input pass through under a struct
  ``_source``, so that their names can't clash with target fields;
* a field is typed by the JSON types of its values other than null; a field without such values never changes type;
* a renaming needs at least one record of both files whose value is equal, and no record that contradicts it; among
  several candidates the one with most equal records wins, then the smaller names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telar.functions.instants import let
from telar.session import cut


@dataclass(frozen=True)
class Target:
    """A typed column: its SQL type, and the names approved for promotion (dots reach into objects)."""

    name: str
    type: str = "string"
    approved: tuple[str, ...] = field(default=())


#: The consistent table of posts and news hits. ``approved`` are the names seen in reports of changes so far.
TARGETS = (
    Target("_id", "string"),
    Target("doc_type", "string", ("type", "doctype")),
    Target("trace_id", "string"),
    Target("title", "string", ("titular", "headline", "message.title", "mensaje.title", "post.title", "message.titulo")),
    Target("text", "string", ("texto", "cuerpo", "full_text", "contenido", "message.body", "message.contenido", "message.msg", "message.texto", "mensaje.body", "post.body", "message")),
    Target("summary", "string", ("resumen", "abstract")),
    Target("url", "string", ("message.url", "mensaje.url", "post.url", "message.permalink", "permalink")),
    Target("news_type", "string", ("message.news_type", "mensaje.news_type", "post.news_type")),
    Target("author_name", "string", ("editor",)),
    Target("article_date", "string", ("message.timestamp", "message.created_time", "mensaje.timestamp", "post.timestamp")),
    Target("fb_likes", "bigint", ("likes", "me_gusta")),
    Target("custom_categories", "string", ("custom_cats", "categorias", "clasificacion", "message.source_category", "message.categoria")),
    Target("locations_mentioned", "string"),
)


def kind(v: Column) -> Column:
    """The JSON type of a variant: object, array, string, boolean, number, or null."""
    return F.when(v.isNotNull(), let(F.schema_of_variant(v), lambda s: F.when(s != "VOID", F.when(s == "STRING", "string").when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "BOOLEAN", "boolean").otherwise("number"))))


def _fields(payload: Column) -> Column:
    # from_json would keep the fields before the point where a line is cut off.
    return F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")


def _typed(v: Column, type_: str) -> Column:
    """A scalar of a variant strictly as ``type_``: numbers of text columns and texts of number columns don't cast."""
    k = kind(v)
    right = k == ("string" if type_ == "string" else "boolean" if type_ == "boolean" else "number")
    return F.when(right, F.try_variant_get(v, "$", type_))


def ingest(raw: DataFrame, payload: str = "payload", targets: tuple[Target, ...] = TARGETS) -> DataFrame:
    """One row per line: ``_source`` (the input row), ``_readable``, ``_fields``, the typed targets, ``_rescued``."""
    f = F.col("_fields")
    known = {t.name: t.type for t in targets}
    out = raw.select(F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("_source"), _fields(F.col(f"`{payload}`")).alias("_fields"))
    keep = lambda k, v: ~(
        F.lit(False) if not known else
        F.coalesce(*[F.when(k == n, F.coalesce(_typed(v, t).isNotNull() | kind(v).isNull(), F.lit(False))) for n, t in known.items()], F.lit(False))
    )
    return out.select(
        "_source", f.isNotNull().alias("_readable"), "_fields",
        *[_typed(F.try_element_at(f, F.lit(n)), t).alias(n) for n, t in known.items()],
        F.to_json(F.map_filter(f, keep)).alias("_rescued"),
    )


def _loose(v: Column, type_: str) -> Column:
    """The value of ``v`` in whatever shape it was delivered: a scalar, a text that holds JSON, a list, or an object."""
    text = F.try_variant_get(v, "$", "string")
    if type_ == "string":
        lines = F.array_join(F.try_variant_get(v, "$", "array<string>"), "\n")
        only = F.element_at(F.map_values(F.try_variant_get(v, "$", "map<string,string>")), 1)
        one = F.size(F.try_variant_get(v, "$", "map<string,variant>")) == 1
        return F.when(kind(v) == "object", F.when(one, F.coalesce(only, F.to_json(v))).otherwise(F.to_json(v))).when(kind(v) == "array", F.coalesce(lines, F.to_json(v))).otherwise(text)
    inner = F.element_at(F.map_values(F.map_filter(F.try_variant_get(v, "$", "map<string,variant>"), lambda k, x: F.try_variant_get(x, "$", type_).isNotNull())), 1)
    return F.coalesce(F.try_variant_get(v, "$", type_), F.when(kind(v) == "object", F.try_variant_get(inner, "$", type_)))


def replay(ingested: DataFrame, targets: tuple[Target, ...] = TARGETS) -> DataFrame:
    """``ingested`` with null typed columns filled from the rescued values of the same or an approved name, in that order.
    A field that went into a column as a whole leaves ``_rescued``; an object of which members were taken stays."""

    def found(m: Column, name: str) -> Column:
        top, _, rest = name.partition(".")
        v = F.try_element_at(m, F.lit(top))
        if rest:  # a member of an object, or of a text that holds one
            v = F.when(v.isNotNull(), F.try_variant_get(F.when(kind(v) == "string", F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v), f"$['{rest}']", "variant"))
        return v

    def filled(m: Column) -> Column:
        # The first value that can be had, with the name it has in the rescued fields.
        named = lambda t, n: let(found(m, n), lambda v: F.when(v.isNotNull(), let(_loose(v, t.type), lambda x: F.when(x.isNotNull(), F.struct(x.alias("x"), F.lit(n).alias("n"))))))
        pick = lambda t: F.when(F.col(t.name).isNull(), F.coalesce(*[named(t, n) for n in (t.name, *t.approved)]))
        return F.struct(*[pick(t).alias(t.name) for t in targets])

    out = ingested.withColumn("_map", F.from_json("_rescued", "map<string,variant>"))
    out = out.withColumn("_filled", let(F.col("_map"), lambda m: F.when(m.isNotNull(), filled(m))))
    used = F.array(*[F.col(f"_filled.{t.name}.n") for t in targets])
    left = F.when(F.col("_map").isNotNull(), F.to_json(let(used, lambda u: F.map_filter("_map", lambda k, v: ~F.coalesce(F.array_contains(F.array_compact(u), k), F.lit(False))))))
    return out.select("_source", "_readable", *[F.coalesce(F.col(t.name), F.col(f"_filled.{t.name}.x")).alias(t.name) for t in targets], left.alias("_rescued"))


def _previous(files: DataFrame, group: str, seq: str, width: int = 1024) -> DataFrame:
    """``files`` (unique in group and seq) with ``before``, the next lower seq of the group; no task holds a whole group, as only the last seq of each run of ``width`` numbers goes into one window."""
    w = F.floor(F.col(seq) / width)
    inner = files.withColumn("_run", w).withColumn("_in", F.lag(seq).over(Window.partitionBy(group, "_run").orderBy(seq)))
    runs = files.groupBy(F.col(group), w.alias("_run")).agg(F.max(seq).alias("_last"))
    runs = runs.select(group, "_run", F.lag("_last").over(Window.partitionBy(group).orderBy("_run")).alias("_out"))
    return inner.join(runs, [group, "_run"]).withColumn("before", F.coalesce("_in", "_out")).drop("_run", "_in", "_out")


def changes(ingested: DataFrame, group: str = "feed", seq: str = "file_seq", record: str = "_id", nested: str = "message") -> DataFrame:
    """(group, seq, cambio, campo_antes, campo_despues): every change of a file against the one before it in its group."""
    base = ingested.select(F.col(f"_source.{group}").alias("g"), F.col(f"_source.{seq}").alias("s"), "_fields").where("g IS NOT NULL AND s IS NOT NULL")
    rec = F.try_variant_get(F.try_element_at(F.col("_fields"), F.lit(record)), "$", "string")
    inner = F.try_variant_get(F.try_element_at(F.col("_fields"), F.lit(nested)), "$", "map<string,variant>")
    # The lines are parsed once and written with each field's type; the steps below read the columns they need.
    entry = lambda name, v: F.struct(name.alias("campo"), v.alias("v"), kind(v).alias("kind"))
    base = cut(base.select("g", "s", rec.alias("rec"), F.concat(
        F.transform(F.map_entries("_fields"), lambda e: entry(e["key"], e["value"])),
        F.coalesce(F.transform(F.map_entries(inner), lambda e: entry(F.concat(F.lit(nested + "."), e["key"]), e["value"])), F.array()),
    ).alias("f")))

    kinds = ("array", "boolean", "number", "object", "string")
    inv = base.select("g", "s", F.explode(F.transform("f", lambda x: F.struct(x["campo"].alias("campo"), x["kind"].alias("kind")))).alias("f")).groupBy("g", "s", "f.campo").agg(*[F.max(F.when(F.col("f.kind") == k, 1).otherwise(0)).alias(k) for k in kinds])
    # Inventories, differences and renamings are small against the lines and used several times: each is written once.
    inv = cut(inv.select("g", "s", "campo", F.concat(*[F.when(F.col(k) == 1, k[0]).otherwise("") for k in kinds]).alias("kinds")))
    files = base.select("g", "s").distinct()
    pairs = cut(_previous(files, "g", "s").where("before IS NOT NULL"))

    after = pairs.join(inv, ["g", "s"]).select("g", "s", "campo", F.col("kinds").alias("now"))
    before = pairs.join(inv.withColumnRenamed("s", "before"), ["g", "before"]).select("g", "s", "campo", F.col("kinds").alias("was"))
    both = before.join(after, ["g", "s", "campo"], "full_outer")
    # Members count only where both files hold the nested field as an object.
    objects = both.where((F.col("campo") == nested) & F.col("was").contains("o") & F.col("now").contains("o")).select("g", "s", F.lit(True).alias("open"))
    diff = both.join(objects, ["g", "s"], "left").where(~F.col("campo").startswith(nested + ".") | F.col("open")).where(
        F.col("was").isNull() | F.col("now").isNull() | ((F.col("was") != F.col("now")) & (F.col("was") != "") & (F.col("now") != "")))
    diff = cut(diff.withColumn("scope", F.col("campo").startswith(nested + ".")))

    gone, come = diff.where("now IS NULL"), diff.where("was IS NULL")
    at = pairs.select("g", "s", "before")
    # Values are read only from files in which a field went and another of its kind came, and only of these fields.
    both_ways = diff.groupBy("g", "s", "scope").agg(F.count_if(F.col("now").isNull()).alias("gone"), F.count_if(F.col("was").isNull()).alias("come")).where("gone > 0 AND come > 0").select("g", "s", "scope")
    need = lambda side: side.join(both_ways, ["g", "s", "scope"], "left_semi").groupBy("g", "s").agg(F.collect_set("campo").alias("need"))
    lines = base.where("rec IS NOT NULL")

    def values(wanted: DataFrame, name: str, value: str) -> DataFrame:
        items = F.transform(F.filter("f", lambda x: F.array_contains("need", x["campo"])), lambda x: F.struct(x["campo"].alias(name), F.to_json(x["v"]).alias(value)))
        return wanted.select("g", "s", "rec", F.inline(items)).withColumn("scope", F.col(name).startswith(nested + "."))

    old = values(lines.withColumnRenamed("s", "before").join(need(gone).join(at, ["g", "s"]), ["g", "before"]), "a", "x")
    new = values(lines.join(need(come), ["g", "s"]), "b", "y")
    null = lambda c: F.coalesce(F.col(c), F.lit("null")) == "null"
    same = (
        old.join(new, ["g", "s", "scope", "rec"])
        .groupBy("g", "s", "a", "b").agg(F.count_if(~null("x") & (F.col("x") == F.col("y"))).alias("eq"), F.count_if((~null("x") | ~null("y")) & ~F.col("x").eqNullSafe(F.col("y"))).alias("ne"))
        .where("eq > 0 AND ne = 0")
    )
    best = lambda k, o: F.row_number().over(Window.partitionBy("g", "s", k).orderBy(F.desc("eq"), o))
    renamed = same.withColumn("ra", best("a", "b")).withColumn("rb", best("b", "a")).where("ra = 1 AND rb = 1").select("g", "s", "a", "b")
    renamed = cut(renamed)

    one = lambda df, what, a, b: df.select("g", "s", F.lit(what).alias("cambio"), a.alias("campo_antes"), b.alias("campo_despues"))
    c, none = F.col("campo"), F.lit("")
    out = (
        one(renamed, "renamed", F.col("a"), F.col("b"))
        .unionByName(one(gone.join(renamed.withColumnRenamed("a", "campo"), ["g", "s", "campo"], "left_anti"), "removed", c, none))
        .unionByName(one(come.join(renamed.withColumnRenamed("b", "campo"), ["g", "s", "campo"], "left_anti"), "added", none, c))
        .unionByName(one(diff.where("was IS NOT NULL AND now IS NOT NULL"), "type", c, c))
    )
    return out.withColumnsRenamed({"g": group, "s": seq})
