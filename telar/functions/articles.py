"""Documents of either shape (a nested message, or a flat news hit) as articles, and what is read off them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fields that may hold a document's date, in order of trust.
DATES = ("date_created", "publication_date", "article_date", "date", "created_time", "timestamp")


def filled(c: Column) -> Column:
    """A text other than the empty one."""
    return F.when(c != "", c)


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[filled(c) for c in cols])


def publication_date(df: DataFrame, names: tuple[str, ...] = DATES) -> Column:
    """The first filled of the date fields that ``df`` has."""
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return first_filled(*have) if have else F.lit(None).cast("string")


def reference_date(c: Column, now: Column | None = None) -> Column:
    """A date as dd/mm/yyyy for a prompt; today where there is none."""
    return F.date_format(F.coalesce(c, now if now is not None else F.current_timestamp()), "dd/MM/yyyy")


def text_of(v: Column, path: str) -> Column:
    """A scalar member of a variant as text; objects and lists have none."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), None).otherwise(F.try_variant_get(v, path, "string"))


def list_of(v: Column, path: str) -> Column:
    """A member of a variant as array<string>: a list as it is, a text as a list of itself, else empty."""
    return F.coalesce(F.try_variant_get(v, path, "array<string>"), F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.array(text_of(v, path))), F.array().cast("array<string>"))


def flattened(v: Column, path: str) -> Column:
    """An object of lists and texts as one array<string>, in the order of its keys; other values are left out."""
    members = F.map_values(F.try_variant_get(v, path, "map<string,variant>"))
    return F.coalesce(F.flatten(F.transform(members, lambda x: list_of(x, "$"))), F.array().cast("array<string>"))


def articles(raw: DataFrame, payload: str = "payload", key: str | None = None) -> DataFrame:
    """(id, text, title, url, categories, document_type, source_type, publication_date, news_type) of every readable
    document, ``payload`` being its JSON; ``key`` is a column for ids where a document has neither id nor address."""
    v = F.try_parse_json(F.col(payload))
    t = raw.select(*([F.col(key).cast("string").alias("_key")] if key else [F.lit(None).cast("string").alias("_key")]), v.alias("v")).where("v IS NOT NULL")
    at = lambda *paths: first_filled(*[text_of(F.col("v"), f"$.{p}") for p in paths])
    nested = F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.message", "variant")).startswith("OBJECT"), F.lit(False))
    either = lambda a, b: F.when(F.col("nested"), a).otherwise(b)
    none = F.lit("")
    url = either(F.coalesce(text_of(F.col("v"), "$.message.url"), at("_id")), at("url", "_id"))
    kind = either(F.coalesce(at("type", "message.type"), none), F.coalesce(at("doctype", "type"), F.lit("news")))
    t = t.withColumn("nested", nested).select(
        F.coalesce(at("_id"), filled(url), F.col("_key")).alias("id"), F.coalesce(either(at("message.body"), at("text", "summary")), none).alias("text"), F.coalesce(either(at("message.title"), at("title")), none).alias("title"),
        F.coalesce(url, none).alias("url"), either(F.concat(list_of(F.col("v"), "$.message.source_category"), list_of(F.col("v"), "$.message.source_tags")), flattened(F.col("v"), "$.custom_categories")).alias("categories"),
        F.lower(kind).alias("document_type"), either(at("message.timestamp", "message.created_time"), at("article_date", "date_created", "date", "published_at")).alias("publication_date"), either(at("message.news_type"), at("news_type")).alias("news_type"))
    return t.withColumn("source_type", F.col("document_type"))


def with_provenance(entities: DataFrame, **known: Column) -> DataFrame:
    """``entities`` with provenance columns filled where they are null or absent."""
    return entities.withColumns({k: F.coalesce(F.col(k), c) if k in entities.columns else c for k, c in known.items()})


#: The fields of a record's envelope, which no schema declares.
ENVELOPE = ("_source_id", "_supertype", "date_created", "news_type")


def enveloped(records: DataFrame, normalize) -> DataFrame:
    """``normalize`` (of a DataFrame that keeps the columns it is told to keep) applied to the record without its envelope,
    which is put back beside the result."""
    have = [c for c in ENVELOPE if c in records.columns]
    return normalize(records, have)


def has_type(*types: Column) -> Column:
    """Whether one of the type fields is filled."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.trim(c) != "", F.lit(False)) for c in types])


def source_dates(documents: DataFrame, key: str, date: str, comments: str, comment_key: str) -> DataFrame:
    """(id, date): the first date of each document, and of each of its comments, which take the document's."""
    own = documents.select(F.col(key).alias("id"), F.col(date).alias("date"))
    below = documents.select(F.col(date).alias("date"), F.explode(comments).alias("c")).select(F.col(f"c.{comment_key}").alias("id"), "date")
    return own.unionByName(below).where("id IS NOT NULL AND date IS NOT NULL").groupBy("id").agg(F.min("date").alias("date"))


def context(df: DataFrame) -> DataFrame:
    """The compact form of an event that goes beside a document."""
    return df.select("id", F.struct(*[c for c in ("id", "description", "event_type", "name") if c in df.columns]).alias("event"))


def normal_default_window(end: Column | None = None, days: int = 14) -> tuple[Column, Column]:
    """(start, end) of a period: ``end`` or now, and so many days before."""
    last = end if end is not None else F.current_timestamp()
    return last - F.make_interval(days=F.lit(days)), last


def local_now(zone: str = "America/Mexico_City") -> Column:
    """Now on the clocks of ``zone``."""
    return F.from_utc_timestamp(F.current_timestamp(), zone)
