"""Locations resolved by a gazetteer table: mentions, lookup by a canonical key, the most precise match, one place struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.text import named_hash, slug

PARTS = ("country", "state", "city", "neighborhood", "zone", "street", "number", "place_name")
LEVELS = (1, 2, 3, 4, 5, 6, 7)


def trimmed(location: Column) -> Column:
    """The parts of a location trimmed, empty ones null."""
    return F.struct(*[F.nullif(F.trim(location[p]), F.lit("")).alias(p) for p in PARTS])


def mentions(location: Column) -> Column:
    """array<struct<level,text,pos>> of the parts that a geocoder takes; the street with its number; the zone is left out."""
    street = F.nullif(F.concat_ws(" ", location["street"], location["number"]), F.lit(""))
    pairs = [("PAIS", location["country"]), ("EST", location["state"]), ("MUN", location["city"]), ("COL", location["neighborhood"]), ("CALLE", street), ("LUG", location["place_name"])]
    found = F.array_compact(F.array(*[F.when(F.trim(c) != "", F.struct(F.lit(k).alias("level"), F.trim(c).alias("text"))) for k, c in pairs]))
    return F.transform(found, lambda x, i: F.struct(x["level"].alias("level"), x["text"].alias("text"), i.alias("pos")))


def location_key(location: Column) -> Column:
    """A digest of the parts' slugs, the same however they are written."""
    return named_hash({p: F.coalesce(slug(location[p]), F.lit("")) for p in PARTS if p != "zone"})


def response(match: Column) -> Column:
    """A geocoder's match (geoid, precision_level, formatted_name, lat, lon, level_1..7 and ids) as the 19-field place struct."""
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        text(match["geoid"]).alias("geoid"), F.coalesce(match["precision_level"].try_cast("int"), F.lit(0)).alias("precision_level"), text(match["formatted_name"]).alias("formatted_name"),
        match["lat"].cast("double").alias("matched_lat"), match["lon"].cast("double").alias("matched_lon"),
        *[text(match[f"level_{n}{x}"]).alias(f"level_{n}{x}") for n in LEVELS for x in ("", "_id")])


def best_match(matches: DataFrame, key: str, order: str) -> DataFrame:
    """The match of highest precision of each ``key``; of equals the first by ``order``."""
    cols = [c for c in matches.columns if c != key]
    rank = F.struct(F.coalesce(F.col("precision_level").try_cast("int"), F.lit(0)).alias("p"), (-F.col(order)).alias("o"))
    return matches.groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("m")).select(key, "m.*")


def geocoded(records: DataFrame, location: str, gazetteer: DataFrame) -> DataFrame:
    """``records`` with ``_geo``, the gazetteer's place (one row per ``location_key``) of the location, null where it has none.

    Distinct keys are looked up, not records, so that a place that a third of all records name is one row of the join.
    """
    t = records.withColumn("_key", location_key(F.col(location)))
    keys = t.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).join(gazetteer, "_key").drop("_n")
    return t.join(keys, "_key", "left").drop("_key")
