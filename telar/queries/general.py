"""Queries of the general problems: instants (2), drifting schemas (4), repeated deliveries (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions.instants import utc_micros, zone_ids
from telar.operators import delivery, drift
from telar.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = zone_ids(spark)

    def block(tbl: str, key: str, fields: list[str]) -> DataFrame:
        t = table(spark, sf_dir, tbl).select(F.col(key).alias("row_id"), "zona_horaria", F.inline(F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("v")) for c in fields])))
        return t.where(F.col("v").isNotNull()).select(F.lit(tbl).alias("tbl"), "campo", "row_id", utc_micros(F.col("v"), F.col("zona_horaria"), zones).alias("utc_us"))

    out = block("event_linking", "row_id", ["article_date", "fecha_inicio"]).unionByName(block("strategy", "strat_id", ["publication_date"]))
    return out.where("utc_us IS NOT NULL")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(drift.ingest(table(spark, sf_dir, "run_extraction_raw")))


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readable records in one consistent table."""
    t = drift.replay(drift.ingest(table(spark, sf_dir, "run_extraction_raw"))).where("_readable")
    return t.select("_source.raw_id", "_source.feed", "_source.file_seq", "_source.line_no", *[x.name for x in drift.TARGETS], "_rescued")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = delivery.repeats(table(spark, sf_dir, "link").select("delivery_id", "_source_id", "delivered_at"), "_source_id", ["delivered_at", "delivery_id"])
    pers = delivery.repeated_members(table(spark, sf_dir, "persistence"), "entity_id", "source_ids")
    return link.select(F.lit("link").alias("tbl"), F.col("delivery_id").alias("holder_id"), F.col("_source_id").alias("source_id")).unionByName(
        pers.select(F.lit("persistence").alias("tbl"), F.col("entity_id").alias("holder_id"), "source_id"))


def p6_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message of link once."""
    return delivery.once(table(spark, sf_dir, "link"), "_source_id", ["delivered_at", "delivery_id"])


QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_table": p4_table, "p6_found": p6_found, "p6_once": p6_once}

SQL = {
    "p6_found": """
        SELECT 'link' AS tbl, delivery_id AS holder_id, _source_id AS source_id FROM (
            SELECT *, row_number() OVER (PARTITION BY _source_id ORDER BY delivered_at, delivery_id) AS rn FROM link WHERE _source_id IS NOT NULL
        ) WHERE rn > 1
        UNION ALL
        SELECT 'persistence' AS tbl, entity_id AS holder_id, source_id FROM (
            SELECT entity_id, unnest(source_ids) AS source_id FROM persistence WHERE entity_id IS NOT NULL
        ) WHERE source_id IS NOT NULL GROUP BY entity_id, source_id HAVING count(*) > 1""",
    "p6_once": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY _source_id ORDER BY delivered_at, delivery_id) AS rn FROM link
        ) WHERE rn = 1 OR _source_id IS NULL""",
}
