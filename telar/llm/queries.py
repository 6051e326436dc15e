"""Queries of the problems on text and near matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions.instants import zone_ids
from telar.llm import bpe, canon, fusion, garbled, normal, packing, places
from telar.session import cut, spread, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normal.same_reading(spread(table(spark, sf_dir, "run_extraction").select("rec_id", "title", "body")), "rec_id", ["title", "body"])
    return out.select("campo", F.col("a").alias("rec_id_a"), F.col("b").alias("rec_id_b"))


def p1_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every title and body."""
    t = spread(table(spark, sf_dir, "run_extraction").select("rec_id", "title", "body"))
    return normal.normalized(normal.normalized(t, "title", "title"), "body", "body")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.found(table(spark, sf_dir, "event_linking"), table(spark, sf_dir, "ref_lugares"), "row_id", ["estado", "pais"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "event_linking").select("row_id", "grupo_id", "estatus", "precio_inf", "afluencia", "fecha_fin", "zona_horaria", "confianza", "extraido_at")
    return fusion.latest(t, "grupo_id", "row_id", fusion.event_fields(zone_ids(spark)), "extraido_at", "confianza")


def p5_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of maximum posterior after copy detection."""
    t = table(spark, sf_dir, "event_linking")
    found = fusion.claims(t, "grupo_id", "row_id", fusion.event_fields(zone_ids(spark)), ["fuente"])
    return fusion.fused(found, "grupo_id", "fuente", "row_id")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spread(table(spark, sf_dir, "event_linking").select("row_id", "calle", "numero", "colonia", "lugar", "ciudad"))
    return places.same_place(t, "row_id").select(F.col("a").alias("row_id_a"), F.col("b").alias("row_id_b"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(_documents(spark, sf_dir), "text").select("doc_id", "ids")


def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each text comes back from its ids."""
    t = bpe.encoded(_documents(spark, sf_dir), "text")
    return t.select("doc_id", F.size("ids").alias("tokens"), (bpe.decoded(F.col("ids")) == F.coalesce("text", F.lit(""))).alias("same"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, piece, tokens, container) of every document with tokens."""
    # Written before they are packed: packing names the size several times, and each would encode the text again.
    sizes = cut(bpe.encoded(_documents(spark, sf_dir), "text").select("doc_id", F.size("ids").alias("size")))
    return packing.packed(sizes, "doc_id", "size", table(spark, sf_dir, "documents").count())


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.restored(_documents(spark, sf_dir), "doc_id", "text").select("doc_id")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected documents with their text restored as far as possible."""
    return garbled.restored(_documents(spark, sf_dir), "doc_id", "text")


QUERIES = {
    "p1_found": p1_found, "p1_texts": p1_texts, "p3_found": p3_found, "p5_found": p5_found, "p5_fused": p5_fused, "p7_found": p7_found,
    "p8_ids": p8_ids, "p8_round_trip": p8_round_trip, "p9_containers": p9_containers, "p10_found": p10_found, "p10_restored": p10_restored,
}
SQL: dict[str, str] = {}
