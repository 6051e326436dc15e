"""Structured Streaming: documents claimed once, matched, linked against the canonicals so far and written, batch by batch.

A batch is written under its number, so that a repeated batch overwrites itself: delivery at least once has the effect of
exactly once. Documents that can't be read, or failed ``ATTEMPTS`` times, go to the dead letters with their reason; a
failure of the sink fails the batch, which Spark repeats. The state of documents is a table: ``processing`` (a claim, with
a short life), ``processed`` (with a long one) or released.
"""

from __future__ import annotations

import signal
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telar.operators.matching import match

PROCESSED = "14 days"
PROCESSED_SECONDS, CLAIM_SECONDS, ATTEMPTS = 14 * 24 * 3600, 600, 5


def documents(spark: SparkSession, path: str, schema: str, per_batch: int = 10) -> DataFrame:
    """A stream of JSON-lines files, ``per_batch`` files a batch, with the line kept in ``_line``."""
    raw = spark.readStream.option("maxFilesPerTrigger", per_batch).text(path)
    return raw.select(F.col("value").alias("_line"), F.from_json("value", schema).alias("d")).select("_line", "d.*")


def queue(spark: SparkSession, servers: str, topic: str, schema: str, per_batch: int = 1000) -> DataFrame:
    """The same from a Kafka topic (its connector must be on the class path); ``per_batch`` is the prefetch."""
    raw = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, "maxOffsetsPerTrigger": str(per_batch)}).load()
    return raw.select(F.col("value").cast("string").alias("_line")).select("_line", F.from_json("_line", schema).alias("d")).select("_line", "d.*")


def once(stream: DataFrame, key: str, time: str, within: str = PROCESSED) -> DataFrame:
    """Each identifier once within the time that processed documents are remembered."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


# --- the state of documents as a table of events: (id, state, at), the last of each id within its life counts -----------

def current(log: DataFrame, now: Column, processed: int = PROCESSED_SECONDS, claim: int = CLAIM_SECONDS) -> DataFrame:
    """(id, state): what each document is now. Processed outlives everything; a claim lapses; released is nothing."""
    age = now.cast("timestamp").cast("long") - F.col("at").cast("timestamp").cast("long")
    alive = F.when(F.col("state") == "processed", age < processed).when(F.col("state") == "processing", age < claim).otherwise(F.lit(True))
    t = log.where("id IS NOT NULL AND id <> ''").where(alive)
    done = F.max(F.when(F.col("state") == "processed", 1).otherwise(0))
    last = F.max_by("state", F.struct("at", F.when(F.col("state") == "released", 0).otherwise(1)))
    return t.groupBy("id").agg(F.when(done == 1, F.lit("processed")).otherwise(last).alias("state")).where("state <> 'released'")


def claimable(batch: DataFrame, log: DataFrame, key: str, now: Column) -> DataFrame:
    """The rows of ``batch`` whose document may be claimed: neither processed nor in work, one row each; without id none."""
    fresh = batch.where(F.col(key).isNotNull() & (F.col(key) != "")).dropDuplicates([key])
    return fresh.join(current(log, now).select(F.col("id").alias(key)), key, "left_anti")


def marked(rows: DataFrame, key: str, state: str, now: Column) -> DataFrame:
    """The events that put the documents of ``rows`` into ``state``."""
    return rows.select(F.col(key).alias("id"), F.lit(state).alias("state"), now.cast("timestamp").alias("at"))


def outcomes(rows: DataFrame, reason: Column, attempts: Column, most: int = ATTEMPTS) -> DataFrame:
    """``rows`` with ``outcome``: ok, retry (failed, with attempts left) or dead, and ``reason``; what can't be read is dead at once."""
    r = rows.withColumn("reason", reason)
    fate = F.when(F.col("reason").isNull(), "ok").when(F.col("reason").startswith("malformed") | (attempts >= most), "dead").otherwise("retry")
    return r.withColumn("outcome", fate)


def run(stream: DataFrame, rules: DataFrame, out: str, dead: str, checkpoint: str, available_now: bool = True, then: Callable[[DataFrame, DataFrame, int], None] | None = None) -> StreamingQuery:
    """Matches each batch against ``rules``; rows without id or text go to ``dead``. ``then`` (documents, matches, number) is
    what follows in the same batch: extraction, linking and persistence. ``trace_id`` passes through where documents have it."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            good = df.where("id IS NOT NULL AND text IS NOT NULL").dropDuplicates(["id"])
            found = match(good.select("id", "text", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), F.col("document_type")), rules)
            if "trace_id" in df.columns:
                found = found.join(good.select("id", "trace_id"), "id")
            found.write.mode("overwrite").parquet(f"{out}/batch={number}")
            df.where("id IS NULL OR text IS NULL").select("_line", F.lit("malformed").alias("reason")).write.mode("overwrite").parquet(f"{dead}/batch={number}")
            if then:
                then(good, found, number)
        finally:
            df.unpersist()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")).start()


def linked_batches(spark: SparkSession, path: str, prepare: Callable[[DataFrame], DataFrame], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch that links records (``prepare`` gives them as ``fold.link`` takes them) against all links written under
    ``path`` by earlier batches, and writes its own under its number. A record linked before keeps its link."""
    from telar.operators import fold

    def stored(name: str, number: int) -> DataFrame | None:
        jvm = spark._jvm.org.apache.hadoop.fs
        root = jvm.Path(f"{path}/{name}")
        fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(root) or not any(int(s.getPath().getName().split("=")[1]) < number for s in fs.listStatus(root) if "=" in s.getPath().getName()):
            return None
        return spark.read.parquet(f"{path}/{name}").where(F.col("batch") < number)

    def batch(df: DataFrame, number: int) -> None:
        new = prepare(df)
        links, records = stored("links", number), stored("records", number)
        if links is not None:
            new = new.join(links.select("id"), "id", "left_anti")
        new = new.persist()
        try:
            state = fold.states(records.drop("batch"), links.drop("batch"), order) if links is not None else None
            fold.link(new, order, state).write.mode("overwrite").parquet(f"{path}/links/batch={number}")
            new.write.mode("overwrite").parquet(f"{path}/records/batch={number}")
        finally:
            new.unpersist()

    return batch


def stop_on_signal(query: StreamingQuery, *signals: int) -> None:
    """Stops the query, after the batch in work, when the process is told to end."""
    for s in signals or (signal.SIGTERM, signal.SIGINT):
        signal.signal(s, lambda *_: query.stop())
