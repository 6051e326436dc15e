"""The linking fold: records, in order of arrival, each merged into a canonical record seen before or made a new one.

A merge without adjudication needs the same supertype and leaf type and a shared street or place, so that records of
different streets never touch: the fold runs in parallel over (supertype, leaf type, street), in order of arrival within
each. It is one pass over sorted partitions (``mapInPandas``): records stream by, and only the canonicals of the current
street are held, so that a street with a third of all records is no group in memory. Records without street or place
become canonicals of their own without Python. Adjudicated answers come in as a table ``answers`` (id, match_id).

State is a table: ``link`` takes the canonicals written before, so that batches one after the other, or a stream's
micro-batches, give what one batch over all gives. The canonicals themselves are aggregated by ``linking.canonical``.

Defined results: records that ``drop_reason`` names are left out; ties among several matching canonicals go to the earliest
publication, then the smaller link id; ids are digests of source and record, so that a repeated run gives the same ones.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telar.functions import geo
from telar.operators.linking import DEFAULT, LinkConfig

LEVELS = geo.LEVELS


def _street(records: DataFrame) -> DataFrame:
    """``records`` with ``street``: the id of level 6, that of the place's street (places are nested in streets), or the place's own."""
    r = records
    if "level_7_id" not in r.columns:
        return r.withColumn("street", F.col("level_6_id"))
    known = r.where("level_7_id IS NOT NULL AND level_6_id IS NOT NULL").groupBy("level_7_id").agg(F.min("level_6_id").alias("_s"))
    lone = r.where("level_6_id IS NULL AND level_7_id IS NOT NULL").join(known, "level_7_id", "left").withColumn("street", F.coalesce("_s", "level_7_id")).drop("_s")
    return lone.unionByName(r.where("level_6_id IS NOT NULL OR level_7_id IS NULL").withColumn("street", F.col("level_6_id")))


def link_ids(prepared: DataFrame, source: str, state: str = "state") -> DataFrame:
    """``prepared`` with ``new_id``: YYYYMMDD, the state or noloc, and 12 digits of the digest of source and record id."""
    day = F.date_format(F.coalesce("window.start", "published"), "yyyyMMdd")
    place = F.regexp_replace(F.coalesce(F.nullif(F.col(state), F.lit("")), F.lit("noloc")), " ", "-")
    return prepared.withColumn("new_id", F.concat_ws("_", day, place, F.left(F.sha2(F.concat_ws("|", F.col(source).cast("string"), F.col("id").cast("string")), 256), F.lit(12))))


class _Canonical:
    __slots__ = ("id", "levels", "precision", "start", "end", "extracted", "days", "published")

    def __init__(self, link_id, levels, precision, start, end, extracted, days, published):
        self.id, self.levels, self.precision, self.start, self.end, self.extracted, self.days, self.published = link_id, levels, precision, start, end, extracted, days, published


def _inside(a: dict, b: dict) -> bool:
    return all(b.get(k) == v for k, v in a.items())


class _Street:
    """The canonicals of one street, found by the days of their windows."""

    def __init__(self, config: LinkConfig):
        self.config, self.all, self.by_bucket = config, {}, {}

    def _buckets(self, lo, hi):
        return range(lo.toordinal() // 32, hi.toordinal() // 32 + 1)

    def put(self, c: _Canonical) -> None:
        self.all[c.id] = c
        for k in self._buckets(c.start, c.end):
            self.by_bucket.setdefault(k, set()).add(c.id)

    def match(self, r: _Canonical) -> _Canonical | None:
        slack = timedelta(days=self.config.det_day_slack)
        lo, hi = r.start - slack, r.end + slack
        best = None
        for link_id in {x for k in self._buckets(lo, hi) for x in self.by_bucket.get(k, ())}:
            c = self.all[link_id]
            levels = self.config.det_levels if r.extracted and c.extracted else self.config.det_publication_levels
            if not any(n in r.levels and r.levels[n] == c.levels.get(n) for n in levels) or not (lo <= c.end and c.start <= hi):
                continue
            if self.config.hard_geo_gate and not (_inside(r.levels, c.levels) or _inside(c.levels, r.levels)):
                continue
            key = (c.published is None, c.published or r.start, c.id)
            if best is None or key < best[0]:
                best = (key, c)
        return best and best[1]

    def merge(self, c: _Canonical, r: _Canonical) -> None:
        if r.published and (c.published is None or r.published < c.published):
            c.published = r.published
        if r.extracted and (not c.extracted or (r.days or 0) < (c.days or 0)):
            c.start, c.end, c.extracted, c.days = r.start, r.end, True, r.days
        elif not c.extracted and c.published:
            c.start = c.end = c.published
        if r.precision > c.precision:
            c.levels, c.precision = r.levels, r.precision
        self.put(c)


def link(prepared: DataFrame, order: list[str], state: DataFrame | None = None, config: LinkConfig = DEFAULT, answers: DataFrame | None = None) -> DataFrame:
    """(id, link_id, status): the canonical of each record and whether it was created or merged into one.

    ``prepared`` are records as ``linking.prepare`` gives them with ``new_id`` (``link_ids``) and ``geo_precision``, ``order``
    the columns of their arrival. ``state`` are canonicals written before: (link_id, supertype, event_type, start, end,
    extracted, precision_days, published, geo_precision, level_N_id).
    """
    levels = [f"level_{n}_id" for n in LEVELS if f"level_{n}_id" in prepared.columns]
    dated = prepared.where("window.start IS NOT NULL")
    rows = _street(dated.select(
        "id", "supertype", "event_type", "new_id", F.col("window.start").alias("start"), F.col("window.end").alias("end"), (F.col("window.source") == "extracted").alias("extracted"),
        "precision_days", F.col("published").cast("date").alias("published"), F.coalesce("geo_precision", F.lit(0)).alias("geo_precision"), F.struct(*order).alias("_order"), *levels))
    fine = "street IS NOT NULL AND event_type IS NOT NULL"
    lone = rows.where(f"NOT ({fine})").select("id", F.col("new_id").alias("link_id"), F.lit("created").alias("status"))
    work = rows.where(fine).withColumn("_old", F.lit(False))
    kind = prepared.schema["id"].dataType.simpleString()
    if state is not None:
        old = _street(state.select(F.lit(None).cast(kind).alias("id"), "supertype", "event_type", F.col("link_id").alias("new_id"), "start", "end", "extracted", "precision_days", "published", F.coalesce("geo_precision", F.lit(0)).alias("geo_precision"), *levels))
        old = old.where(fine).withColumns({"_old": F.lit(True), "_order": F.lit(None).cast(work.schema["_order"].dataType)})
        work = work.unionByName(old)
    shard = ["supertype", "event_type", "street"]
    work = work.repartition(*shard).sortWithinPartitions(*shard, F.desc("_old"), "_order").drop("_order")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, now = None, None
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                key = (r["supertype"], r["event_type"], r["street"])
                if key != here:
                    here, now = key, _Street(config)
                none = lambda x: None if x is None or x != x else x
                path = {n: r[f"level_{n}_id"] for n in LEVELS if none(r.get(f"level_{n}_id"))}
                days = none(r["precision_days"])
                c = _Canonical(r["new_id"], path, int(r["geo_precision"]), r["start"], r["end"], bool(r["extracted"]), days, none(r["published"]))
                if r["_old"]:
                    now.put(c)
                    continue
                found = now.match(c)
                if found is not None:
                    now.merge(found, c)
                    out.append((r["id"], found.id, "merged"))
                else:
                    now.put(c)
                    out.append((r["id"], c.id, "created"))
            yield pd.DataFrame(out, columns=["id", "link_id", "status"])

    done = lone.unionByName(work.mapInPandas(fold, f"id {kind}, link_id string, status string"))
    if answers is None:
        return done
    # An adjudicated answer turns a creation into a merge, if the record that it names exists.
    named = answers.select("id", F.col("match_id")).join(done.select(F.col("id").alias("match_id"), F.col("link_id").alias("_to")), "match_id").groupBy("id").agg(F.min("_to").alias("_to"))
    return done.join(named, "id", "left").select("id", F.when((F.col("status") == "created") & F.col("_to").isNotNull(), F.col("_to")).otherwise(F.col("link_id")).alias("link_id"), F.when(F.col("_to").isNotNull(), "merged").otherwise(F.col("status")).alias("status"))


def states(prepared: DataFrame, linked: DataFrame, order: list[str]) -> DataFrame:
    """The ``state`` that later batches take, from records and their links: window, publication and place of each canonical."""
    levels = [f"level_{n}_id" for n in LEVELS if f"level_{n}_id" in prepared.columns]
    w, seq = F.col("window"), F.struct(*order)
    exact = w["source"] == "extracted"
    t = prepared.join(linked.select("id", "link_id"), "id")
    best = F.min_by(F.struct(w["start"].alias("start"), w["end"].alias("end"), "precision_days"), F.when(exact, F.struct(F.coalesce("precision_days", F.lit(0)).alias("p"), seq.alias("s"))))
    place = F.max_by(F.struct(*levels, F.coalesce("geo_precision", F.lit(0)).alias("geo_precision")), F.struct(F.coalesce("geo_precision", F.lit(0)).alias("p")))
    out = t.groupBy("link_id").agg(F.first("supertype").alias("supertype"), F.first("event_type").alias("event_type"), best.alias("b"), F.min(F.col("published").cast("date")).alias("published"), place.alias("p"))
    return out.select("link_id", "supertype", "event_type", F.coalesce("b.start", "published").alias("start"), F.coalesce("b.end", "published").alias("end"), F.col("b").isNotNull().alias("extracted"), F.col("b.precision_days").alias("precision_days"), "published", "p.*")
