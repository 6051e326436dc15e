"""Linking of extracted records: keys, candidates, gates, cap and the canonical merge, as joins and aggregations."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telar.functions import geo
from telar.functions.text import name_similarity
from telar.session import cut

LEVELS = geo.LEVELS


@dataclass(frozen=True)
class LinkConfig:
    """Parameters of linking; every function that needs one takes it from here."""

    slack_extracted: int = 1  # least days around an extracted window
    slack_publication: int = 2  # days around a publication date
    max_window_days: int = geo.MAX_DAYS  # longest span of day keys, and most days of slack
    det_day_slack: int = 1  # days around the incoming window in the certain gate, which has its own
    det_levels: tuple[int, ...] = (6, 7)  # levels whose shared id makes a pair certain
    det_publication_levels: tuple[int, ...] = (7,)  # of these, the ones that suffice where a date is a publication's
    hard_geo_gate: bool = True
    cap: int | None = 12  # candidates that go to adjudication
    cell: float = geo.CELL


DEFAULT = LinkConfig()


def prepare(records: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """Records (id, supertype, event_type, start, end, published, precision_days, level_N_id, lat, lon, state) with window and cell."""
    w = geo.window(F.col("start"), F.col("end"), F.col("published"), F.col("precision_days"), config.slack_extracted, config.slack_publication, config.max_window_days)
    return records.withColumns({"window": w, "row": geo.cell(F.col("lat"), config.cell), "col": geo.cell(F.col("lon"), config.cell)})


def _levels(df: DataFrame, prefix: str = "") -> dict:
    """The place ids that ``df`` has, of all levels of the geocoder."""
    return {n: F.col(f"{prefix}level_{n}_id") for n in geo.LEVELS if f"level_{n}_id" in df.columns}


def index_keys(prepared: DataFrame, probe: bool, publication: bool = False, config: LinkConfig = DEFAULT) -> DataFrame:
    """(supertype, geo_key, day, id) under which a record is registered, or probed; with ``publication`` also the days
    around its publication."""
    keys = geo.geo_keys(_levels(prepared), F.col("row"), F.col("col"), F.col("state"), probe)
    spans = _spans(prepared, publication, config)
    days = F.array_distinct(F.flatten(F.transform(spans, lambda x: F.sequence(x["lo"], x["hi"]))))
    return prepared.where("window.start IS NOT NULL").select("supertype", "id", F.explode(keys).alias("geo_key"), days.alias("days")).select("supertype", "id", "geo_key", F.explode("days").alias("day"))


def _spans(prepared: DataFrame, publication: bool, config: LinkConfig) -> Column:
    """array<struct<lo,hi>>: the days of the window with its slack, clamped, and of the publication."""
    w = F.col("window")
    own = geo.day_span(w["start"], w["end"], w["slack"], config.max_window_days)
    if not publication:
        return F.array(own)
    d = F.col("published")
    return F.array_compact(F.array(own, F.when(d.isNotNull(), geo.day_span(d, d, F.lit(config.slack_publication), config.max_window_days))))


#: Days of a time bucket: a window meets few buckets, whatever its slack.
BUCKET = 16  # a power of two
NEVER = 2**31 - 1


def _met(t: DataFrame, probe: Column, held: Column, spans: tuple[Column, list[Column]], keys: str = "", same: tuple[str, ...] = ("supertype",), carry: tuple[str, ...] = (), ids: str = "cand < inc") -> DataFrame:
    """(inc, cand, a_ and b_ of each column of ``carry``): records of ``t`` that agree in the columns of ``same`` and meet
    under a place key on a day, each pair once. ``spans`` are the days that a record probes and is registered under, the
    latter a list; ``ids`` is a condition on inc, cand and what is carried.

    A record has a row per key and bucket of ``BUCKET`` days. A pair that meets under several keys or buckets is given by
    the first that it has in common, which both sides know: cells, then ids from the coarse to the fine. So pairs are never
    gathered to be made distinct, and leave the join as they are found. Cells have a join of their own, which finds most
    pairs and reads no ids.
    """
    number = lambda d: F.shiftright(d, BUCKET.bit_length() - 1)
    fine = {n: F.when(c.isNotNull(), F.concat(F.lit(f"l{n}:"), c)) for n, c in _levels(t).items() if n >= 3}
    cell = F.when(F.col("row").isNotNull(), F.concat(F.lit("g:"), F.col("row").cast("string"), F.lit(","), F.col("col").cast("string")))
    if keys:  # what isn't a key here can't be one in common
        fine, probe, held = {n: F.when(c.rlike(keys), c) for n, c in fine.items()}, F.filter(probe, lambda x: x.rlike(keys)), F.filter(held, lambda x: x.rlike(keys))
        cell = F.when(cell.rlike(keys), cell)
    kind = lambda x: F.coalesce(F.array_position(F.array(*[F.lit(f"l{n}") for n in fine]), F.substring_index(x, ":", 1)).cast("int"), F.lit(0))

    def side(places: Column, days: list[Column], name: str, p: str, places_at: tuple[Column, Column], ids_too: bool) -> DataFrame:
        own = [*[c.alias(f"{p}k{n}") for n, c in fine.items()], places_at[0].alias(p + "row"), places_at[1].alias(p + "col")] if ids_too else []
        places = F.filter(places, lambda x: x.startswith("l") == F.lit(ids_too))
        r = t.select(*same, F.col("id").alias(name), *[F.col(c).alias(p + c) for c in carry], *own, places.alias("_places"),
                     *[x for k, d in enumerate(days) for x in (F.coalesce(F.unix_date(d["lo"]), F.lit(NEVER)).alias(f"{p}lo{k}"), F.coalesce(F.unix_date(d["hi"]), F.lit(-NEVER)).alias(f"{p}hi{k}"))])
        runs = [F.when(F.col(f"{p}lo{k}") != NEVER, F.sequence(number(F.col(f"{p}lo{k}")), number(F.col(f"{p}hi{k}")))) for k in range(len(days))]
        r = r.withColumn("_buckets", F.array_distinct(F.flatten(F.array_compact(F.array(*runs)))))
        r = r.withColumn("geo_key", F.explode("_places")).drop("_places")
        return r.withColumn("bucket", F.explode("_buckets")).drop("_buckets")

    one, several = spans
    here = (F.when(cell.isNotNull(), F.col("row")), F.when(cell.isNotNull(), F.col("col")))
    c = F.col
    # The first day on which a pair meets names the bucket that gives it. Few columns and no nulls: this runs for every two
    # records of a key, and code that is too long is never compiled.
    days = [F.when((c("_alo0") <= c(f"_bhi{k}")) & (c(f"_blo{k}") <= c("_ahi0")), F.greatest("_alo0", f"_blo{k}")).otherwise(NEVER) for k in range(len(several))]
    meet = number(F.least(*days) if len(days) > 1 else days[0]) == c("bucket")
    # Records that are registered by something coarse have neither cell nor fine id, and one such key.
    first = F.when(F.coalesce((F.abs(c("_arow") - c("_brow")) <= 1) & (F.abs(c("_acol") - c("_bcol")) <= 1), F.lit(False)), False)
    for k, n in enumerate(list(fine)[:-1], 1):
        first = first.when(c("_kind") == k, True).when(F.coalesce(c(f"_ak{n}") == c(f"_bk{n}"), F.lit(False)), False)

    def found(ids_too: bool) -> DataFrame:
        left = side(probe, [one], "inc", "_a", (F.col("row"), F.col("col")), ids_too)
        right = side(held, several, "cand", "_b", here, ids_too)
        right = right.withColumn("_kind", kind(F.col("geo_key"))) if ids_too else right
        left, right = (x.toDF(*[c.replace(p, p[1:] + "_", 1) if c[len(p):] in carry else c for c in x.columns]) for x, p in ((left, "_a"), (right, "_b")))
        # Merged, as the size that is estimated for exploded sides is that of the rows before.
        j = left.hint("merge").join(right, [*same, "geo_key", "bucket"]).where(ids).where(meet)
        j = j.where(first.otherwise(True)) if ids_too else j
        return j.select("inc", "cand", *[p + x for p in ("a_", "b_") for x in carry])

    only_ids = keys.startswith("^l")
    return found(True) if only_ids else found(False).unionByName(found(True)) if fine else found(False)


def _by_keys(prepared: DataFrame, config: LinkConfig, keys: str = "", **more) -> DataFrame:
    """``_met`` for records as they are held in memory: a record probes the days of its window, and is registered under
    these and the days around its publication."""
    t = prepared.where("window.start IS NOT NULL")
    spans = _spans(prepared, True, config)
    own, published = F.get(spans, F.lit(0)), F.get(spans, F.lit(1))
    places = lambda probe: geo.geo_keys(_levels(prepared), F.col("row"), F.col("col"), F.col("state"), probe)
    return _met(t, places(True), places(False), (own, [own, published]), keys, **more)


def candidates(prepared: DataFrame, config: LinkConfig = DEFAULT, keys: str = "") -> DataFrame:
    """(inc, cand): records that meet under a place key on a day, the candidate with the smaller id, each pair once.

    ``keys``: only place keys that match this pattern.
    """
    return _by_keys(prepared, config, keys)


def candidates_by_range(prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """(inc, cand): the lookup as tables answer it. Registered is the envelope of a record's window without clamp, and no
    publication days beside it; records meet by an id of level 3 or finer, by the 3 x 3 cells, or by the state where the
    candidate has neither fine id nor cell. Records without any of these find nothing. Never an OR between kinds of place."""
    w = F.col("window")
    t = prepared.where("window.start IS NOT NULL")
    fine = [F.when(c.isNotNull(), F.concat(F.lit(f"l{n}:"), c)) for n, c in _levels(t).items() if n >= 3]
    here = F.when(F.col("row").isNotNull(), F.concat(F.lit("g:"), F.col("row").cast("string"), F.lit(","), F.col("col").cast("string")))
    state = F.when(F.col("level_2_id").isNotNull(), F.concat(F.lit("so:"), "level_2_id"))
    around = F.when(F.col("row").isNotNull(), F.transform(geo.neighbours(F.col("row"), F.col("col")), lambda x: F.concat(F.lit("g:"), x["r"].cast("string"), F.lit(","), x["c"].cast("string"))))
    probe = F.array_compact(F.concat(F.array(*fine, state), F.coalesce(around, F.array().cast("array<string>"))))
    held = F.array_compact(F.array(*fine, here))
    held = F.when(F.size(held) > 0, held).otherwise(F.array_compact(F.array(state)))
    span = F.struct(F.date_sub(w["start"], w["slack"]).alias("lo"), F.date_add(w["end"], w["slack"]).alias("hi"))
    return _met(t, probe, held, (span, [span]))


#: The two candidate indexes: by keys, as records held in memory are found, and by ranges, as tables are.
INDEXES = {"keys": candidates, "range": candidates_by_range}


def gated(pairs: DataFrame, prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """``pairs`` with ``geo_ok`` (one id path contains the other), ``leaf`` (whether their fine ids are the same place:
    misma, distinta, or null where one has none) and ``certain``: same leaf type, shared fine id (of a publication level
    where a date is only the publication's), windows that meet with the gate's own slack on the incoming side."""
    cols = _gate_columns(prepared)
    side = lambda k, p: prepared.select(F.col("id").alias(k), *[F.col(c).alias(p + c) for c in cols])
    return _gates(pairs.join(side("inc", "a_"), "inc").join(side("cand", "b_"), "cand"), prepared, config)


def _gate_columns(prepared: DataFrame) -> tuple[str, ...]:
    return ("event_type", "window", "published", *(f"level_{n}_id" for n in _levels(prepared)))


def _gates(j: DataFrame, prepared: DataFrame, config: LinkConfig, *more: str) -> DataFrame:
    """What ``gated`` gives, and the columns ``more``, for pairs with both sides' ``_gate_columns`` under a_ and b_."""
    shared = lambda levels: reduce(lambda x, y: x | y, [F.coalesce(F.col(f"a_level_{n}_id") == F.col(f"b_level_{n}_id"), F.lit(False)) for n in levels])
    some = lambda p: F.coalesce(*[F.col(f"{p}_level_{n}_id") for n in config.det_levels]).isNotNull()
    exact = (F.col("a_window.source") == "extracted") & (F.col("b_window.source") == "extracted")
    fine = F.when(exact, shared(config.det_levels)).otherwise(shared(config.det_publication_levels))
    meet = geo.overlaps(F.col("a_window.start"), F.col("a_window.end"), F.lit(config.det_day_slack), F.col("b_window.start"), F.col("b_window.end"))
    fits = geo.compatible(_levels(prepared, "a_"), _levels(prepared, "b_")) if config.hard_geo_gate else F.lit(True)
    return j.select("inc", "cand", F.col("b_published").alias("published"), fits.alias("geo_ok"),
                    F.when(some("a") & some("b"), F.when(shared(config.det_levels), "misma").otherwise("distinta")).alias("leaf"),
                    F.coalesce((F.col("a_event_type") == F.col("b_event_type")) & fine & meet, F.lit(False)).alias("certain"), *more)


def _certain_classes(prepared: DataFrame, config: LinkConfig) -> tuple[DataFrame, DataFrame]:
    """(classes, pairs): records that the certain gate can't tell apart but by their id are one class (class, ids, in
    order); pairs of classes (inc, cand, published, leaf) that the gate joins, each with itself included."""
    cols = ("supertype", *_gate_columns(prepared))
    levels = sorted({*config.det_levels, *config.det_publication_levels})
    fine = reduce(lambda x, y: x | y, [F.col(f"level_{n}_id").isNotNull() for n in levels])
    classes = prepared.where(fine & F.col("window.start").isNotNull() & F.col("event_type").isNotNull() & F.col("supertype").isNotNull()).groupBy(*cols).agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = cut(classes.withColumns({"id": F.get("ids", F.lit(0)), "most": F.element_at("ids", -1), **{c: F.lit(None).cast(k) for c, k in (("row", "bigint"), ("col", "bigint"), ("state", "string"))}}))
    keys = f"^l({'|'.join(map(str, levels))}):"  # all that the gate needs
    met = _by_keys(classes, config, keys, same=("supertype", "event_type"), carry=("most", *(c for c in _gate_columns(prepared) if c != "event_type")), ids="cand < a_most")
    met = met.withColumns({"a_event_type": F.lit(""), "b_event_type": F.lit("")})  # already the same
    return classes.select(F.col("id").alias("class"), "ids"), _gates(met, prepared, config).where("geo_ok AND certain").select("inc", "cand", "published", "leaf")


def certain(prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """(inc, cand, published, leaf): the pairs that ``gated`` finds geo-compatible and certain among the candidates. The
    gate is asked once for each pair of classes of equal records, and the pairs of records come from the classes' ids."""
    classes, pairs = _certain_classes(prepared, config)
    j = pairs.join(classes.toDF("inc", "a"), "inc").join(classes.toDF("cand", "b"), "cand")
    j = j.select("published", "leaf", F.explode("a").alias("inc"), "b").select("inc", F.explode("b").alias("cand"), "published", "leaf")
    return j.where("cand < inc")


def _certain_first(prepared: DataFrame, config: LinkConfig, latest: bool, most: int) -> DataFrame:
    """(inc, kept): the first ``most`` certain candidates of each incoming record, by publication and then id; none has no row.

    Of candidates of one publication day, those with a smaller id than the incoming record are the first of all. So the
    first ``most`` of each day are enough for all records of a class, and no list of all pairs is made.
    """
    classes, pairs = _certain_classes(prepared, config)
    firsts = classes.select(F.col("class").alias("cand"), F.slice("ids", 1, most).alias("some"))
    day = F.unix_date("published") * (-1 if latest else 1)
    rows = pairs.join(firsts, "cand").groupBy("inc", "published").agg(F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, most).alias("some"))
    item = F.transform("some", lambda x: F.struct(F.col("published").isNull().alias("none"), day.alias("day"), x.alias("cand")))
    lists = rows.select("inc", item.alias("items")).groupBy("inc").agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))
    j = lists.withColumnRenamed("inc", "class").join(classes, "class").select(F.explode("ids").alias("inc"), "items")
    kept = j.select("inc", F.slice(F.filter("items", lambda x: x["cand"] < F.col("inc")), 1, most).alias("kept"))
    return kept.where(F.size("kept") > 0).select("inc", F.transform("kept", lambda x: x["cand"]).alias("kept"))


def certain_capped(prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """(inc, cand, rank): ``capped`` of the certain pairs."""
    return _certain_first(prepared, config, True, config.cap).select("inc", F.posexplode("kept").alias("rank", "cand")).select("inc", "cand", (F.col("rank") + 1).alias("rank"))


def certain_decided(prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """(inc, match): ``decided`` over all candidates."""
    return _certain_first(prepared, config, False, 1).select("inc", F.get("kept", F.lit(0)).alias("match"))


def referrals(prepared: DataFrame, config: LinkConfig = DEFAULT) -> DataFrame:
    """(inc, cand, published, geo_ok, leaf, certain, rank): ``referred`` over all candidates. Records with a certain match
    don't probe, and the gate is asked within the join."""
    done = certain_decided(prepared, config).select(F.col("inc").alias("id"), F.lit(True).alias("_done"))
    t = prepared.join(done, "id", "left").withColumn("_done", F.col("_done").isNotNull())
    met = _by_keys(t, config, carry=("_done", *_gate_columns(prepared)), ids="cand < inc AND NOT a__done")
    return capped(_gates(met, prepared, config).where("geo_ok"), config.cap)


def capped(pairs: DataFrame, cap: int = DEFAULT.cap) -> DataFrame:
    """At most ``cap`` candidates per incoming record, the latest published first, then the smaller id."""
    w = Window.partitionBy("inc").orderBy(F.desc_nulls_last("published"), "cand")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)


def decided(pairs: DataFrame) -> DataFrame:
    """(inc, match): the certain candidate published first, then of the smallest id; the order of a set is made explicit."""
    return pairs.where("geo_ok AND certain").groupBy("inc").agg(F.min(F.struct(F.col("published").isNull().alias("n"), "published", "cand")).alias("m")).select("inc", F.col("m.cand").alias("match"))


def referred(pairs: DataFrame, cap: int = DEFAULT.cap) -> DataFrame:
    """``capped`` geo-compatible candidates of the incoming records without a certain match, as they go to adjudication."""
    fit = pairs.where("geo_ok")
    return capped(fit.join(fit.where("certain").select("inc").distinct(), "inc", "left_anti"), cap)


def canonical(members: DataFrame) -> DataFrame:
    """One canonical record per ``link_id`` from its members in order of ``seq``: (link_id, seq, source_id, news_type, name,
    description, context, status, published, window, location, geo_precision).

    First filled name, description, context and status; the earliest publication; the extracted window of the best
    precision with its start, end and precision (null counts as 0, ties the earliest seen), else none; the location of
    strictly higher precision (so the first of the highest); sources once, in order, with a ledger of each source's own
    publication and news type; the windows of all members.
    """
    seq = F.col("seq")
    full = lambda c: F.when(F.trim(c) != "", F.col(c))
    first = lambda c: F.min_by(full(c), F.when(full(c).isNotNull(), seq)).alias(c)
    w = F.col("window")
    has = F.col("source_id").isNotNull()
    ledger = F.array_sort(F.collect_list(F.when(has, F.struct(seq.alias("seq"), "source_id", F.col("published").alias("publication_date"), "news_type"))))
    # Sources once, before the ledger is built: a source repeated by a third of all rows is one element.
    firsts = members.where(has).groupBy("link_id", "source_id").agg(F.min(F.struct("seq", "published", "news_type")).alias("f")).select("link_id", "source_id", "f.*")
    sources = firsts.groupBy("link_id").agg(ledger.alias("_l")).select("link_id", F.transform("_l", lambda x: x["source_id"]).alias("source_ids"), F.transform("_l", lambda x: x.dropFields("seq")).alias("_sources"))
    windows = F.transform(F.array_sort(F.collect_list(F.struct(seq.alias("seq"), w.alias("w")))), lambda x: x["w"])
    best = F.min_by(F.struct(w["start"].alias("start"), w["end"].alias("end"), F.col("precision_days")), F.when(w["source"] == "extracted", F.struct(F.coalesce("precision_days", F.lit(0)).alias("p"), seq)))
    out = members.groupBy("link_id").agg(
        *[first(c) for c in ("name", "description", "context", "status")], F.min("published").alias("publication_date"), best.alias("date_range"),
        F.max_by(F.struct("location", F.coalesce("geo_precision", F.lit(0)).alias("precision")), F.struct(F.coalesce("geo_precision", F.lit(0)), -seq)).alias("place"),
        F.min_by(w["source"], seq).alias("_date_source"), windows.alias("_source_windows"), F.count(F.lit(1)).alias("n"))
    return out.join(sources, "link_id", "left").withColumns({"source_ids": F.coalesce("source_ids", F.array().cast("array<string>"))})


def drop_reason(supertype: Column, category: Column, event_type: Column, window: Column, strategies: tuple[str, ...] = ("event",)) -> Column:
    """Why a record isn't linked, in order: no_supertype, no_schema (its supertype has no category), skipped_category:...,
    no_type, no_date; null where it is linked."""
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    return (
        F.when(blank(supertype), "no_supertype").when(category.isNull(), "no_schema").when(~category.isin(*strategies), F.concat(F.lit("skipped_category:"), category))
        .when(blank(event_type), "no_type").when(window["start"].isNull(), "no_date"))


def case_log(pairs: DataFrame, prepared: DataFrame, names: DataFrame) -> DataFrame:
    """(inc, n_candidates, candidates): for each incoming record its candidates with distance in metres (1 digit) and name
    similarity (3 digits, where both have a name), in order of id."""
    side = lambda k, p: prepared.select(F.col("id").alias(k), F.col("lat").alias(p + "lat"), F.col("lon").alias(p + "lon")).join(names.select(F.col("id").alias(k), F.col("name").alias(p + "name")), k, "left")
    j = pairs.select("inc", "cand").join(side("inc", "a_"), "inc").join(side("cand", "b_"), "cand")
    both = F.coalesce(F.col("a_name"), F.lit("")) != ""
    both = both & (F.coalesce(F.col("b_name"), F.lit("")) != "")
    item = F.struct(F.col("cand").alias("id"), F.col("b_name").alias("name"), F.round(geo.haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")), 1).alias("geo_dist_m"), F.when(both, F.round(name_similarity(F.col("a_name"), F.col("b_name")), 3)).alias("name_sim"))
    return j.groupBy("inc").agg(F.count(F.lit(1)).alias("n_candidates"), F.array_sort(F.collect_list(item)).alias("candidates"))
