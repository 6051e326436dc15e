"""Queries of the event graph's own operators over the test tables, with their SQL. Names start with the survey's IDs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telar.functions import geo, text, types
from telar.functions.instants import zone_ids
from telar.operators import linking, matching, reports, upserts
from telar.session import table

# Event records from the table events: days, grid coordinates and nested place ids. Runs on Spark and DuckDB alike.
EV = """
SELECT event_id, event_type, user_id, k, CAST(ts AS date) AS day,
       CASE WHEN event_type IN ('click','view') THEN 'web' ELSE 'account' END AS supertype,
       CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS date) END AS ext_day,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 4 AS int) END AS precision_days,
       20500000 + (k * 137) % 9000 AS lat6, -100400000 + (user_id * 91) % 9000 AS lon6,
       CASE WHEN event_id % 11 <> 0 THEN '_1' END AS level_1_id,
       CASE WHEN event_id % 11 <> 0 THEN concat('_1', lpad(CAST(CAST(floor(k / 25.0) AS int) AS varchar(9)), 2, '0')) END AS level_2_id,
       CASE WHEN event_id % 11 <> 0 THEN concat('_1', lpad(CAST(CAST(floor(k / 25.0) AS int) AS varchar(9)), 2, '0'), lpad(CAST(CAST(floor(k / 5.0) AS int) AS varchar(9)), 3, '0')) END AS level_3_id,
       CASE WHEN event_id % 11 <> 0 AND event_id % 4 = 0 THEN concat('_1', lpad(CAST(CAST(floor(k / 25.0) AS int) AS varchar(9)), 2, '0'), lpad(CAST(CAST(floor(k / 5.0) AS int) AS varchar(9)), 3, '0'), 'c', CAST(user_id % 2 AS varchar(9))) END AS level_5_id,
       CASE WHEN event_id % 11 <> 0 AND event_id % 2 = 0 THEN concat('_1', lpad(CAST(CAST(floor(k / 25.0) AS int) AS varchar(9)), 2, '0'), lpad(CAST(CAST(floor(k / 5.0) AS int) AS varchar(9)), 3, '0'), lpad(CAST(k AS varchar(9)), 4, '0')) END AS level_6_id,
       CASE WHEN event_id % 11 <> 0 AND event_id % 10 = 0 THEN concat('_1', lpad(CAST(CAST(floor(k / 25.0) AS int) AS varchar(9)), 2, '0'), lpad(CAST(CAST(floor(k / 5.0) AS int) AS varchar(9)), 3, '0'), lpad(CAST(k AS varchar(9)), 4, '0'), lpad(CAST(user_id AS varchar(19)), 5, '0')) END AS level_7_id
FROM (SELECT event_id, ts, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e
"""
EV_SQL = f"WITH ev AS ({EV.format(events='events')})"
RULES = [
    ("obra", True, ["rehabilitación", "bacheo"], ["programa de bacheo"], [], [], [], []),
    ("seguridad", True, ["fiscalía"], [], ["incendio"], [], [], ["news", "facebook"]),
    ("cultura", None, ["festival", "orquesta"], ["calendario de conciertos"], [], [], ["en"], []),
    ("congreso", True, [], ["congreso local"], [], ["es"], [], []),
    ("apagada", False, [], [], [], [], [], []),
    ("gaceta", True, [], [], [], [], [], ["GACETA"]),
]
RULE_SCHEMA = "ontology_class string, enabled boolean, kw array<string>, phrase array<string>, not_kw array<string>, categories array<string>, dismiss_categories array<string>, document_type array<string>"
NORM = "trim(regexp_replace(strip_accents(lower({0})), '\\s+', ' ', 'g'))"
KEY = f"regexp_replace({NORM}, '[^a-z0-9]', '', 'g')"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and its SQL."""

    def wrap(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return wrap


def ev(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(EV, events=table(spark, d, "events"))


def records(spark: SparkSession, d: str) -> DataFrame:
    """Event records as the linker takes them."""
    e = ev(spark, d)
    return linking.prepare(e.select(
        F.col("event_id").alias("id"), "supertype", "event_type", F.col("ext_day").alias("start"), F.col("ext_day").alias("end"), F.col("day").alias("published"), "precision_days",
        *[f"level_{n}_id" for n in linking.LEVELS], (F.col("lat6") / 1e6).alias("lat"), (F.col("lon6") / 1e6).alias("lon"), F.col("level_2_id").alias("state")))


# --- text ---------------------------------------------------------------------------------------------------------

@query("x1_normal_names", f"SELECT row_id, {NORM.format('nombre')} AS norm, {KEY.format('nombre')} AS name_key FROM event_linking WHERE nombre IS NOT NULL")
def _(s, d):
    return table(s, d, "event_linking").where("nombre IS NOT NULL").select("row_id", text.normalize_text(F.col("nombre")).alias("norm"), text.name_key(F.col("nombre")).alias("name_key"))


@query("x5_name_similarity", f"""
    WITH p AS (SELECT e.row_id, s.strat_id, coalesce({KEY.format('e.nombre')}, '') AS a, coalesce({KEY.format('s.name')}, '') AS b FROM event_linking e JOIN strategy s ON e.grupo_id = s.entity_id),
    t AS (SELECT *, list_distinct(list_transform(range(1, greatest(len(a) - 2, 1) + 1), lambda i: substr(a, i, 3))) AS ta, list_distinct(list_transform(range(1, greatest(len(b) - 2, 1) + 1), lambda i: substr(b, i, 3))) AS tb FROM p)
    SELECT row_id, strat_id, round(CASE WHEN a = '' OR b = '' THEN 0.0 WHEN least(len(a), len(b)) < 3 THEN CAST(a = b AS double)
        ELSE len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))) END, 6) AS similarity FROM t""")
def _(s, d):
    e, c = table(s, d, "event_linking").select("row_id", "nombre", F.col("grupo_id").alias("entity_id")), table(s, d, "strategy").select("strat_id", "entity_id", "name")
    return e.join(c, "entity_id").select("row_id", "strat_id", F.round(text.name_similarity(F.col("nombre"), F.col("name")), 6).alias("similarity"))


@query("x6_slug", f"SELECT row_id, trim(regexp_replace({NORM.format('lugar')}, '[^a-z0-9]+', ' ', 'g')) AS slug FROM event_linking WHERE lugar IS NOT NULL")
def _(s, d):
    return table(s, d, "event_linking").where("lugar IS NOT NULL").select("row_id", text.slug(F.col("lugar")).alias("slug"))


@query("x7_state_alias", f"""
    WITH a AS (SELECT DISTINCT ref_id, trim(regexp_replace({NORM.format('v')}, '[^a-z0-9]+', ' ', 'g')) AS s FROM (
        SELECT ref_id, nombre AS v FROM ref_lugares WHERE clase = 'estado' UNION ALL SELECT ref_id, unnest(alias) FROM ref_lugares WHERE clase = 'estado'))
    SELECT e.row_id, min(a.ref_id) AS ref_id FROM event_linking e JOIN a ON trim(regexp_replace({NORM.format('e.estado')}, '[^a-z0-9]+', ' ', 'g')) = a.s GROUP BY e.row_id""")
def _(s, d):
    ref = table(s, d, "ref_lugares").where("clase = 'estado'").select("ref_id", F.explode(F.concat(F.array("nombre"), F.coalesce("alias", F.array()))).alias("v"))
    names = ref.select(text.slug(F.col("v")).alias("s"), "ref_id").distinct()
    return table(s, d, "event_linking").select("row_id", text.slug(F.col("estado")).alias("s")).join(names, "s").groupBy("row_id").agg(F.min("ref_id").alias("ref_id"))


@query("x12_display_name", """
    SELECT row_id, coalesce(nullif(trim(nombre), ''), nullif(trim(left(trim(lugar), 120)), ''), nullif(trim(tipo_evento), ''), CAST(row_id AS varchar)) AS name FROM event_linking""")
def _(s, d):
    return table(s, d, "event_linking").select("row_id", text.display_name(F.col("nombre"), F.col("lugar"), F.col("tipo_evento"), F.col("row_id")).alias("name"))


@query("x13_url_host", r"""
    SELECT row_id, nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '') AS host FROM event_linking""")
def _(s, d):
    return table(s, d, "event_linking").select("row_id", text.url_host(F.col("url")).alias("host"))


@query("x15_plain_ids", "SELECT strat_id, ltrim(geoid, '_') AS geoid FROM strategy WHERE geoid IS NOT NULL")
def _(s, d):
    return table(s, d, "strategy").where("geoid IS NOT NULL").select("strat_id", F.ltrim("geoid", F.lit("_")).alias("geoid"))


@query("x9_category_levels", "SELECT p_partkey, 'level_' || CAST(i AS varchar) AS level, split_part(p_type, ' ', CAST(i AS int)) AS name FROM part, range(1, 6) r(i) WHERE split_part(p_type, ' ', CAST(i AS int)) <> ''")
def _(s, d):
    return table(s, d, "part").select("p_partkey", F.explode(text.category_levels(F.regexp_replace("p_type", " ", ">"))).alias("level", "name"))


# --- dates and places -----------------------------------------------------------------------------------------------

WINDOWS = EV_SQL + """, w AS (SELECT event_id, coalesce(ext_day, day) AS lo, CASE WHEN ext_day IS NULL THEN 2 ELSE greatest(1, least(coalesce(precision_days, 0), 365)) END AS slack,
    CASE WHEN ext_day IS NULL THEN 'publication' ELSE 'extracted' END AS source FROM ev) """


@query("d3_windows", WINDOWS + "SELECT event_id, CAST(lo AS varchar) AS start_day, slack, source FROM w")
def _(s, d):
    return records(s, d).select(F.col("id").alias("event_id"), F.col("window.start").cast("string").alias("start_day"), F.col("window.slack").alias("slack"), F.col("window.source").alias("source"))


@query("d4_day_keys", WINDOWS + "SELECT event_id, CAST(unnest(range(lo - to_days(slack), lo + to_days(slack + 1), INTERVAL 1 DAY)) AS date)::varchar AS day_key FROM w")
def _(s, d):
    w = F.col("window")
    return records(s, d).select(F.col("id").alias("event_id"), F.explode(F.transform(geo.day_keys(w["start"], w["end"], w["slack"]), lambda x: x.cast("string"))).alias("day_key"))


@query("d8_human_dates", """
    SELECT o_orderkey, list_extract(['domingo','lunes','martes','miércoles','jueves','viernes','sábado'], CAST(dayofweek(o_orderdate) + 1 AS int)) || ' ' || day(o_orderdate) || ' de '
        || list_extract(['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'], CAST(month(o_orderdate) AS int)) || ' del ' || year(o_orderdate) AS fecha FROM orders""")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", text.human_date(F.col("o_orderdate")).alias("fecha"))


@query("d7_midpoints", "SELECT delivery_id, CAST(CAST(date_created AS date) + CAST(floor(date_diff('day', CAST(date_created AS date), CAST(delivered_at AS date)) / 2.0) AS int) AS varchar) AS middle FROM link")
def _(s, d):
    return table(s, d, "link").select("delivery_id", geo.midpoint(F.col("date_created").cast("date"), F.col("delivered_at").cast("date")).cast("string").alias("middle"))


@query("g1_distances", EV_SQL + """
    SELECT event_id, round(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(20.5 - lat6 / 1e6) / 2), 2) + cos(radians(lat6 / 1e6)) * cos(radians(20.5)) * pow(sin(radians(-100.4 - lon6 / 1e6) / 2), 2)))), 1) AS metres FROM ev""")
def _(s, d):
    return ev(s, d).select("event_id", F.round(geo.haversine_m(F.col("lat6") / 1e6, F.col("lon6") / 1e6, F.lit(20.5), F.lit(-100.4)), 1).alias("metres"))


@query("g3_cell_neighbours", EV_SQL + """
    SELECT event_id, CAST(floor(lat6 / 3000.0) AS bigint) + i AS r, CAST(floor(lon6 / 3000.0) AS bigint) + j AS c FROM ev, range(-1, 2) a(i), range(-1, 2) b(j)""")
def _(s, d):
    return ev(s, d).select("event_id", F.inline(geo.neighbours(geo.cell(F.col("lat6"), 3000.0), geo.cell(F.col("lon6"), 3000.0))))


@query("g6_geo_keys")
def _(s, d):
    r = records(s, d)
    lv = {n: F.col(f"level_{n}_id") for n in linking.LEVELS}
    keys = lambda probe: F.array_join(geo.geo_keys(lv, F.col("row"), F.col("col"), F.col("state"), probe), ";")
    return r.select("id", keys(False).alias("registered"), keys(True).alias("probed"))


@query("g10_bands", "SELECT p_partkey, CASE WHEN p_retailprice < 1000 THEN 1 WHEN p_retailprice < 1300 THEN 2 WHEN p_retailprice < 1600 THEN 3 ELSE 4 END AS band FROM part WHERE p_retailprice IS NOT NULL")
def _(s, d):
    return table(s, d, "part").where("p_retailprice IS NOT NULL").select("p_partkey", geo.band(F.col("p_retailprice"), [1000, 1300, 1600]).alias("band"))


@query("g11_populated", "SELECT row_id, CAST(nombre IS NOT NULL AS int) + CAST(ciudad IS NOT NULL AS int) + CAST(calle IS NOT NULL AS int) + CAST(lugar IS NOT NULL AS int) AS filled FROM event_linking")
def _(s, d):
    return table(s, d, "event_linking").select("row_id", geo.populated(*[F.col(c) for c in ("nombre", "ciudad", "calle", "lugar")]).alias("filled"))


# --- JSON and schemas ------------------------------------------------------------------------------------------------

@query("m1_payload_fields", "SELECT delivery_id, json_extract_string(payload, '$.name') AS name, json_extract_string(payload, '$.status') AS status FROM link WHERE json_valid(payload)")
def _(s, d):
    p = F.try_parse_json(text.strip_fence(F.col("payload")))
    t = table(s, d, "link").select("delivery_id", p.alias("p")).where("p IS NOT NULL")
    return t.select("delivery_id", F.try_variant_get("p", "$.name", "string").alias("name"), F.try_variant_get("p", "$.status", "string").alias("status"))


@query("m5_record_hash", """SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}') AS h FROM customer WHERE c_mktsegment IS NOT NULL""")
def _(s, d):
    return table(s, d, "customer").where("c_mktsegment IS NOT NULL").select("c_custkey", text.record_hash(F.col("c_custkey"), F.col("c_mktsegment")).alias("h"))


FIELDS = [
    types.Field("name", source="nombre", required=True), types.Field("event_type", "EnumStr", "tipo_evento", True, enum=("paid_mass_event", "public_works", "security")),
    types.Field("url", "Url"), types.Field("attendance", "int", "afluencia"), types.Field("status", source="estatus", default="desconocido"), types.Field("price", "float", "precio_inf"), types.Field("start", "datetime", "fecha_inicio"),
]


@query("proj8_flat_records")
def _(s, d):
    t = types.normalized(table(s, d, "event_linking"), FIELDS, zone_ids(s), ["row_id"])
    return t.withColumn("violations", F.array_join(F.transform("violations", lambda v: F.concat(v["field"], F.lit(":"), v["message"])), ";"))


@query("f16_violations", """
    SELECT row_id, field FROM (SELECT row_id, 'name' AS field FROM event_linking WHERE nombre IS NULL OR trim(nombre) = ''
    UNION ALL SELECT row_id, 'event_type' FROM event_linking WHERE tipo_evento IS NULL OR trim(tipo_evento) NOT IN ('paid_mass_event', 'public_works', 'security'))""")
def _(s, d):
    t = types.normalized(table(s, d, "event_linking"), FIELDS[:2], [], ["row_id"])
    return t.select("row_id", F.explode("violations.field").alias("field"))


@query("f15_bad_urls", r"SELECT row_id FROM event_linking WHERE url IS NOT NULL AND NOT regexp_matches(url, '^https?://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(:[0-9]+)?(/.*)?$')")
def _(s, d):
    return table(s, d, "event_linking").where(F.col("url").isNotNull() & ~text.is_url(F.col("url"))).select("row_id")


# --- matching ---------------------------------------------------------------------------------------------------------

def articles(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "documents")
    return t.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.array_compact(F.array("lang")).alias("categories"), F.col("doctype").alias("document_type"))


@query("f1_rule_matches")
def _(s, d):
    return matching.match(articles(s, d), s.createDataFrame(RULES, RULE_SCHEMA))


@query("f3_phrase_matches", f"SELECT doc_id AS id FROM documents WHERE contains({NORM.format('text')}, 'congreso local') AND lang = 'es'")
def _(s, d):
    return matching.match(articles(s, d), s.createDataFrame([r for r in RULES if r[0] == "congreso"], RULE_SCHEMA)).select("id")


@query("f5_type_matches", "SELECT doc_id AS id FROM documents WHERE lower(doctype) = 'gaceta'")
def _(s, d):
    return matching.match(articles(s, d), s.createDataFrame([r for r in RULES if r[0] == "gaceta"], RULE_SCHEMA)).select("id")


# --- linking ----------------------------------------------------------------------------------------------------------

INSIDE = "(" + " AND ".join(f"(a.level_{n}_id IS NULL OR coalesce(a.level_{n}_id = b.level_{n}_id, false))" for n in (1, 2, 3, 5, 6, 7)) + ")"
OUTSIDE = INSIDE.replace("a.level", "x.level").replace("b.level", "a.level").replace("x.level", "b.level")
GATE = f"a.level_1_id IS NOT NULL AND b.level_1_id IS NOT NULL AND ({INSIDE} OR {OUTSIDE})"


@query("f9_contained_pairs", EV_SQL + f"SELECT a.event_id AS a, b.event_id AS b FROM ev a JOIN ev b ON a.supertype = b.supertype AND a.level_3_id = b.level_3_id AND a.day = b.day AND a.event_id < b.event_id WHERE {GATE}")
def _(s, d):
    e = ev(s, d)
    lv = [f"level_{n}_id" for n in linking.LEVELS]
    side = lambda p: e.select("supertype", "level_3_id", "day", F.col("event_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in lv])
    j = side("a").join(side("b"), ["supertype", "level_3_id", "day"]).where("a < b")
    return j.where(geo.compatible(*[{n: F.col(f"{p}_level_{n}_id") for n in linking.LEVELS} for p in "ab"])).select("a", "b")


# The certain gate has a slack of its own, one day on the incoming side.
CERTAIN = WINDOWS + f""", x AS (SELECT e.*, w.lo, w.slack, w.source FROM ev e JOIN w USING (event_id)),
    p AS (SELECT a.event_id AS inc, b.event_id AS cand, b.day AS published FROM x a JOIN x b ON a.supertype = b.supertype AND a.event_type = b.event_type AND b.event_id < a.event_id
          AND ((a.level_7_id = b.level_7_id) OR (a.level_6_id = b.level_6_id AND a.source = 'extracted' AND b.source = 'extracted'))
          AND a.lo - INTERVAL 1 DAY <= b.lo AND b.lo <= a.lo + INTERVAL 1 DAY WHERE {GATE}) """


@query("f12_certain_pairs", CERTAIN + "SELECT inc, cand FROM p")
def _(s, d):
    return linking.certain(records(s, d)).select("inc", "cand")


@query("t7_decided", CERTAIN + "SELECT inc, first(cand ORDER BY published NULLS LAST, cand) AS match FROM p GROUP BY inc")
def _(s, d):
    return linking.certain_decided(records(s, d))


@query("t2_capped", CERTAIN + "SELECT inc, cand, rank FROM (SELECT inc, cand, row_number() OVER (PARTITION BY inc ORDER BY published DESC NULLS LAST, cand) AS rank FROM p) WHERE rank <= 12")
def _(s, d):
    return linking.certain_capped(records(s, d))


@query("f11_leaf_relation", CERTAIN + """SELECT inc, cand, 'misma' AS leaf FROM p""")
def _(s, d):
    return linking.certain(records(s, d)).select("inc", "cand", "leaf")


@query("j3_candidates")
def _(s, d):
    return linking.candidates(records(s, d))


@query("t2_referred")
def _(s, d):
    return linking.referrals(records(s, d)).select("inc", "cand", "rank")


MEMBERS = WINDOWS + """, m AS (SELECT k % 20 AS link_id, event_id AS seq, 'u' || CAST(user_id AS varchar(19)) AS source_id, supertype AS news_type, CASE WHEN event_id % 5 = 0 THEN 'n' || CAST(event_id AS varchar(19)) END AS name,
    CASE WHEN event_id % 7 = 0 THEN 'd' || CAST(event_id AS varchar(19)) ELSE '' END AS description, CASE WHEN event_id % 13 = 0 THEN event_type END AS context, CASE WHEN event_id % 3 = 0 THEN event_type END AS status, day AS published, lo, slack, source, precision_days,
    coalesce(level_7_id, level_6_id, level_3_id) AS location, CASE WHEN level_7_id IS NOT NULL THEN 7 WHEN level_6_id IS NOT NULL THEN 6 WHEN level_3_id IS NOT NULL THEN 3 ELSE 0 END AS geo_precision FROM ev JOIN w USING (event_id)) """


@query("a6_canonical", MEMBERS + """, s AS (SELECT link_id, source_id, min(seq) AS seq FROM m GROUP BY ALL), l AS (SELECT link_id, array_to_string(list(source_id ORDER BY seq), ',') AS sources FROM s GROUP BY link_id)
    SELECT link_id, first(name ORDER BY seq) FILTER (name <> '') AS name, first(description ORDER BY seq) FILTER (description <> '') AS description, first(context ORDER BY seq) FILTER (context <> '') AS context,
        first(status ORDER BY seq) FILTER (status <> '') AS status, min(published)::varchar AS published, (first(lo ORDER BY coalesce(precision_days, 0), seq) FILTER (source = 'extracted'))::varchar AS start,
        first(coalesce(precision_days, -1) ORDER BY coalesce(precision_days, 0), seq) FILTER (source = 'extracted') AS precision_days, first(coalesce(location, '') ORDER BY geo_precision DESC, seq) AS location, max(geo_precision) AS geo_precision,
        any_value(sources) AS sources, first(source ORDER BY seq) AS date_source, count(*) AS n FROM m JOIN l USING (link_id) GROUP BY link_id""")
def _(s, d):
    r = records(s, d).join(ev(s, d).select(F.col("event_id").alias("id"), "k", "user_id"), "id")
    named = lambda by, c: F.when(F.col("id") % by == 0, c)
    place = F.coalesce("level_7_id", "level_6_id", "level_3_id")
    m = r.select((F.col("k") % 20).alias("link_id"), F.col("id").alias("seq"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("source_id"), F.col("supertype").alias("news_type"),
                 named(5, F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"), F.coalesce(named(7, F.concat(F.lit("d"), F.col("id").cast("string"))), F.lit("")).alias("description"), named(13, F.col("event_type")).alias("context"),
                 named(3, F.col("event_type")).alias("status"), "published", "window", "precision_days", place.alias("location"),
                 F.when(F.col("level_7_id").isNotNull(), 7).when(F.col("level_6_id").isNotNull(), 6).when(F.col("level_3_id").isNotNull(), 3).otherwise(0).alias("geo_precision"))
    return linking.canonical(m).select(
        "link_id", "name", "description", "context", "status", F.col("publication_date").cast("string").alias("published"), F.col("date_range.start").cast("string").alias("start"), F.coalesce("date_range.precision_days", F.lit(-1)).alias("precision_days"),
        F.coalesce("place.location", F.lit("")).alias("location"), F.col("place.precision").alias("geo_precision"), F.array_join("source_ids", ",").alias("sources"), F.col("_date_source").alias("date_source"), "n")


@query("j15_prefix_tiers", """
    WITH s AS (SELECT strat_id, geoid FROM strategy WHERE geoid IS NOT NULL), p AS (SELECT DISTINCT geoid FROM s)
    SELECT s.strat_id, CASE WHEN EXISTS (SELECT 1 FROM s t WHERE t.geoid = s.geoid AND t.strat_id <> s.strat_id) THEN 3 WHEN EXISTS (SELECT 1 FROM s t WHERE left(t.geoid, 6) = left(s.geoid, 6) AND t.strat_id <> s.strat_id) THEN 2 ELSE 1 END AS tier FROM s""")
def _(s, d):
    t = table(s, d, "strategy").where("geoid IS NOT NULL").select("strat_id", "geoid", F.left("geoid", F.lit(6)).alias("state"))
    full, state = t.groupBy("geoid").agg(F.count("*").alias("n3")), t.groupBy("state").agg(F.count("*").alias("n2"))
    return t.join(full, "geoid").join(state, "state").select("strat_id", F.when(F.col("n3") > 1, 3).when(F.col("n2") > 1, 2).otherwise(1).alias("tier"))


# --- joins, aggregations, order -----------------------------------------------------------------------------------------

@query("j7_catalog", """
    WITH t AS (SELECT DISTINCT tipo_evento, coalesce(subtipo_evento, 'general') AS leaf FROM event_linking WHERE tipo_evento IS NOT NULL), p AS (SELECT row_number() OVER (ORDER BY tipo_evento) AS parent_id, tipo_evento FROM (SELECT DISTINCT tipo_evento FROM t)),
    c AS (SELECT tipo_evento || '/' || leaf AS child, tipo_evento AS parent FROM t)
    SELECT e.row_id, p.tipo_evento AS parent, c.child FROM event_linking e LEFT JOIN p ON e.tipo_evento = p.tipo_evento LEFT JOIN c ON c.parent = p.tipo_evento AND c.child = e.tipo_evento || '/' || e.subtipo_evento""")
def _(s, d):
    e = table(s, d, "event_linking").select("row_id", "tipo_evento", "subtipo_evento")
    types = e.where("tipo_evento IS NOT NULL").select(F.concat_ws("/", "tipo_evento", F.coalesce("subtipo_evento", F.lit("general"))).alias("event_type"), F.col("tipo_evento").alias("supertype"), F.lit("event").alias("category"))
    return upserts.resolved(e, upserts.catalog_seed(types), "tipo_evento", F.concat(F.col("tipo_evento"), F.lit("/"), F.col("subtipo_evento"))).select("row_id", "parent", "child")


@query("j10_linked_sources", """
    WITH l AS (SELECT sid, list_sort(list(DISTINCT entity_id)) AS ids FROM (SELECT entity_id, unnest(source_ids) AS sid FROM persistence) WHERE sid IS NOT NULL GROUP BY sid)
    SELECT k.delivery_id, coalesce(array_to_string(l.ids, ','), '') AS event_ids FROM link k LEFT JOIN l ON k._source_id = l.sid""")
def _(s, d):
    p = table(s, d, "persistence").select("entity_id", F.explode("source_ids").alias("_source_id")).where("_source_id IS NOT NULL AND entity_id IS NOT NULL").groupBy("_source_id").agg(F.array_sort(F.collect_set("entity_id")).alias("ids"))
    return table(s, d, "link").select("delivery_id", "_source_id").join(p, "_source_id", "left").select("delivery_id", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("event_ids"))


@query("j12_not_in_topics", """
    SELECT _source_id, 'topic' AS origin FROM (SELECT DISTINCT _source_id FROM link WHERE redelivered AND _source_id IS NOT NULL)
    UNION ALL SELECT _source_id, 'news' FROM (SELECT DISTINCT _source_id FROM link WHERE NOT redelivered AND _source_id IS NOT NULL) WHERE _source_id NOT IN (SELECT _source_id FROM link WHERE redelivered AND _source_id IS NOT NULL)""")
def _(s, d):
    t = table(s, d, "link").where("_source_id IS NOT NULL")
    part = lambda cond, name: t.where(cond).select("_source_id").distinct().withColumn("origin", F.lit(name))
    return reports.not_in_topics(part("NOT redelivered", "news"), part("redelivered", "topic"), "_source_id")


@query("j13_overrides", """
    WITH v AS (SELECT fuente, count(*) AS n FROM event_linking GROUP BY fuente), b AS (SELECT fuente, CASE WHEN n < 20 THEN 3 WHEN n < 60 THEN 2 ELSE 1 END AS tier FROM v), m AS (SELECT fuente, 9 AS tier FROM v WHERE fuente LIKE '%sur%')
    SELECT e.row_id, coalesce(m.tier, b.tier) AS tier FROM event_linking e LEFT JOIN b ON e.fuente = b.fuente LEFT JOIN m ON e.fuente = m.fuente""")
def _(s, d):
    e = table(s, d, "event_linking").select("row_id", "fuente")
    n = e.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"))
    base = n.select("fuente", (4 - geo.band(F.col("n"), [20, 60])).alias("tier"))
    return reports.overridden(e, "fuente", base, n.where("fuente LIKE '%sur%'").select("fuente", F.lit(9).alias("tier")), "tier").select("row_id", "tier")


@query("j17_near_vectors", """
    WITH n AS (SELECT vec_id, CAST(embedding AS double[]) AS e, sqrt(list_dot_product(CAST(embedding AS double[]), CAST(embedding AS double[]))) AS z FROM embeddings WHERE vec_id % 100 = 0),
    m AS (SELECT vec_id, CAST(embedding AS double[]) AS e, sqrt(list_dot_product(CAST(embedding AS double[]), CAST(embedding AS double[]))) AS z FROM embeddings)
    SELECT a, b FROM (SELECT n.vec_id AS a, m.vec_id AS b, row_number() OVER (PARTITION BY n.vec_id ORDER BY round(list_dot_product(n.e, m.e) / (n.z * m.z), 9) DESC, m.vec_id) AS rank FROM n JOIN m ON n.vec_id <> m.vec_id) WHERE rank <= 5""")
def _(s, d):
    t = table(s, d, "embeddings")
    return reports.nearest(t.where("vec_id % 100 = 0"), t, "vec_id", "embedding", 5).select("a", "b")


@query("j17_near_duplicates")
def _(s, d):
    return reports.near_vectors(table(s, d, "embeddings"), "vec_id", "embedding").select("a", "b", F.round("cosine", 6).alias("cosine"))


@query("a1_counts", "SELECT tipo_evento, estatus, count(*) AS n FROM event_linking GROUP BY ALL")
def _(s, d):
    return table(s, d, "event_linking").groupBy("tipo_evento", "estatus").agg(F.count(F.lit(1)).alias("n"))


@query("a3_source_order", "SELECT _source_id, min(date_created) AS first_seen, count(*) AS n FROM link WHERE _source_id IS NOT NULL GROUP BY _source_id")
def _(s, d):
    return table(s, d, "link").where("_source_id IS NOT NULL").groupBy("_source_id").agg(F.min("date_created").alias("first_seen"), F.count(F.lit(1)).alias("n"))


@query("a7_envelope", WINDOWS + "SELECT user_id, min(lo - to_days(slack))::date::varchar AS date_start, max(lo + to_days(slack))::date::varchar AS date_end FROM w JOIN ev USING (event_id) GROUP BY user_id")
def _(s, d):
    w = F.col("window")
    r = records(s, d).join(ev(s, d).select(F.col("event_id").alias("id"), "user_id"), "id")
    return r.groupBy("user_id").agg(F.min(F.date_sub(w["start"], w["slack"])).cast("string").alias("date_start"), F.max(F.date_add(w["end"], w["slack"])).cast("string").alias("date_end"))


@query("a8_multi_source", "SELECT count(*) AS n, count(*) FILTER (len(source_ids) > 1) AS multi FROM persistence WHERE source_ids IS NOT NULL")
def _(s, d):
    return table(s, d, "persistence").where("source_ids IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("source_ids") > 1).alias("multi"))


@query("a11_type_pivot", """
    SELECT fuente, count(*) FILTER (tipo_evento = 'paid_mass_event') AS paid, count(*) FILTER (tipo_evento = 'public_works') AS works, count(*) FILTER (tipo_evento = 'security') AS security,
        count(*) FILTER (tipo_evento IN ('paid_mass_event', 'public_works', 'security')) AS total FROM event_linking GROUP BY fuente ORDER BY total DESC, fuente LIMIT 20""")
def _(s, d):
    kinds = {"paid_mass_event": "paid", "public_works": "works", "security": "security"}
    t = table(s, d, "event_linking").groupBy("fuente").pivot("tipo_evento", list(kinds)).agg(F.count(F.lit(1))).na.fill(0)
    return t.withColumnsRenamed(kinds).withColumn("total", F.col("paid") + F.col("works") + F.col("security")).orderBy(F.desc("total"), F.col("fuente").asc_nulls_last()).limit(20)


@query("a12_most_common", "SELECT fuente, count(*) AS n FROM link GROUP BY fuente ORDER BY n DESC, fuente LIMIT 20")
def _(s, d):
    return table(s, d, "link").groupBy("fuente").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("fuente").asc_nulls_last()).limit(20)


@query("a13_relevance", "SELECT grupo_id, sum(3 - CASE WHEN calle IS NOT NULL THEN 1 WHEN ciudad IS NOT NULL THEN 2 ELSE 3 END) AS relevance FROM event_linking WHERE grupo_id IS NOT NULL GROUP BY grupo_id")
def _(s, d):
    level = F.when(F.col("calle").isNotNull(), 1).when(F.col("ciudad").isNotNull(), 2).otherwise(3)
    return table(s, d, "event_linking").where("grupo_id IS NOT NULL").groupBy("grupo_id").agg(F.sum(3 - level).alias("relevance"))


@query("s8_first_wins", "SELECT _id, first(rec_id ORDER BY rec_id) AS rec_id FROM run_extraction WHERE _id IS NOT NULL GROUP BY _id")
def _(s, d):
    w = Window.partitionBy("_id").orderBy("rec_id")
    return table(s, d, "run_extraction").where("_id IS NOT NULL").select("_id", "rec_id").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@query("t5_page", "SELECT doc_id, published_at FROM documents WHERE published_at IS NOT NULL ORDER BY published_at DESC, doc_id LIMIT 50 OFFSET 100")
def _(s, d):
    return table(s, d, "documents").where("published_at IS NOT NULL").select("doc_id", "published_at").orderBy(F.desc("published_at"), "doc_id").offset(100).limit(50)


@query("t8_hash_split", "SELECT CASE WHEN h % 100 < 85 THEN 'train' WHEN h % 100 < 95 THEN 'validation' ELSE 'test' END AS part, count(*) AS n FROM (SELECT ('0x' || left(md5(CAST(doc_id AS varchar)), 8))::bigint AS h FROM documents) GROUP BY 1")
def _(s, d):
    h = F.conv(F.left(F.md5(F.col("doc_id").cast("string")), F.lit(8)), 16, 10).cast("bigint") % 100
    return table(s, d, "documents").select(F.when(h < 85, "train").when(h < 95, "validation").otherwise("test").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("u1_edges", "SELECT DISTINCT a, b FROM (SELECT l_suppkey AS a, l_partkey AS b FROM lineitem UNION ALL SELECT l_partkey, l_suppkey FROM lineitem)")
def _(s, d):
    t = table(s, d, "lineitem")
    return t.select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).union(t.select("l_partkey", "l_suppkey")).distinct()


# --- writes ---------------------------------------------------------------------------------------------------------------

def halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """persistence as an older state and a newer batch."""
    t = table(s, d, "persistence").select("upsert_id", "batch_id", "entity_id", "n_sources", "run_tag")
    return t.where("upsert_id % 2 = 0"), t.where("upsert_id % 2 = 1")


OLD, NEW = "(SELECT upsert_id, batch_id, entity_id, n_sources, run_tag FROM persistence WHERE upsert_id % 2 = 0)", "(SELECT upsert_id, batch_id, entity_id, n_sources, run_tag FROM persistence WHERE upsert_id % 2 = 1)"


@query("k1_insert_new", f"SELECT * FROM {OLD} o UNION ALL SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY upsert_id) AS rn FROM {NEW} n) WHERE rn = 1 AND entity_id IS NOT NULL AND entity_id NOT IN (SELECT entity_id FROM {OLD} x WHERE entity_id IS NOT NULL)")
def _(s, d):
    return upserts.insert_new(*halves(s, d), ["entity_id"], ["upsert_id"])


@query("k1_insert_in_run", f"SELECT * FROM {OLD} o UNION ALL SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, run_tag ORDER BY upsert_id) AS rn FROM {NEW} n) n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {OLD} x WHERE x.entity_id = n.entity_id AND x.run_tag = n.run_tag)")
def _(s, d):
    return upserts.insert_new(*halves(s, d), ["entity_id", "run_tag"], ["upsert_id"])


@query("k2_upsert", f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY upsert_id DESC) AS rn FROM {NEW} n) WHERE rn = 1 OR entity_id IS NULL UNION ALL SELECT * FROM {OLD} o WHERE entity_id IS NULL OR entity_id NOT IN (SELECT entity_id FROM {NEW} x WHERE entity_id IS NOT NULL)")
def _(s, d):
    return upserts.upsert(*halves(s, d), ["entity_id"], ["upsert_id"])


@query("k9_replace_children", f"SELECT * FROM {NEW} n UNION ALL SELECT * FROM {OLD} o WHERE batch_id IS NULL OR batch_id NOT IN (SELECT batch_id FROM {NEW} x WHERE batch_id IS NOT NULL)")
def _(s, d):
    return upserts.replace_children(*halves(s, d), "batch_id")


@query("k4_union_sources", """
    SELECT entity_id, array_to_string(list_sort(list_distinct(flatten(list(source_ids)))), ',') AS sources FROM persistence WHERE entity_id IS NOT NULL AND source_ids IS NOT NULL GROUP BY entity_id""")
def _(s, d):
    t = table(s, d, "persistence").where("entity_id IS NOT NULL AND source_ids IS NOT NULL")
    one = lambda x: x.groupBy("entity_id").agg(F.array_distinct(F.flatten(F.collect_list("source_ids"))).alias("source_ids"))
    both = upserts.union_sources(one(t.where("upsert_id % 2 = 0")), one(t.where("upsert_id % 2 = 1")), "entity_id", "source_ids")
    return both.select("entity_id", F.array_join(F.array_sort("source_ids"), ",").alias("sources"))


@query("k7_ledger", """
    SELECT _source_id, _supertype, payload, batch_id AS linked, sha256('{"_supertype":"' || _supertype || '"' || CASE WHEN payload IS NULL THEN '' ELSE ',"payload":' || to_json(payload) END || '}') AS record_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY _source_id, _supertype, payload ORDER BY delivered_at DESC, delivery_id DESC) AS rn FROM link WHERE _source_id IS NOT NULL AND _supertype IS NOT NULL) WHERE rn = 1""")
def _(s, d):
    t = table(s, d, "link").where("_supertype IS NOT NULL").select("_source_id", "_supertype", "payload", F.col("batch_id").alias("linked"), "delivered_at", "delivery_id")
    return upserts.ledger(t, "_source_id", ["_supertype", "payload"], ["linked"], ["delivered_at", "delivery_id"])


@query("k8_delete_run", "SELECT upsert_id FROM persistence WHERE run_tag IS NULL OR run_tag <> 'run_058'")
def _(s, d):
    return upserts.delete_run(table(s, d, "persistence"), "run_tag", "run_058").select("upsert_id")


@query("k11_fill_from", "SELECT o.upsert_id, coalesce(o.n_sources, len(p.source_ids)) AS n_sources FROM persistence o JOIN persistence p USING (upsert_id)")
def _(s, d):
    t = table(s, d, "persistence")
    values = t.where("n_sources IS NULL").select("upsert_id", F.when(F.col("source_ids").isNotNull(), F.size("source_ids")).alias("n_sources"))
    return upserts.fill_from(t.select("upsert_id", "n_sources"), values, "upsert_id", "n_sources")
