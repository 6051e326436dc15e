"""Further queries of the event graph's operators: documents, schemas, answers, places, requests, tables, the linking fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telar.functions import answers, articles, geo, nested, text
from telar.functions.instants import zone_ids
from telar.operators import fold, gazetteer, linking, matching, reports, requests, upserts
from telar.queries.reference import EV_SQL, NORM, RULE_SCHEMA, RULES, WINDOWS, ev, records
from telar.sources import readers
from telar.streaming import pipeline
from telar.session import table

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


# --- documents ------------------------------------------------------------------------------------------------------

_S = "CASE WHEN json_type(p, '{0}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string(p, '{0}') END"
_T = lambda path: f"nullif({_S.format(path)}, '')"
_LIST = "CASE json_type(p, '{0}') WHEN 'ARRAY' THEN json_extract_string(p, '{0}[*]') WHEN 'VARCHAR' THEN [json_extract_string(p, '{0}')] ELSE [] END"


@query("proj1_articles", f"""
    WITH j AS (SELECT raw_id, payload::JSON AS p FROM run_extraction_raw WHERE json_valid(payload)), n AS (SELECT *, coalesce(json_type(p, '$.message') = 'OBJECT', false) AS nested FROM j)
    SELECT coalesce({_T('$._id')}, CASE WHEN nested THEN {_T('$.message.url')} ELSE {_T('$.url')} END, CAST(raw_id AS varchar)) AS id,
        coalesce(CASE WHEN nested THEN {_T('$.message.body')} ELSE coalesce({_T('$.text')}, {_T('$.summary')}) END, '') AS text, coalesce(CASE WHEN nested THEN {_T('$.message.title')} ELSE {_T('$.title')} END, '') AS title,
        coalesce(CASE WHEN nested THEN coalesce({_S.format('$.message.url')}, {_T('$._id')}) ELSE coalesce({_T('$.url')}, {_T('$._id')}) END, '') AS url,
        array_to_string(list_sort(CASE WHEN nested THEN list_concat({_LIST.format('$.message.source_category')}, {_LIST.format('$.message.source_tags')})
            ELSE list_concat(json_extract_string(p, '$.custom_categories.*[*]'), list_transform(list_filter(json_extract(p, '$.custom_categories.*'), lambda x: json_type(x) = 'VARCHAR'), lambda x: x->>'$')) END), '|') AS categories,
        lower(CASE WHEN nested THEN coalesce({_T('$.type')}, {_T('$.message.type')}, '') ELSE coalesce({_T('$.doctype')}, {_T('$.type')}, 'news') END) AS document_type,
        CASE WHEN nested THEN coalesce({_T('$.message.timestamp')}, {_T('$.message.created_time')}) ELSE coalesce({_T('$.article_date')}, {_T('$.date_created')}, {_T('$.date')}, {_T('$.published_at')}) END AS publication_date,
        CASE WHEN nested THEN {_T('$.message.news_type')} ELSE {_T('$.news_type')} END AS news_type FROM n""")
def _(s, d):
    a = articles.articles(table(s, d, "run_extraction_raw"), "payload", "raw_id")
    return a.withColumn("categories", F.array_join(F.array_sort("categories"), "|")).drop("source_type")


@query("proj2_publication_dates", "SELECT row_id, coalesce(nullif(article_date, ''), CAST(extraido_at AS varchar)) AS published FROM event_linking")
def _(s, d):
    t = table(s, d, "event_linking").select("row_id", "article_date", F.date_format("extraido_at", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))
    return t.select("row_id", articles.publication_date(t).alias("published"))


@query("proj3_reference_dates", "SELECT doc_id, strftime(published_at, '%d/%m/%Y') AS reference FROM documents WHERE published_at IS NOT NULL")
def _(s, d):
    return table(s, d, "documents").where("published_at IS NOT NULL").select("doc_id", articles.reference_date(F.col("published_at")).alias("reference"))


@query("proj10_provenance", "SELECT delivery_id, coalesce(news_type, _supertype, 'nota') AS news_type, coalesce(_source_id, fuente) AS source FROM link")
def _(s, d):
    t = table(s, d, "link").select("delivery_id", "news_type", F.col("_source_id").alias("source"), "_supertype", "fuente")
    return articles.with_provenance(t, news_type=F.coalesce("_supertype", F.lit("nota")), source=F.col("fuente")).select("delivery_id", "news_type", "source")


@query("proj11_identification", """
    SELECT row_id, CASE WHEN lugar IS NULL OR trim(lugar) = '' THEN nombre WHEN nombre IS NULL OR contains(lower(lugar), lower(nombre)) THEN lugar ELSE lugar || ' (nombre: ' || nombre || ')' END AS said FROM event_linking""")
def _(s, d):
    return table(s, d, "event_linking").select("row_id", text.identification_text(F.col("nombre"), F.col("lugar")).alias("said"))


@query("proj20_flattened", "SELECT strat_id, array_to_string(source_ids, '|') AS sources, len(source_ids) AS n FROM strategy WHERE source_ids IS NOT NULL")
def _(s, d):
    t = table(s, d, "strategy").where("source_ids IS NOT NULL").select("strat_id", F.struct(F.array_join("source_ids", "|").alias("sources"), F.size("source_ids").alias("n")).alias("x"))
    return readers.flattened(t, "x")


@query("proj22_stamped", """SELECT strat_id, '{"_link_id":' || entity_id || ',"_link_run":"r1"}' AS metadata FROM strategy""")
def _(s, d):
    t = table(s, d, "strategy").select("strat_id", F.to_json(F.struct(F.col("entity_id").alias("_link_id"), F.lit("r1").alias("_link_run"))).alias("metadata"))
    return t


@query("proj24_source_dates", """
    SELECT id, min(d) AS date FROM (SELECT CAST(entity_id AS varchar) AS id, written_at AS d FROM persistence UNION ALL SELECT unnest(source_ids), written_at FROM persistence) WHERE id IS NOT NULL AND d IS NOT NULL GROUP BY id""")
def _(s, d):
    t = table(s, d, "persistence").select(F.col("entity_id").cast("string").alias("k"), "written_at", F.transform("source_ids", lambda x: F.struct(x.alias("comment_id"))).alias("comments"))
    return articles.source_dates(t, "k", "written_at", "comments", "comment_id")


@query("f7_typed", "SELECT row_id FROM event_linking WHERE coalesce(trim(tipo_evento) <> '', false) OR coalesce(trim(subtipo_evento) <> '', false)")
def _(s, d):
    return table(s, d, "event_linking").where(articles.has_type(F.col("tipo_evento"), F.col("subtipo_evento"))).select("row_id")


_CAT = "CASE WHEN tipo_evento IN ('security', 'health_campaign') THEN 'theme' WHEN tipo_evento = 'legislative_initiative' THEN 'entity' WHEN tipo_evento = 'accident' THEN NULL WHEN tipo_evento IS NOT NULL THEN 'event' END"
_REASON = f"""SELECT row_id, CASE WHEN tipo_evento IS NULL OR trim(tipo_evento) = '' THEN 'no_supertype' WHEN cat IS NULL THEN 'no_schema' WHEN cat <> 'event' THEN 'skipped_category:' || cat
    WHEN subtipo_evento IS NULL OR trim(subtipo_evento) = '' THEN 'no_type' WHEN row_id % 3 = 0 THEN 'no_date' END AS reason FROM (SELECT *, {_CAT} AS cat FROM event_linking)"""


def _reasons(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "event_linking").withColumn("cat", F.expr(_CAT))
    w = geo.window(F.when(F.col("row_id") % 3 != 0, F.to_date("extraido_at")), F.lit(None).cast("date"), F.lit(None).cast("date"), F.lit(None).cast("int"))
    return t.select("row_id", linking.drop_reason(F.col("tipo_evento"), F.col("cat"), F.col("subtipo_evento"), w).alias("reason"))


@query("f8_drop_reasons", _REASON)
def _(s, d):
    return _reasons(s, d)


@query("a2_drop_counts", f"SELECT coalesce(reason, 'linked') AS reason, count(*) AS n FROM ({_REASON}) GROUP BY 1")
def _(s, d):
    return _reasons(s, d).groupBy(F.coalesce("reason", F.lit("linked")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# --- schemas ----------------------------------------------------------------------------------------------------------

RECORD: nested.Schema = nested.COMPOSITES | {
    "Message": {"title": {"type": "str"}, "url": {"type": "Url"}, "created_time": {"type": "int"}},
    "Record": {
        "_id": {"type": "str", "required": True}, "doctype": {"type": "EnumStr", "enum": ["news", "facebook"], "default_fn": "kind"}, "fb_likes": {"type": "int", "default": 0}, "message": {"type": "Message"},
        "news_type": {"type": "str", "required_fn": "is_news"}, "tags": {"type": "List[str]"},
    },
}
FUNCTIONS = {"kind": lambda at: F.when(at("message")["title"].isNotNull(), "facebook").otherwise("news"), "is_news": lambda at: at("doctype") == "news"}


def _records(s: SparkSession, d: str) -> DataFrame:
    return nested.normalized(table(s, d, "run_extraction_raw"), "payload", RECORD, "Record", zone_ids(s), ["raw_id"], FUNCTIONS)


_OWN = lambda f: f"nullif(trim({_S.format(f'$.message.{f}')}), '')"
_HOIST = f"""WITH j AS (SELECT raw_id, CASE WHEN json_valid(payload) THEN payload::JSON END AS p FROM run_extraction_raw), o AS (SELECT raw_id, p, coalesce(json_type(p, '$.message') = 'OBJECT', false) AS nested FROM j),
    r AS (SELECT raw_id, nullif(trim({_S.format('$._id')}), '') AS id, nullif(trim({_S.format('$.doctype')}), '') AS doctype, nullif(trim({_S.format('$.news_type')}), '') AS news_type,
        nullif(trim(coalesce(CASE WHEN nested AND json_type(p, '$.message.title') IS NOT NULL THEN {_S.format('$.message.title')} ELSE {_S.format('$.title')} END)), '') AS title,
        nullif(trim(coalesce(CASE WHEN nested AND json_type(p, '$.message.url') IS NOT NULL THEN {_S.format('$.message.url')} ELSE {_S.format('$.url')} END)), '') AS url,
        CASE WHEN json_type(p, '$.fb_likes') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(p, '$.fb_likes') AS bigint) WHEN regexp_full_match({_S.format('$.fb_likes')}, '[0-9]+') THEN CAST({_S.format('$.fb_likes')} AS bigint) ELSE 0 END AS fb_likes FROM o) """


@query("proj8_normalized_records", _HOIST + "SELECT raw_id, id, coalesce(doctype, CASE WHEN title IS NOT NULL THEN 'facebook' ELSE 'news' END) AS doctype, fb_likes, title, url, news_type FROM r")
def _(s, d):
    r = F.col("record")
    return _records(s, d).select("raw_id", r["_id"].alias("id"), r["doctype"].alias("doctype"), r["fb_likes"].alias("fb_likes"), r["message"]["title"].alias("title"), r["message"]["url"].alias("url"), r["news_type"].alias("news_type"))


@query("proj7_violations", _HOIST + """SELECT raw_id, '_id' AS field, 'required' AS message FROM r WHERE id IS NULL
    UNION ALL SELECT raw_id, 'doctype', 'not allowed' FROM r WHERE doctype IS NOT NULL AND doctype NOT IN ('news', 'facebook')
    UNION ALL SELECT raw_id, 'news_type', 'required' FROM r WHERE news_type IS NULL AND coalesce(doctype, CASE WHEN title IS NOT NULL THEN 'facebook' ELSE 'news' END) = 'news'
    UNION ALL SELECT raw_id, 'message.url', 'no address' FROM r WHERE url IS NOT NULL AND NOT regexp_matches(url, '^https?://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\\.)+[A-Za-z]{2,}(:[0-9]+)?(/.*)?$')""")
def _(s, d):
    return _records(s, d).select("raw_id", F.inline("violations"))


# --- answers ----------------------------------------------------------------------------------------------------------

@query("m1_entities", """SELECT delivery_id, 1 AS n, json_extract_string(payload, '$.name') AS name FROM link WHERE json_valid(payload)""")
def _(s, d):
    # Payloads in the wrappers that models put around an answer: fence, single key, list with scalars, several keys.
    p, k = F.col("payload"), F.col("delivery_id") % 5
    wrapped = F.when(k == 1, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(k == 2, F.concat(F.lit('{"results": {"events": ['), p, F.lit(", null, 3,]}}"))).when(k == 3, F.concat(F.lit("["), p, F.lit(', "x"]'))).when(k == 4, F.concat(F.lit('{"summary": "s", "events": ['), p, F.lit("]}"))).otherwise(p)
    t = table(s, d, "link").select("delivery_id", answers.entity_list(wrapped).alias("e")).where("e IS NOT NULL")
    return t.select("delivery_id", F.size("e").alias("n"), F.try_variant_get(F.element_at("e", 1), "$.name", "string").alias("name"))


@query("m2_match_ids", "SELECT upsert_id, CASE WHEN upsert_id % 3 <> 0 THEN source_ids[1] END AS match_id FROM persistence WHERE len(source_ids) > 0 AND source_ids[1] IS NOT NULL AND NOT contains(source_ids[1], '\"') AND NOT contains(source_ids[1], '\\')")
def _(s, d):
    t = table(s, d, "persistence").where(F.size("source_ids") > 0).withColumn("x", F.col("source_ids")[0]).where(F.col("x").isNotNull() & ~F.contains("x", F.lit('"')) & ~F.contains("x", F.lit("\\")))
    answer = F.concat(F.lit('```json\n{"match_id": "'), F.when(F.col("upsert_id") % 3 == 0, F.lit("not asked")).otherwise(F.col("x")), F.lit('"}\n```'))
    return t.select("upsert_id", answers.matched_id(answer, F.col("source_ids")).alias("match_id"))


@query("f19_confirmed_classes", "SELECT row_id, tipo_evento AS classes FROM event_linking WHERE tipo_evento IS NOT NULL")
def _(s, d):
    t = table(s, d, "event_linking").where("tipo_evento IS NOT NULL")
    answer = F.concat(F.lit('{"classes": ["unknown", "'), "tipo_evento", F.lit('",]}'))
    return t.select("row_id", F.array_join(answers.confirmed_classes(answer, F.array("tipo_evento", F.lit("other"))), ",").alias("classes"))


@query("a5_by_supertype", """SELECT grupo_id AS id, tipo_evento AS supertype, array_to_string(list_sort(list(DISTINCT subtipo_evento)), ',') AS classes, count(DISTINCT subtipo_evento) = 1 AS focused
    FROM event_linking WHERE grupo_id IS NOT NULL AND tipo_evento IS NOT NULL AND subtipo_evento IS NOT NULL GROUP BY ALL""")
def _(s, d):
    t = table(s, d, "event_linking").where("grupo_id IS NOT NULL AND tipo_evento IS NOT NULL AND subtipo_evento IS NOT NULL").select(F.col("grupo_id").alias("id"), F.concat_ws("/", "tipo_evento", "subtipo_evento").alias("event_type"), "tipo_evento")
    g = answers.by_supertype(t.select("id", "event_type"), t.select("event_type", F.col("tipo_evento").alias("supertype")).distinct())
    return g.select("id", "supertype", F.array_join(F.transform("classes", lambda x: F.substring_index(x, "/", -1)), ",").alias("classes"), "focused")


@query("j2_supertypes", "SELECT row_id, tipo_evento AS supertype FROM event_linking WHERE tipo_evento IN (SELECT tipo_evento FROM event_linking GROUP BY 1 HAVING count(*) > 5)")
def _(s, d):
    t = table(s, d, "event_linking").select("row_id", F.col("tipo_evento").alias("event_type"))
    types = t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).where("n > 5").select("event_type", F.col("event_type").alias("supertype"))
    return t.join(types, "event_type").select("row_id", "supertype")


@query("e6_replayed", """SELECT delivery_id, CASE WHEN batch_id % 2 = 0 THEN 'seen' END AS response FROM link WHERE _source_id IS NOT NULL AND _supertype IS NOT NULL""")
def _(s, d):
    t = table(s, d, "link").where("_source_id IS NOT NULL AND _supertype IS NOT NULL").select("delivery_id", "batch_id", "_source_id", "_supertype")
    fields = ["_source_id", "_supertype", "delivery_id"]
    held = t.where("batch_id % 2 = 0").select(text.named_hash({f: F.col(f) for f in fields}).alias("key"), F.lit("seen").alias("response"))
    return answers.replayed(t, held, fields).select("delivery_id", "response")


@query("x19_prompt_turns", "SELECT row_id, 'Clasifica ' || coalesce(tipo_evento, '') || '.' AS system, 'Texto: ' || coalesce(nombre, '') AS asked FROM event_linking WHERE nombre IS NOT NULL AND trim(nombre) = nombre AND NOT contains(nombre, 'USER:')")
def _(s, d):
    t = table(s, d, "event_linking").where("nombre IS NOT NULL AND trim(nombre) = nombre AND NOT contains(nombre, 'USER:')")
    x = answers.turns(answers.rendered(F.lit("SYSTEM: Clasifica {kind}.\nUSER: Texto: {name}"), {"kind": F.col("tipo_evento"), "name": F.col("nombre")}))
    return t.select("row_id", x[0]["content"].alias("system"), x[1]["content"].alias("asked"))


# --- places -------------------------------------------------------------------------------------------------------------

def _location() -> F.Column:
    names = {"country": "pais", "state": "estado", "city": "ciudad", "neighborhood": "colonia", "zone": "zona", "street": "calle", "number": "numero", "place_name": "lugar"}
    return gazetteer.trimmed(F.struct(*[F.col(c).alias(k) for k, c in names.items()]))


_F = lambda c: f"nullif(trim({c}), '')"


@query("proj13_mentions", f"""
    WITH t AS (SELECT row_id, {_F('pais')} AS a, {_F('estado')} AS b, {_F('ciudad')} AS c, {_F('colonia')} AS e, nullif(concat_ws(' ', {_F('calle')}, {_F('numero')}), '') AS f, {_F('lugar')} AS g FROM event_linking),
    u AS (SELECT row_id, list_filter([{{'l': 'PAIS', 't': a}}, {{'l': 'EST', 't': b}}, {{'l': 'MUN', 't': c}}, {{'l': 'COL', 't': e}}, {{'l': 'CALLE', 't': f}}, {{'l': 'LUG', 't': g}}], lambda x: x.t IS NOT NULL) AS m FROM t)
    SELECT row_id, m[i].l AS level, m[i].t AS text, CAST(i - 1 AS int) AS pos FROM u, range(1, 7) r(i) WHERE i <= len(m)""")
def _(s, d):
    return table(s, d, "event_linking").select("row_id", F.inline(gazetteer.mentions(_location())))


@query("proj14_trimmed", f"SELECT row_id, {_F('pais')} AS country, {_F('calle')} AS street, {_F('lugar')} AS place_name FROM event_linking")
def _(s, d):
    x = _location()
    return table(s, d, "event_linking").select("row_id", x["country"].alias("country"), x["street"].alias("street"), x["place_name"].alias("place_name"))


_SLUG = lambda c: f"coalesce(trim(regexp_replace({NORM.format(_F(c))}, '[^a-z0-9]+', ' ', 'g')), '')"
_KEY = " || '|' || ".join(_SLUG(c) for c in ("pais", "estado", "ciudad", "colonia", "calle", "numero", "lugar"))


@query("j16_geocoded", f"""
    WITH t AS (SELECT row_id, {_KEY} AS k FROM event_linking), g AS (SELECT k, min(row_id) AS geoid FROM t WHERE row_id % 2 = 0 GROUP BY k) SELECT t.row_id, g.geoid FROM t LEFT JOIN g USING (k)""")
def _(s, d):
    t = table(s, d, "event_linking").select("row_id", _location().alias("location"))
    g = t.where("row_id % 2 = 0").select(gazetteer.location_key(F.col("location")).alias("_key"), "row_id").groupBy("_key").agg(F.min("row_id").alias("geoid"))
    return gazetteer.geocoded(t, "location", g).select("row_id", "geoid")


@query("a14_best_match", """SELECT entity_id, coalesce(geoid, '') AS geoid, coalesce(precision_days, 0) AS precision_level FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY coalesce(precision_days, 0) DESC, strat_id) AS rn FROM strategy) WHERE rn = 1""")
def _(s, d):
    t = table(s, d, "strategy").select("entity_id", "strat_id", "geoid", F.col("precision_days").cast("string").alias("precision_level"), F.col("name").alias("formatted_name"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), *[F.lit(None).cast("string").alias(f"level_{n}{x}") for n in gazetteer.LEVELS for x in ("", "_id")])
    best = gazetteer.best_match(t, "entity_id", "strat_id")
    g = best.select("entity_id", gazetteer.response(F.struct(*[c for c in best.columns if c != "entity_id"])).alias("g"))
    return g.select("entity_id", "g.geoid", "g.precision_level")


@query("g4_boxes", EV_SQL + "SELECT event_id, round((floor(lat6 / 3000.0) - 1) * 0.003, 6) AS lat_min, round((floor(lat6 / 3000.0) + 2) * 0.003, 6) AS lat_max, round((floor(lon6 / 3000.0) - 1) * 0.003, 6) AS lon_min, round((floor(lon6 / 3000.0) + 2) * 0.003, 6) AS lon_max FROM ev")
def _(s, d):
    e = ev(s, d).select("event_id", geo.box(geo.cell(F.col("lat6"), 3000.0), geo.cell(F.col("lon6"), 3000.0)).alias("b"))
    return e.select("event_id", *[F.round(F.col(f"b.{c}"), 6).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")])


@query("g5_near_degrees", EV_SQL + "SELECT event_id FROM ev WHERE sqrt(pow(lat6 / 1e6 - 20.5, 2) + pow(lon6 / 1e6 + 100.4, 2)) < 0.0035")
def _(s, d):
    return ev(s, d).where(geo.near_degrees(F.col("lat6") / 1e6, F.col("lon6") / 1e6, F.lit(20.5), F.lit(-100.4))).select("event_id")


_STATE = "(SELECT DISTINCT trim(regexp_replace({0}, '[^a-z0-9]+', ' ', 'g')) AS s, min(nombre) OVER (PARTITION BY trim(regexp_replace({0}, '[^a-z0-9]+', ' ', 'g'))) AS nombre FROM (SELECT nombre, unnest(list_concat([nombre], coalesce(alias, []))) AS v FROM ref_lugares WHERE clase = 'estado'))".replace("{0}", NORM.format("v"))


@query("g8_partition_keys", f"""
    WITH c AS {_STATE}, t AS (SELECT row_id, CASE WHEN row_id % 3 = 0 THEN ciudad END AS level_2, estado FROM event_linking), u AS (SELECT *, trim(regexp_replace({NORM.format('level_2')}, '[^a-z0-9]+', ' ', 'g')) AS ls, trim(regexp_replace({NORM.format('estado')}, '[^a-z0-9]+', ' ', 'g')) AS es FROM t)
    SELECT row_id, CASE WHEN trim(level_2) <> '' THEN coalesce(a.nombre, ls) WHEN b.nombre IS NOT NULL THEN b.nombre ELSE '' END AS geo_key, CASE WHEN trim(level_2) <> '' THEN 'geocoder' WHEN b.nombre IS NOT NULL THEN 'state_catalogue' ELSE 'none' END AS source
    FROM u LEFT JOIN c a ON a.s = ls LEFT JOIN c b ON b.s = es""")
def _(s, d):
    ref = table(s, d, "ref_lugares").where("clase = 'estado'").select("nombre", F.explode(F.concat(F.array("nombre"), F.coalesce("alias", F.array()))).alias("v"))
    names = ref.select(text.slug(F.col("v")).alias("s"), "nombre").groupBy("s").agg(F.min("nombre").alias("nombre"))
    t = table(s, d, "event_linking").select("row_id", F.when(F.col("row_id") % 3 == 0, F.col("ciudad")).alias("level_2"), "estado")
    t = t.withColumns({"ls": text.slug(F.col("level_2")), "es": text.slug(F.col("estado"))}).join(names.select(F.col("s").alias("ls"), F.col("nombre").alias("a")), "ls", "left").join(names.select(F.col("s").alias("es"), F.col("nombre").alias("b")), "es", "left")
    key, source = geo.partition_key(F.col("level_2"), F.col("estado"), F.col("a"), F.col("b"), F.col("ls"))
    return t.select("row_id", key.alias("geo_key"), source.alias("source"))


@query("g9_parsed_boxes", EV_SQL + "SELECT event_id, round(lon6 / 1e6, 6) AS a, round(lat6 / 1e6, 6) AS b FROM ev")
def _(s, d):
    e = ev(s, d)
    written = F.concat(F.lit("[["), (F.col("lon6") / 1e6).cast("string"), F.lit(", "), (F.col("lat6") / 1e6).cast("string"), F.lit("], [1, 2.5]]"))
    x = geo.parsed_box(written)
    return e.select("event_id", F.round(x[0], 6).alias("a"), F.round(x[1], 6).alias("b"))


# --- requests -------------------------------------------------------------------------------------------------------------

RULE_ROWS = [
    {"kw": '"bacheo","obra"', "not": '"concierto"', "document_type": "News, facebook", "period": ""}, {"phrase": '"congreso local"', "document_type": "facebook"}, {"kw": '"festival"', "categories": "A>B>C|A>D", "bbox": "-100, 20, -99, 21", "document_type": "gaceta"},
]
_WORDS = f"' ' || regexp_replace({NORM.format('coalesce(text, chr(32))')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
_HAS = lambda w: f"contains({_WORDS}, ' {w} ')"
_R1 = f"(({_HAS('bacheo')} OR {_HAS('obra')}) AND NOT {_HAS('concierto')} AND lower(doctype) = 'news')"
_R2 = f"(contains({NORM.format('coalesce(text, chr(32))')}, 'congreso local') AND lower(doctype) = 'facebook')"
_R3 = f"({_HAS('festival')} AND lower(doctype) = 'gaceta')"


def _requests() -> list[dict]:
    return [requests.compiled(r, default_period="any") for r in RULE_ROWS]


@query("s7_request", f"SELECT doc_id FROM documents WHERE {_R1}")
def _(s, d):
    t = table(s, d, "documents")
    return t.where(requests.predicate(_requests()[0], t.columns)).select("doc_id")


@query("s8_first_request", f"SELECT doc_id, CASE WHEN {_R1} THEN 0 WHEN {_R2} THEN 1 ELSE 2 END AS request FROM documents WHERE coalesce({_R1}, false) OR coalesce({_R2}, false) OR coalesce({_R3}, false)")
def _(s, d):
    return requests.fetched_by_rules(table(s, d, "documents"), _requests(), "doc_id").select("doc_id", "request")


@query("s5_fetched_page", f"SELECT doc_id, title FROM documents WHERE {_R1} ORDER BY published_at NULLS LAST, doc_id LIMIT 20 OFFSET 20")
def _(s, d):
    return requests.fetched(table(s, d, "documents"), _requests()[0] | {"sort": "published_at", "page_size": 20, "page_number": 1}, ["doc_id", "title"], "doc_id")


@query("f20_boolean_tree", f"SELECT doc_id FROM documents WHERE ({_HAS('agua')} OR ({_HAS('feria')} AND NOT ({_HAS('libro')} OR {_HAS('empleo')}))) AND contains({NORM.format('coalesce(text, chr(32))')}, 'de la') AND published_at >= TIMESTAMP '2022-01-01' AND published_at <= TIMESTAMP '2024-01-01'")
def _(s, d):
    t = table(s, d, "documents")
    r = {"keywords": {"OR": ["agua", {"AND": ["feria", {"NOT": {"OR": ["libro", "empleo"]}}]}]}, "phrases": ["de la"], "period": ["2022-01-01", "2024-01-01"]}
    return t.where(requests.predicate(r, t.columns)).select("doc_id")


_LOC = "(ltrim(coalesce(geoid, ''), '_') LIKE '48422%' AND coalesce(precision_days, 0) >= 3)"


@query("f13_producer_filter", f"SELECT strat_id FROM strategy WHERE {_LOC} AND lower(event_type) <> 'deportes'")
def _(s, d):
    t = table(s, d, "strategy")
    loc = F.array(F.struct(F.left("geoid", F.lit(6)).alias("level_2_id"), F.col("precision_days").cast("string").alias("precision_level")), F.struct(F.lit("_99").alias("level_2_id"), F.lit("9").alias("precision_level")))
    return t.where(requests.wanted(loc, F.array("event_type"), ["48422"])).select("strat_id")


@query("f14_state_filter", "SELECT strat_id FROM strategy WHERE geoid LIKE '_48415%'")
def _(s, d):
    loc = F.array(F.struct(F.left("geoid", F.lit(6)).alias("level_2_id"), F.lit("0").alias("precision_level")))
    return table(s, d, "strategy").where(requests.mentions_place(loc, ["_48415"])).select("strat_id")


@query("j11_rules_of", "SELECT DISTINCT subtipo_evento AS ontology_class FROM event_linking WHERE tipo_evento = 'paid_mass_event' AND subtipo_evento IS NOT NULL")
def _(s, d):
    t = table(s, d, "event_linking").where("subtipo_evento IS NOT NULL")
    rules = t.select(F.col("subtipo_evento").alias("ontology_class")).distinct()
    return requests.rules_of(rules, t.select(F.col("subtipo_evento").alias("event_type"), F.col("tipo_evento").alias("supertype")).distinct(), "paid_mass_event")


@query("j14_products", "SELECT r_name AS word, n_name AS place, b AS bound FROM region, nation, (VALUES ('y'), ('o')) t(b)")
def _(s, d):
    return requests.products(table(s, d, "region").select(F.col("r_name").alias("word")), s.createDataFrame([("y",), ("o",)], "bound string"), table(s, d, "nation").select(F.col("n_name").alias("place")))


@query("d9_period", "SELECT doc_id, strftime(published_at - INTERVAL 14 DAY, '%Y-%m-%d %H:%M:%S') AS start FROM documents WHERE published_at IS NOT NULL")
def _(s, d):
    lo, _ = articles.normal_default_window(F.col("published_at"))
    return table(s, d, "documents").where("published_at IS NOT NULL").select("doc_id", F.date_format(lo, "yyyy-MM-dd HH:mm:ss").alias("start"))


# --- sources and tables -----------------------------------------------------------------------------------------------------

@query("s9_dated", "SELECT e.row_id, coalesce(CASE WHEN e.row_id % 2 = 0 THEN e.extraido_at END, x.d) AS seen FROM event_linking e LEFT JOIN (SELECT url, min(extraido_at) AS d FROM event_linking WHERE url IS NOT NULL GROUP BY url) x ON e.url = x.url")
def _(s, d):
    t = table(s, d, "event_linking").select("row_id", "url", F.when(F.col("row_id") % 2 == 0, F.col("extraido_at")).alias("seen"))
    return readers.dated(t, "url", table(s, d, "event_linking").select("url", "extraido_at"), "extraido_at", "seen").select("row_id", "seen")


@query("s10_recovered", "SELECT delivery_id, payload AS record FROM link WHERE json_valid(payload)")
def _(s, d):
    # Each payload in a damaged array: an object cut off before it, a stray brace and text after it.
    t = table(s, d, "link").where("payload IS NOT NULL").select("delivery_id", F.concat(F.lit('[{"a": {"b": 1, '), "payload", F.lit(" } , garbage ] ")).alias("t"), "payload")
    t = t.withColumn("t", F.concat(F.lit('[{"broken": "x\\"{", '), "payload", F.lit(", garbage ]")))
    return readers.recovered(t.where(F.try_parse_json("payload").isNotNull()), "t").select("delivery_id", "record")


@query("s14_looked_up", "SELECT s.strat_id, p.n FROM strategy s LEFT JOIN (SELECT entity_id, min('{\"_link_id\":' || entity_id || ',\"n\":' || upsert_id || '}') AS n FROM persistence WHERE entity_id IS NOT NULL GROUP BY entity_id) p USING (entity_id)")
def _(s, d):
    held = table(s, d, "persistence").where("entity_id IS NOT NULL").select(F.to_json(F.struct(F.col("entity_id").alias("_link_id"), F.col("upsert_id").alias("n"))).alias("n"))
    return readers.looked_up(table(s, d, "strategy").select("strat_id", F.col("entity_id").cast("string").alias("k")), "k", held, "$._link_id", "n").select("strat_id", "n")


@query("s16_snapshot", """
    WITH t AS (SELECT entity_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM strategy WHERE event_type IS NOT NULL GROUP BY 1), l AS (SELECT entity_id, array_to_string(list_sort(list(DISTINCT geoid)), ',') AS places FROM strategy WHERE geoid IS NOT NULL GROUP BY 1),
    a AS (SELECT entity_id, array_to_string(list_sort(list(DISTINCT name)), ',') AS aliases FROM strategy WHERE name IS NOT NULL GROUP BY 1), r AS (SELECT entity_id, count(DISTINCT o) AS related FROM (SELECT entity_id, batch_id AS o FROM persistence UNION ALL SELECT batch_id, entity_id FROM persistence) GROUP BY 1)
    SELECT entity_id, coalesce(types, '') AS types, coalesce(places, '') AS places, coalesce(aliases, '') AS aliases, coalesce(related, 0) AS related FROM (SELECT DISTINCT entity_id FROM strategy) LEFT JOIN t USING (entity_id) LEFT JOIN l USING (entity_id) LEFT JOIN a USING (entity_id) LEFT JOIN r USING (entity_id)""")
def _(s, d):
    t = table(s, d, "strategy")
    edges = table(s, d, "persistence").select(F.col("entity_id").alias("ent_id_source"), F.col("batch_id").alias("ent_id_dest"))
    x = readers.snapshot(t.select("entity_id").distinct(), t.where("event_type IS NOT NULL").select("entity_id", "event_type"), t.where("geoid IS NOT NULL").select("entity_id", "geoid"), t.where("name IS NOT NULL").select("entity_id", F.col("name").alias("entity_alias")), edges)
    return x.select("entity_id", F.array_join("types.event_type", ",").alias("types"), F.array_join("locations.geoid", ",").alias("places"), F.array_join("aliases", ",").alias("aliases"), F.size("related_entity_ids").alias("related"))


@query("s17_events", "SELECT entity_id, strat_id, name FROM strategy WHERE entity_id IS NOT NULL")
def _(s, d):
    t = table(s, d, "strategy").where("entity_id IS NOT NULL").groupBy("entity_id").agg(F.collect_list(F.struct("entity_id", "strat_id", "name")).alias("events"))
    return readers.events_of(t)


@query("k3_tables", """
    WITH c AS (SELECT strat_id, nullif(trim(name), '') AS name, nullif(trim(event_type), '') AS event_type, supertype, geoid FROM strategy)
    SELECT 'entities' AS tbl, strat_id AS id, coalesce(name, event_type, CAST(strat_id AS varchar)) AS v FROM c UNION ALL SELECT 'entities_alias', strat_id, coalesce(name, event_type, CAST(strat_id AS varchar)) FROM c
    UNION ALL SELECT DISTINCT 'entity_types', strat_id, x FROM (SELECT strat_id, unnest([supertype, event_type]) AS x FROM c) WHERE x IS NOT NULL
    UNION ALL SELECT 'entity_locations', strat_id, geoid FROM c WHERE geoid IS NOT NULL UNION ALL SELECT 'event_properties', strat_id, 'ok' FROM c""")
def _(s, d):
    t = table(s, d, "strategy").select(F.col("strat_id").alias("link_id"), F.nullif(F.trim("event_type"), F.lit("")).alias("entity_type"), "supertype", "name", F.lit(None).cast("string").alias("description"), F.lit("ok").alias("status"), F.to_date("written_at").alias("date_start"), F.to_date("written_at").alias("date_end"), F.col("name").alias("formatted_name"), "geoid", F.array(F.struct(F.lit("s").alias("source_id"))).alias("_sources"))
    x = upserts.tables(t, "run")
    one = lambda n, k, v: x[n].select(F.lit(n).alias("tbl"), F.col(k).alias("id"), F.col(v).alias("v"))
    return one("entities", "entity_id", "name").union(one("entities_alias", "original_entity_id", "entity_alias")).union(one("entity_types", "entity_id", "entity_type")).union(one("entity_locations", "entity_id", "geoid")).union(one("event_properties", "event_id", "status"))


@query("k4_accumulators", """
    WITH p AS (SELECT DISTINCT entity_id, upsert_id % 2 AS half, unnest(source_ids) AS sid FROM persistence WHERE entity_id IS NOT NULL), q AS (SELECT entity_id, half, sid FROM p WHERE sid IS NOT NULL),
    w AS (SELECT entity_id, count(*) AS windows FROM persistence WHERE entity_id IS NOT NULL GROUP BY 1)
    SELECT w.entity_id, count(DISTINCT sid) AS sources, count(DISTINCT sid) AS ledger, coalesce(array_to_string(list_sort(list(DISTINCT sid) FILTER (sid IN (SELECT sid FROM q o WHERE o.half = 0 AND o.entity_id = w.entity_id))), ','), '') AS of_old, any_value(windows) AS windows
    FROM w LEFT JOIN q ON q.entity_id = w.entity_id GROUP BY w.entity_id""")
def _(s, d):
    t = table(s, d, "persistence").where("entity_id IS NOT NULL")

    def state(half: int) -> DataFrame:
        p = t.where(F.col("upsert_id") % 2 == half)
        ids = p.select("entity_id", F.explode("source_ids").alias("x")).where("x IS NOT NULL").groupBy("entity_id").agg(F.array_sort(F.collect_set("x")).alias("source_ids"))
        w = p.groupBy("entity_id").agg(F.collect_list(F.struct(F.col("upsert_id").alias("window"))).alias("_source_windows"))
        j = w.join(ids, "entity_id", "left").withColumn("source_ids", F.coalesce("source_ids", F.array().cast("array<string>")))
        return j.withColumn("_sources", F.transform("source_ids", lambda x: F.struct(x.alias("source_id"), F.lit(half).alias("half"))))

    m = upserts.merge_accumulators(state(0), state(1), "entity_id")
    old = F.array_sort(F.transform(F.filter("_sources", lambda x: x["half"] == 0), lambda x: x["source_id"]))
    return m.select("entity_id", F.size("source_ids").cast("bigint").alias("sources"), F.size("_sources").cast("bigint").alias("ledger"), F.array_join(old, ",").alias("of_old"), F.size("_source_windows").cast("bigint").alias("windows"))


@query("k10_refresh_counts", "SELECT count(*) AS n, count(*) FILTER (geoid IS NOT NULL) AS enabled FROM strategy")
def _(s, d):
    return upserts.refreshed(table(s, d, "strategy"), F.col("geoid").isNotNull())[1]


@query("k12_catalog", """
    SELECT DISTINCT tipo_evento AS entity_type, 'supertype' AS entity_kind, CAST(NULL AS varchar) AS parent FROM event_linking WHERE tipo_evento IS NOT NULL AND tipo_evento <> 'security'
    UNION ALL SELECT DISTINCT coalesce(subtipo_evento, 'general'), 'leaf', tipo_evento FROM event_linking WHERE tipo_evento IS NOT NULL AND tipo_evento <> 'security'""")
def _(s, d):
    t = table(s, d, "event_linking").where("tipo_evento IS NOT NULL").select(F.coalesce("subtipo_evento", F.lit("general")).alias("event_type"), F.col("tipo_evento").alias("supertype"), F.when(F.col("tipo_evento") == "security", "theme").otherwise("event").alias("category"))
    return upserts.catalog_seed(t)


@query("j9_types_joined", "SELECT s.strat_id, c.n FROM strategy s JOIN (SELECT event_type, count(*) AS n FROM strategy GROUP BY 1) c USING (event_type)")
def _(s, d):
    t = table(s, d, "strategy").select("strat_id", "event_type")
    return t.join(t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type").select("strat_id", "n")


# --- text and reports ---------------------------------------------------------------------------------------------------------

@query("x10_pascal", "SELECT DISTINCT tipo_evento, array_to_string(list_transform(string_split(tipo_evento, '_'), lambda x: upper(left(x, 1)) || substr(x, 2)), '') AS pascal FROM event_linking WHERE tipo_evento IS NOT NULL")
def _(s, d):
    return table(s, d, "event_linking").where("tipo_evento IS NOT NULL").select("tipo_evento").distinct().withColumn("pascal", text.pascal(F.col("tipo_evento")))


@query("x11_legacy_clean", "SELECT row_id, translate(lower(lugar), 'áéíóúñ', 'aeioun') AS clean FROM event_linking WHERE lugar IS NOT NULL")
def _(s, d):
    return table(s, d, "event_linking").where("lugar IS NOT NULL").select("row_id", text.legacy_clean(F.col("lugar")).alias("clean"))


@query("x16_fixture_slug", f"SELECT row_id, replace(trim(regexp_replace({NORM.format('nombre')}, '[^a-z0-9]+', ' ', 'g')), ' ', '_') AS slug FROM event_linking WHERE nombre IS NOT NULL")
def _(s, d):
    return table(s, d, "event_linking").where("nombre IS NOT NULL").select("row_id", text.fixture_slug(F.col("nombre")).alias("slug"))


@query("x18_first_700", "SELECT doc_id, left(text, 700) AS highlight, left(text, 3500) AS prompt FROM documents WHERE text IS NOT NULL")
def _(s, d):
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", text.shortened(F.col("text"), 700).alias("highlight"), text.shortened(F.col("text"), 3500).alias("prompt"))


@query("x17_word_jaccard", f"""
    WITH p AS (SELECT e.row_id, s.strat_id, string_split({NORM.format('e.nombre')}, ' ') AS a, string_split({NORM.format('s.name')}, ' ') AS b FROM event_linking e JOIN strategy s ON e.grupo_id = s.entity_id WHERE trim(e.nombre) <> '' AND trim(s.name) <> ''),
    t AS (SELECT row_id, strat_id, list_distinct(list_concat(a, list_transform(range(1, greatest(len(a) - 1, 1)), lambda i: array_to_string(a[i:i + 2], ' ')))) AS x, list_distinct(list_concat(b, list_transform(range(1, greatest(len(b) - 1, 1)), lambda i: array_to_string(b[i:i + 2], ' ')))) AS y FROM p)
    SELECT row_id, strat_id, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) AS similarity FROM t""")
def _(s, d):
    e, c = table(s, d, "event_linking").where("trim(nombre) <> ''").select("row_id", "nombre", F.col("grupo_id").alias("entity_id")), table(s, d, "strategy").where("trim(name) <> ''").select("strat_id", "entity_id", "name")
    return e.join(c, "entity_id").select("row_id", "strat_id", F.round(text.shingle_similarity(F.col("nombre"), F.col("name")), 6).alias("similarity"))


@query("x8_parsed_lists", "SELECT strat_id, len(source_ids) AS n FROM strategy WHERE len(source_ids) > 0 AND len(list_filter(source_ids, lambda x: x IS NULL OR contains(x, '\"') OR trim(x) = '')) = 0")
def _(s, d):
    t = table(s, d, "strategy").where(F.size("source_ids") > 0).where(~F.exists("source_ids", lambda x: x.isNull() | F.contains(x, F.lit('"')) | (F.trim(x) == "")))
    return t.select("strat_id", F.size(text.parse_list(F.concat(F.lit('"'), F.array_join("source_ids", '" "'), F.lit('"')))).alias("n"))


@query("a10_model_comparison", """
    SELECT d.model, docs, total_records, total_llm_s, mean_llm_s_per_doc, errors, mean_call_s, max_call_s FROM (SELECT coalesce(news_type, 'none') AS model, count(_source_id) AS docs, CAST(sum(batch_id) AS bigint) AS total_records, round(sum(date_diff('second', date_created, delivered_at)), 1) AS total_llm_s, round(avg(date_diff('second', date_created, delivered_at)), 1) AS mean_llm_s_per_doc, count(fuente) AS errors FROM link GROUP BY 1) d
    LEFT JOIN (SELECT coalesce(news_type, 'none') AS model, round(avg(delivery_id), 1) AS mean_call_s, round(max(delivery_id), 1) AS max_call_s FROM link WHERE delivery_id % 2 = 0 GROUP BY 1) c USING (model)""")
def _(s, d):
    t = table(s, d, "link").withColumn("model", F.coalesce("news_type", F.lit("none")))
    docs = t.select("model", F.col("_source_id").alias("source_id"), F.col("batch_id").alias("n_records"), (F.date_trunc("second", "delivered_at").cast("long") - F.date_trunc("second", "date_created").cast("long")).cast("double").alias("llm_s"), F.col("fuente").alias("error"))
    return reports.model_comparison(docs, t.where("delivery_id % 2 = 0").select("model", F.col("delivery_id").cast("double").alias("seconds")))


@query("f17_plausible", "SELECT strat_id FROM strategy WHERE year(written_at) > 2021 AND year(written_at) < 2025 AND geoid IS NOT NULL AND precision_days >= 3")
def _(s, d):
    return table(s, d, "strategy").where(reports.plausible(F.col("written_at"), F.col("geoid"), F.col("precision_days"), (2021, 2025))).select("strat_id")


@query("f18_relevant", "SELECT doc_id FROM documents WHERE doc_id % 4 >= 2 AND length(text) >= 150 AND NOT coalesce(contains(lower(doctype), 'face'), false)")
def _(s, d):
    return table(s, d, "documents").where(reports.relevant(F.col("doc_id") % 4, F.col("text"), F.col("doctype"), ("face",))).select("doc_id")


@query("t1_by_date_text", "SELECT doc_id FROM documents ORDER BY coalesce(CAST(published_at AS varchar), ''), doc_id LIMIT 200")
def _(s, d):
    return reports.by_date_text(table(s, d, "documents").select("doc_id", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("p")), "p", "doc_id", 200).select("doc_id")


@query("t3_sources_in_order", "SELECT _source_id, row_number() OVER (ORDER BY min(date_created), _source_id) AS place FROM link WHERE _source_id IS NOT NULL GROUP BY _source_id ORDER BY place LIMIT 100")
def _(s, d):
    t = table(s, d, "link").where("_source_id IS NOT NULL").groupBy("_source_id").agg(F.min("date_created").alias("first")).orderBy(F.col("first").asc_nulls_last(), "_source_id").limit(100)
    return t.select("_source_id", F.row_number().over(reports.Window.orderBy(F.col("first").asc_nulls_last(), "_source_id")).alias("place"))


@query("u3_bag_union", "SELECT s AS sid, count(*) AS n FROM (SELECT unnest(source_ids) AS s FROM strategy UNION ALL SELECT unnest(source_ids) FROM persistence) WHERE s IS NOT NULL GROUP BY 1")
def _(s, d):
    one = lambda n: table(s, d, n).select(F.explode("source_ids").alias("sid"))
    return one("strategy").unionByName(one("persistence")).where("sid IS NOT NULL").groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


@query("u6_first_by_title", "SELECT title, min(doc_id) AS doc_id FROM documents GROUP BY title")
def _(s, d):
    return table(s, d, "documents").groupBy("title").agg(F.min("doc_id").alias("doc_id"))


@query("m6_exploded", "SELECT strat_id, unnest(CASE WHEN len(source_ids) > 0 THEN source_ids ELSE [NULL] END) AS source FROM strategy")
def _(s, d):
    return reports.located_rows(table(s, d, "strategy").select("strat_id", F.col("source_ids").alias("source")), "source")


@query("m3_literal_lists", "SELECT strat_id, CASE WHEN strat_id % 2 = 0 THEN len(source_ids) ELSE 1 END AS n FROM strategy WHERE source_ids IS NOT NULL AND len(source_ids) > 0")
def _(s, d):
    written = F.when(F.col("strat_id") % 2 == 0, F.to_json("source_ids")).otherwise(F.col("source_ids")[0])
    return table(s, d, "strategy").where(F.size("source_ids") > 0).select("strat_id", F.size(text.literal_list(F.coalesce(written, F.lit("x")))).alias("n"))


@query("j15_prefix_links", """
    WITH t AS (SELECT strat_id, geoid, CAST(written_at AS date) AS d FROM strategy WHERE geoid IS NOT NULL AND written_at IS NOT NULL)
    SELECT a.strat_id AS id, b.strat_id AS match, 3 AS level FROM t a JOIN t b ON left(a.geoid, 9) = left(b.geoid, 9) AND b.strat_id < a.strat_id AND a.d - INTERVAL 2 DAY <= b.d + INTERVAL 2 DAY AND b.d - INTERVAL 2 DAY <= a.d + INTERVAL 2 DAY WHERE len(a.geoid) < 17""")
def _(s, d):
    t = table(s, d, "strategy").select(F.col("strat_id").alias("id"), "geoid", F.date_sub(F.to_date("written_at"), 2).alias("start"), F.date_add(F.to_date("written_at"), 2).alias("end"))
    return reports.prefix_links(t)


@query("f2_keyword_matches")
def _(s, d):
    t = table(s, d, "documents").select(F.col("doc_id").alias("id"), "text", F.array_compact(F.array("lang")).alias("categories"), F.col("doctype").alias("document_type"))
    return matching.match(t, s.createDataFrame([("agua", True, ["corte de agua"], [], [], [], [], []), ("vecinos", True, ["vecinales"], [], [], [], [], [])], RULE_SCHEMA))


# --- linking -------------------------------------------------------------------------------------------------------------------

@query("j4_range_candidates")
def _(s, d):
    return linking.candidates_by_range(records(s, d))


@query("proj21_case_log", WINDOWS + """, x AS (SELECT e.*, w.lo FROM ev e JOIN w USING (event_id)) SELECT a.event_id AS inc, count(*) AS n_candidates FROM x a JOIN x b ON a.supertype = b.supertype AND a.level_7_id = b.level_7_id AND b.event_id < a.event_id
    JOIN w wa ON wa.event_id = a.event_id JOIN w wb ON wb.event_id = b.event_id WHERE EXISTS (SELECT 1 FROM (VALUES (wb.lo - to_days(wb.slack), wb.lo + to_days(wb.slack)), (b.day - INTERVAL 2 DAY, b.day + INTERVAL 2 DAY)) v(l, h) WHERE wa.lo - to_days(wa.slack) <= h AND l <= wa.lo + to_days(wa.slack)) GROUP BY 1""")
def _(s, d):
    r = records(s, d)
    return linking.case_log(linking.candidates(r, keys="^l7:"), r, ev(s, d).select(F.col("event_id").alias("id"), F.col("event_type").alias("name"))).select("inc", "n_candidates")


def linkable(s: SparkSession, d: str) -> DataFrame:
    r = records(s, d).withColumn("geo_precision", F.when(F.col("level_7_id").isNotNull(), 7).when(F.col("level_6_id").isNotNull(), 6).when(F.col("level_3_id").isNotNull(), 3).otherwise(0))
    return fold.link_ids(r, "id")


@query("r0_linked")
def _(s, d):
    return fold.link(linkable(s, d), ["published", "id"])


@query("r0_canonicals")
def _(s, d):
    r = linkable(s, d)
    m = fold.link(r, ["published", "id"]).join(r, "id")
    none = F.lit(None).cast("string")
    m = m.select("link_id", F.struct("published", "id").alias("seq"), F.col("id").cast("string").alias("source_id"), F.col("supertype").alias("news_type"), F.col("event_type").alias("name"), none.alias("description"), none.alias("context"), none.alias("status"), "published", "window", "precision_days", F.coalesce("level_7_id", "level_6_id", "level_3_id").alias("location"), "geo_precision")
    c = linking.canonical(m.withColumn("seq", F.row_number().over(reports.Window.partitionBy("link_id").orderBy("seq"))))
    return c.select("link_id", "n", F.size("source_ids").alias("sources"), F.col("publication_date").cast("string").alias("published"))


@query("r3_document_states", """
    WITH l AS (SELECT _source_id AS id, CASE WHEN delivery_id % 5 = 0 THEN 'processed' WHEN delivery_id % 5 = 1 THEN 'released' ELSE 'processing' END AS state, delivered_at AS ts FROM link WHERE _source_id IS NOT NULL AND _source_id <> ''),
    n AS (SELECT max(ts) AS now FROM l), a AS (SELECT l.* FROM l, n WHERE CASE state WHEN 'processed' THEN epoch(now) - epoch(ts) < 1209600 WHEN 'processing' THEN epoch(now) - epoch(ts) < 600 ELSE true END)
    SELECT id, state FROM (SELECT id, CASE WHEN bool_or(state = 'processed') THEN 'processed' ELSE first(state ORDER BY ts DESC, CASE WHEN state = 'released' THEN 0 ELSE 1 END DESC) END AS state FROM a GROUP BY id) WHERE state <> 'released'""")
def _(s, d):
    k = F.col("delivery_id") % 5
    log = table(s, d, "link").select(F.col("_source_id").alias("id"), F.when(k == 0, "processed").when(k == 1, "released").otherwise("processing").alias("state"), F.col("delivered_at").alias("at"))
    now = log.where("id IS NOT NULL AND id <> ''").agg(F.max("at")).first()[0]
    return pipeline.current(log, F.lit(now))


@query("r2_outcomes", """SELECT delivery_id, CASE WHEN payload IS NOT NULL AND json_valid(payload) THEN 'ok' WHEN payload IS NULL THEN 'dead' WHEN delivery_id % 7 >= 5 THEN 'dead' ELSE 'retry' END AS outcome FROM link""")
def _(s, d):
    t = table(s, d, "link").select("delivery_id", "payload")
    why = F.when(F.col("payload").isNull(), "malformed: empty").when(F.try_parse_json("payload").isNull(), "sink")
    return pipeline.outcomes(t, why, F.col("delivery_id") % 7).select("delivery_id", "outcome")
