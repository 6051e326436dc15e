"""Operators of the event graph against plain Python and made cases."""

import json
from datetime import date, datetime, timedelta
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telar.functions import answers, articles, geo, nested, text
from telar.functions.instants import zone_ids
from telar.functions.stem import stem
from telar.operators import fold, gazetteer, linking, matching, reports, requests, upserts
from telar.queries.reference import RULE_SCHEMA
from telar.sources import readers
from telar.streaming import pipeline


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- text and matching -----------------------------------------------------------------------------------------------

def test_stems():
    pairs = {"libros": "libr", "corriendo": "corr", "robaron": "rob", "robo": "rob", "municipales": "municipal", "rapidamente": "rapid", "organizacion": "organiz", "trabajadores": "trabaj", "a": "a", "": "", "robo,": "robo,", "logia": "log"}
    assert {w: stem(w) for w in pairs} == pairs


def test_accents_of_all_letters(spark):
    cases = {"ÁRBOL  ő ā ș\tñ ": "arbol o a s n", "Ｍｅｇａ": "ｍｅｇａ", None: None, "": ""}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: (r.n, r.k) for r in df.select("i", text.normalize_text(F.col("t")).alias("n"), text.name_key(F.col("t")).alias("k")).collect()}
    assert [got[i][0] for i in range(4)] == list(cases.values()) and [got[i][1] for i in range(4)] == ["arboloasn", "mega", None, ""]
    s = spark.createDataFrame([("Mega Bachetón 2026", "MegaBacheton 2026"), ("ab", "ab"), ("ab", "ac"), (None, "x"), ("ﬁn ½", "fin 12")], "a string, b string")
    assert [r.s for r in s.select(text.name_similarity(F.col("a"), F.col("b")).alias("s")).collect()] == [1.0, 1.0, 0.0, 0.0, 1.0]


ARTICLES = [("1", "Hubo un ROBO en la calle, nada más", ["Seguridad"], "news"), ("2", "Los robots asaltaron la tienda", [], "News"), ("3", None, None, None), ("4", "Asaltó con broma pesada", ["seguridad"], "facebook"), ("5", "tienda robada; la ley de obra", ["Deportes"], "gaceta")]


def test_rules_branch_by_branch(spark):
    a = spark.createDataFrame(ARTICLES, "id string, text string, categories array<string>, document_type string")
    rules = [
        ("all", None, [], [], [], [], [], []), ("off", False, [], [], [], [], [], []), ("kw", True, ["Robó", "asalto"], [], [], [], [], []), ("phrase", True, [], ["robo"], [], [], [], []), ("not", True, ["asaltar"], [], ["BROMA"], [], [], []),
        ("cat", True, [], [], [], ["Seguridad"], [], []), ("dismiss", True, [], [], [], [], ["Deportes"], []), ("type", True, [], [], [], [], [], ["NEWS"]), ("words", True, ["obra Ley"], [], [], [], [], []), ("either", True, ["zzz"], ["la ley"], [], [], [], []),
    ]
    got = {}
    for r in matching.match(a, spark.createDataFrame(rules, RULE_SCHEMA)).collect():
        got.setdefault(r.ontology_class, set()).add(r.id)
    assert got == {"all": {"1", "2", "3", "4", "5"}, "kw": {"1", "2", "4"}, "phrase": {"1", "2"}, "not": {"2"}, "cat": {"1"}, "dismiss": {"1", "2", "3", "4"}, "type": {"1", "2"}, "words": {"5"}, "either": {"5"}}
    assert matching.match(a.limit(0), spark.createDataFrame(rules, RULE_SCHEMA)).count() == 0 and matching.match(a, spark.createDataFrame([], RULE_SCHEMA)).count() == 0
    plan = matching.match(a, spark.createDataFrame(rules, RULE_SCHEMA))._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan.split("== Physical Plan ==")[-1]


# --- documents, schemas, answers --------------------------------------------------------------------------------------

def test_articles_of_both_shapes(spark):
    docs = [
        {"_id": "n1", "text": "cuerpo", "title": "t", "url": "u", "doctype": "News", "article_date": "", "date": "2024-01-02", "custom_categories": {"level_1": ["A", "B"], "level_2": "C", "level_3": 4}, "news_type": "nota"},
        {"_id": "f1", "type": "Facebook", "message": {"body": "b", "title": None, "source_category": "X", "source_tags": ["Y", "Z"], "created_time": 17}},
        {"url": "only", "summary": "s"}, {},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(9, "{broken"), (10, None)], "k int, payload string")
    got = {r.id: (r.text, r.title, r.url, r.categories, r.document_type, r.publication_date, r.news_type) for r in articles.articles(df, key="k").collect()}
    assert got == {
        "n1": ("cuerpo", "t", "u", ["A", "B", "C"], "news", "2024-01-02", "nota"), "f1": ("b", "", "f1", ["X", "Y", "Z"], "facebook", "17", None),
        "only": ("s", "", "only", [], "news", None, None), "3": ("", "", "", [], "news", None, None),
    }


SCHEMA = nested.COMPOSITES | {
    "Event": {
        "name": {"type": "str", "required": True}, "dates": {"type": "List[DateRangeFromUnstructured]"}, "main": {"type": "LocationCoords"}, "places": {"type": "List[LocationCoords]"}, "tags": {"type": "List[str]"}, "urls": {"type": "List[Url]"},
        "kind": {"type": "EnumStr", "enum": ["a", "b"], "default": "a"}, "label": {"type": "str", "default_fn": "label"}, "n": {"type": "int"},
    },
}
FNS = {"label": lambda at: F.concat(F.lit("of "), at("name"))}


def test_nested_records(spark):
    docs = [
        {"name": " N ", "lat": "1.5", "lon": 2, "main": {"lon": "7"}, "dates": [{"date_range": {"start": "2024-01-02T00:00:00Z", "end": None}, "precision_days": "3"}, {"date_range": {}}], "tags": "['no', json", "urls": '["http://a.mx/x", "bad"]', "kind": "z", "n": "3.9", "unknown": 1},
        {"main": "scalar", "places": [{"lat": 1}, {"lat": "x"}], "tags": ["p", " q "]},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(2, "{"), (3, None)], "k int, payload string")
    t = nested.normalized(df, "payload", SCHEMA, "Event", zone_ids(spark), ["k"], FNS)
    got = {r.k: (r.record.asDict(True), {(v.field, v.message) for v in r.violations}) for r in t.collect()}
    one, bad = got[0]
    assert one["name"] == "N" and one["main"] == {"lat": 1.5, "lon": 7.0} and one["n"] == 3 and one["label"] == "of N" and one["kind"] == "z" and one["places"] == []
    assert one["dates"][0]["date_range"]["start"] == datetime(2024, 1, 2) and one["dates"][0]["date_range"]["end"] is None and one["dates"][0]["precision_days"] == 3 and one["dates"][1]["date_range"] == {"start": None, "end": None}
    assert one["tags"] == ["['no', json"] and one["urls"] == ["http://a.mx/x", "bad"] and bad == {("kind", "not allowed"), ("urls", "no address")}
    two, bad = got[1]
    assert two["main"] == {"lat": None, "lon": None} and two["places"] == [{"lat": 1.0, "lon": None}, {"lat": None, "lon": None}] and two["tags"] == ["p", "q"] and two["kind"] == "a" and bad == {("name", "required")}
    assert got[2] == got[3] and got[2][0]["dates"] == [] and got[2][1] == {("name", "required")}
    with pytest.raises(Exception, match="violations"):
        nested.normalized(df, "payload", SCHEMA, "Event", zone_ids(spark), ["k"], FNS, strict=True).select("violations").collect()
    with pytest.raises(KeyError):
        nested.normalized(df, "payload", SCHEMA, "Event", zone_ids(spark), ["k"])
    assert nested.dependencies(SCHEMA, "Event") == ["Event", "DateRangeFromUnstructured", "LocationCoords", "PeriodDates"]
    assert ("PeriodDates", "start", "datetime") in nested.fields_for_prompt(SCHEMA, "Event")


def test_answers_to_entities(spark):
    wrap = lambda n: "{" + '"w":{' * (n - 1) + '"w":[{"a":1}]' + "}" * n
    cases = {
        '[{"a":1}, null, "x", {"b":2}]': ['{"a":1}', '{"b":2}'], '```json\n{"events": [{"a":1},]}\n```': ['{"a":1}'], '{"r": {"e": [{"a":1}]}}': ['{"a":1}'], '{"s": "t", "e": [{"a":1}, {"b":1}]}': ['{"a":1}', '{"b":1}'],
        '{"x": [{"a":1}], "y": [{"b":1}]}': ['{"x":[{"a":1}],"y":[{"b":1}]}'], '{"name": "n"}': ['{"name":"n"}'], '{"a": 1, "b": []}': ['{"a":1,"b":[]}'], "[]": [], "3": None, '{"a": [{"b"': None, None: None, wrap(5): ['{"a":1}'], wrap(6): ['{"a":1}'], wrap(7): ['{"w":[{"a":1}]}'],
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: r.e for r in df.select("i", F.transform(answers.entity_list(F.col("t")), lambda x: F.to_json(x)).alias("e")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    m = spark.createDataFrame([('{"match_id": "a"}', ["a", "b"]), ('{"match_id": "z"}', ["a"]), ('{"match_id": null}', ["a"]), ("broken", ["a"])], "t string, ok array<string>")
    assert [r.m for r in m.select(answers.matched_id(F.col("t"), F.col("ok")).alias("m")).collect()] == ["a", None, None, None]


def test_answers_replayed_and_prompts(spark):
    q = spark.createDataFrame([("u1", "c"), ("u2", "c")], "url string, kind string")
    held = q.where("url = 'u1'").select(text.named_hash({"kind": F.col("kind"), "url": F.col("url")}).alias("key"), F.lit("r").alias("response"))
    assert {r.url: r.response for r in answers.replayed(q, held, ["url", "kind"]).collect()} == {"u1": "r", "u2": None}
    t = answers.turns(answers.rendered(F.lit("SYSTEM: hola {x}\nUSER: y {x}\nmás"), {"x": F.lit("Z")}))
    assert [(x.role, x.content) for x in spark.range(1).select(t.alias("t")).first().t] == [("system", "hola Z"), ("user", "y Z\nmás")]
    s = answers.question(F.struct(F.lit(1).alias("a")), F.array(F.struct(F.lit(2).alias("b"))))
    assert '"a" : 1' in spark.range(1).select(s.alias("s")).first().s
    b = answers.batch_line(F.lit('{"custom_id":"c","response":{"body":{"choices":[{"message":{"content":"x"}}]}}}'))
    assert tuple(spark.range(1).select(b.alias("b")).first().b) == ("c", "x")


# --- places, requests, readers -----------------------------------------------------------------------------------------

def test_gazetteer(spark):
    cols = ["country", "state", "city", "neighborhood", "zone", "street", "number", "place_name"]
    df = spark.createDataFrame([(1, ("México", " Qro ", "Querétaro", None, "norte", "Av. 5", "12", "")), (2, (None, None, None, None, None, None, "7", None)), (3, ("MEXICO", "qro", "queretaro", "", "sur", "AV 5", "12", None))], f"k int, location struct<{','.join(c + ':string' for c in cols)}>")
    t = df.withColumn("location", gazetteer.trimmed(F.col("location")))
    got = {r.k: [(m.level, m.text, m.pos) for m in r.m] for r in t.select("k", gazetteer.mentions(F.col("location")).alias("m")).collect()}
    assert got[1] == [("PAIS", "México", 0), ("EST", "Qro", 1), ("MUN", "Querétaro", 2), ("CALLE", "Av. 5 12", 3)] and got[2] == [("CALLE", "7", 0)]
    g = t.where("k = 1").select(gazetteer.location_key(F.col("location")).alias("_key"), F.lit("_484").alias("geoid"))
    assert {r.k: r.geoid for r in gazetteer.geocoded(t, "location", g).collect()} == {1: "_484", 2: None, 3: "_484"}
    level = ", ".join(f"level_{n} string, level_{n}_id string" for n in gazetteer.LEVELS)
    m = spark.createDataFrame([(1, o, p, f"g{o}", None, 1.0, 2.0, *[None] * 14) for o, p in ((1, "3"), (2, "7"), (3, "7"), (4, "x"))], f"k int, o int, precision_level string, geoid string, formatted_name string, lat double, lon double, {level}")
    best = gazetteer.best_match(m, "k", "o")
    r = best.select(gazetteer.response(F.struct(*best.columns)).alias("r")).first().r
    assert (r.geoid, r.precision_level, r.formatted_name, r.matched_lat, len(r)) == ("g2", 7, "", 1.0, 19)


def test_requests(spark):
    r = requests.compiled({"kw": '"a","b"', "not": '"c"', "categories": "A>B|A>C", "bbox": "[[-100, 20], [-99, 21]]", "document_type": "News,x", "period": None, "cvegeo": "_1, _2"})
    assert r["keywords"] == {"AND": [{"OR": ["a", "b"]}, {"NOT": {"OR": ["c"]}}]} and r["categories"] == {"level_1": ["A"], "level_2": ["B", "C"]} and r["bounding_box"] == [-100, 20, -99, 21] and r["doctype"] == "news" and r["period"] == "w" and r["cvegeo"] == ["_1", "_2"] and r["location_type"] == "mentioned"
    assert requests.compiled({"not": "x, y"})["keywords"] == {"NOT": {"OR": ["x", "y"]}} and requests.box("a") == [] and requests.box("1,2,3") == []
    loc = lambda *xs: [{"level_2_id": a, "precision_level": b} for a, b in xs]
    df = spark.createDataFrame([(1, "Una obra, nueva", loc(("_22", "2"), ("11", "5")), ["Deportes"], -99.5, 20.5), (2, "obras", loc(("22", "3")), ["x"], -99.5, 30.0), (3, None, None, None, None, None)], "k int, text string, locations_mentioned array<struct<level_2_id:string,precision_level:string>>, categories array<string>, lon double, lat double")
    hit = lambda c: {r.k for r in df.where(c).collect()}
    assert hit(requests.wanted(F.col("locations_mentioned"), F.col("categories"), ["_22"])) == {2} and hit(requests.mentions_place(F.col("locations_mentioned"), ["22"])) == {1, 2}
    p = lambda req: hit(requests.predicate(req, ["text", "lat", "lon", "locations_mentioned"]))
    assert p({"keywords": ["obra"]}) == {1} and p({"keywords": {"NOT": ["obra"]}}) == {2, 3} and p({"phrases": "obra"}) == {1, 2} and p({"bounding_box": [-100, 20, -99, 21]}) == {1} and p({"cvegeo": ["22"], "keywords": []}) == {1, 2} and p({}) == {1, 2, 3}
    x = requests.products(df.select("k"), spark.createDataFrame([("y",), ("o",)], "b string"), spark.createDataFrame([("p",)], "p string"))
    assert len(rows(x)) == 6


def test_recovered_objects_and_readers(spark, tmp_path):
    good = ['{"a": "}{", "b": {"c": "\\""}}', '{"d": 1}']
    texts = [f"[{good[0]}, {good[1]}, {{", f'{{"cut": {good[0]}', 'x " { ' + good[1], "", None, "}}}", "{" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    assert rows(readers.recovered(df, "t").select("k", "record")) == sorted([(0, good[0]), (0, good[1]), (1, good[0]), (2, good[1])])
    (tmp_path / "one.json").write_text('{"a": 1}')
    (tmp_path / "two.json").write_text('[{"a": 2}, {"a": 3}]')
    assert rows(readers.read_json(spark, str(tmp_path / "*.json"), "a int")) == [(1,), (2,), (3,)] and readers.read_json(spark, str(tmp_path), "a int", limit=2).count() == 2
    out = readers.write_json(readers.read_json(spark, str(tmp_path / "two.json"), "a int"), str(tmp_path / "run"), stamped=True)
    assert "run_2" in out and spark.read.json(out).count() == 2
    readers.publish(df.where("k = 0").select("k"), str(tmp_path / "queue"), F.lit("t1"))
    assert spark.read.json(str(tmp_path / "queue")).first().trace_id == "t1"
    (tmp_path / "d.csv").write_text("event_type,supertype,x\na,b,1\n")
    assert rows(readers.read_dimension(spark, str(tmp_path / "d.csv"), ["event_type", "supertype"])) == [("a", "b")]


# --- writes ---------------------------------------------------------------------------------------------------------------

def test_writes(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e"), (3, "e"), (None, "m"), (None, "m")], "k int, v string")
    up = upserts.upsert(old, new, ["k"], ["v"])
    assert sorted((r.k or 0, r.v) for r in up.collect()) == [(0, "m"), (0, "m"), (0, "n"), (1, "a"), (2, "d"), (3, "e")]
    once = upserts.upsert(upserts.upsert(old, new.where("k IS NOT NULL"), ["k"], ["v"]), new.where("k IS NOT NULL"), ["k"], ["v"])
    assert sorted((r.k or 0, r.v) for r in once.collect()) == [(0, "n"), (1, "a"), (2, "d"), (3, "e")]
    kind = "k int, source_ids array<string>, _sources array<struct<source_id:string,d:int>>, _source_windows array<int>"
    a, b = spark.createDataFrame([(1, ["x"], [("x", 1)], [5])], kind), spark.createDataFrame([(1, ["y", "x"], [("x", 9), ("y", 2)], [6]), (2, ["z"], [("z", 3)], [7])], kind)
    got = {r.k: (r.source_ids, [tuple(s) for s in r._sources], r._source_windows) for r in upserts.merge_accumulators(a, b, "k").collect()}
    assert got == {1: (["x", "y"], [("x", 1), ("y", 2)], [5, 6]), 2: (["z"], [("z", 3)], [7])}
    led = spark.createDataFrame([("d", "p", "skipped", 1), ("d", "p", "linked", 2), (None, "p", "linked", 3)], "doc string, p string, status string, t int")
    assert [(r.doc, r.status) for r in upserts.ledger(led, "doc", ["p"], ["status"], ["t"]).collect()] == [("d", "linked")]
    x = spark.createDataFrame([("1", "2")], "b string, a string")
    assert x.select(text.named_hash({"a": F.col("a"), "b": F.col("b")}).alias("h")).first() == x.select(text.named_hash({"b": F.col("b"), "a": F.col("a")}).alias("h")).first()


def test_canonical_merge(spark):
    w = lambda d, s: (d, d, 1, s)
    d1, d2 = date(2024, 1, 1), date(2024, 1, 5)
    data = [
        (1, 1, "s1", "n1", None, "", None, None, d2, w(d2, "publication"), None, "city", 3), (1, 2, "s2", "n2", "A", "D", "C", None, d1, w(d2, "extracted"), 3, "street", 6), (1, 3, "s1", "n9", "B", "E", "X", "ok", d2, w(d1, "extracted"), None, "other street", 6), (1, 4, None, None, None, None, None, None, None, w(d2, "extracted"), 0, None, None),
    ]
    kind = "link_id int, seq int, source_id string, news_type string, name string, description string, context string, status string, published date, window struct<start:date,end:date,slack:int,source:string>, precision_days int, location string, geo_precision int"
    c = linking.canonical(spark.createDataFrame(data, kind)).first()
    assert (c["name"], c.description, c.context, c.status, c.publication_date, c.n) == ("A", "D", "C", "ok", d1, 4) and c.date_range.start == d1 and c.date_range.precision_days is None
    assert (c.place.location, c.place.precision, c.source_ids, c._date_source, len(c._source_windows)) == ("street", 6, ["s1", "s2"], "publication", 4)
    assert [(s.source_id, s.publication_date, s.news_type) for s in c._sources] == [("s1", d2, "n1"), ("s2", d1, "n2")]


# --- the linking fold -------------------------------------------------------------------------------------------------------

PREP = "id bigint, supertype string, event_type string, start date, end date, published date, precision_days int, " + ", ".join(f"level_{n}_id string" for n in geo.LEVELS) + ", lat double, lon double, state string, geo_precision int"


def made(n, seed=3):
    rng, out = Random(seed), []
    for i in range(n):
        depth = rng.choice([0, 3, 5, 6, 6, 6, 7, 7])
        path = {1: "_1", 2: "_12", 3: "_123"} if depth else {}
        if depth >= 5 and rng.random() < 0.4:
            path[5] = "_123c" + rng.choice("ab")
        if depth >= 6:
            path[6] = "_123s" + rng.choice("xyz")
        if depth == 7:
            path[7] = path[6] + rng.choice("12")
        day = date(2024, 1, 1) + timedelta(rng.randint(0, 25))
        start = day if rng.random() < 0.7 else None
        out.append((i, rng.choice("ab"), rng.choice("tu"), start, start and start + timedelta(rng.choice([0, 0, 2])), day + timedelta(rng.randint(-3, 3)) if start is None or rng.random() < 0.8 else None, rng.choice([None, 0, 2, 30]), *[path.get(k) for k in geo.LEVELS], None, None, rng.choice([None, "qro"]), max(path, default=0)))
    return out


def brute(records, day_slack=1):
    """The fold as a plain loop over all canonicals."""
    canon, links = [], {}
    for r in records:
        start, end = r["window"].start, r["window"].end
        if start is None:
            continue
        path = {n: r[f"level_{n}_id"] for n in geo.LEVELS if r[f"level_{n}_id"]}
        exact = r["window"].source == "extracted"
        best = None
        for c in canon:
            if (c["supertype"], c["event_type"]) != (r["supertype"], r["event_type"]) or not path or not c["path"]:
                continue
            if not (path.items() <= c["path"].items() or c["path"].items() <= path.items()):
                continue
            if not any(n in path and path[n] == c["path"].get(n) for n in ((6, 7) if exact and c["exact"] else (7,))):
                continue
            if start - timedelta(day_slack) <= c["end"] and c["start"] <= end + timedelta(day_slack):
                key = (c["published"] is None, c["published"] or start, c["id"])
                if best is None or key < best[0]:
                    best = (key, c)
        if best is None:
            canon.append({"id": r["new_id"], "supertype": r["supertype"], "event_type": r["event_type"], "path": path, "precision": r["geo_precision"], "start": start, "end": end, "exact": exact, "days": r["precision_days"], "published": r["published"]})
            links[r["id"]] = (r["new_id"], "created")
            continue
        c = best[1]
        links[r["id"]] = (c["id"], "merged")
        if r["published"] and (c["published"] is None or r["published"] < c["published"]):
            c["published"] = r["published"]
        if exact and (not c["exact"] or (r["precision_days"] or 0) < (c["days"] or 0)):
            c.update(start=start, end=end, exact=True, days=r["precision_days"])
        elif not c["exact"] and c["published"]:
            c.update(start=c["published"], end=c["published"])
        if r["geo_precision"] > c["precision"]:
            c.update(path=path, precision=r["geo_precision"])
    return links


def test_fold_equals_a_loop_and_repeats(spark):
    prep = fold.link_ids(linking.prepare(spark.createDataFrame(made(250), PREP)), "id")
    order = ["published", "id"]
    full = sorted(prep.collect(), key=lambda r: (r.published is not None, r.published or date.min, r.id))
    want = brute(full)
    got = {r.id: (r.link_id, r.status) for r in fold.link(prep, order).collect()}
    assert got == want and sum(s == "merged" for _, s in want.values()) > 20
    # Two batches with state between them, in the same order of arrival, give what one gives; a repeated batch creates nothing with a street.
    cut_at = full[120]
    first = prep.where(F.col("id").isin([r.id for r in full[:120]]))
    second = prep.where(F.col("id").isin([r.id for r in full[120:]]))
    a = fold.link(first, order)
    b = fold.link(second, order, fold.states(first, a, order))
    assert {r.id: (r.link_id, r.status) for r in a.union(b).collect()} == want and cut_at is not None
    again = fold.link(first.where("level_6_id IS NOT NULL"), order, fold.states(first, a, order))
    assert {r.link_id for r in again.collect()} <= {r.link_id for r in a.collect()}
    assert fold.link(prep.limit(0), order).count() == 0
    created = [i for i, (_, s) in want.items() if s == "created"][:2]
    ans = spark.createDataFrame([(created[1], created[0])], "id bigint, match_id bigint")
    got = {r.id: (r.link_id, r.status) for r in fold.link(prep, order, answers=ans).collect()}
    assert got[created[1]] == (want[created[0]][0], "merged")


def test_level_five_and_slack_of_the_gate(spark):
    base = dict.fromkeys(geo.LEVELS)
    row = lambda i, day, five=None, days=0: (i, "s", "t", day, day, day, days, *{**base, 1: "_1", 2: "_12", 3: "_123", 5: five, 6: "_123x"}.values(), None, None, None, 6)
    d = date(2024, 3, 1)
    r = linking.prepare(spark.createDataFrame([row(1, d, "a"), row(2, d, "b"), row(3, d), row(4, d + timedelta(30), None, 365), row(5, d + timedelta(1))], PREP))
    g = {(x.inc, x.cand): (x.geo_ok, x.certain, x.leaf) for x in linking.gated(linking.candidates(r), r).collect()}
    assert g[2, 1] == (False, True, "misma") and g[3, 1] == (True, True, "misma") and g[4, 3] == (True, False, "misma") and g[5, 3] == (True, True, "misma")


def test_range_candidates_equal_a_loop(spark):
    r = linking.prepare(spark.createDataFrame(made(120, 5), PREP))
    full = r.collect()
    fine = lambda x: {(n, x[f"level_{n}_id"]) for n in (3, 5, 6, 7) if x[f"level_{n}_id"]}
    span = lambda x: (x.window.start - timedelta(x.window.slack), x.window.end + timedelta(x.window.slack))
    want = set()
    for a in full:
        for b in full:
            if b.id < a.id and a.supertype == b.supertype and a.window.start and b.window.start:
                (l1, h1), (l2, h2) = span(a), span(b)
                state = not fine(b) and b.level_2_id is not None and b.level_2_id == a.level_2_id
                if (fine(a) & fine(b) or state) and l1 <= h2 and l2 <= h1:
                    want.add((a.id, b.id))
    assert {tuple(x) for x in linking.candidates_by_range(r).collect()} == want


def test_certain_pairs_come_without_candidates(spark, monkeypatch):
    # Equal records are one class, with the same result as the gate over all candidates; none of these are listed.
    rows = [*made(150, 9), *[(1000 + i, *made(20, 4)[i % 7][1:]) for i in range(60)]]
    r = linking.prepare(spark.createDataFrame(rows, PREP))
    fit = linking.gated(linking.candidates(r), r).where("geo_ok AND certain").cache()
    want = {tuple(x) for x in fit.select("inc", "cand", "leaf").collect()}
    capped = {tuple(x) for x in linking.capped(fit, 3).select("inc", "cand", "rank").collect()}
    decided = {tuple(x) for x in linking.decided(fit).collect()}
    monkeypatch.setattr(linking, "candidates", None)
    monkeypatch.setattr(linking, "gated", None)
    got = [tuple(x) for x in linking.certain(r).select("inc", "cand", "leaf").collect()]
    assert len(want) > 100 and len(got) == len(want) and set(got) == want
    assert {tuple(x) for x in linking.certain_capped(r, linking.LinkConfig(cap=3)).collect()} == capped
    assert {tuple(x) for x in linking.certain_decided(r).collect()} == decided


def test_candidates_leave_the_join_as_they_are_found(spark):
    # Pairs that meet under several keys and buckets are given once, without gathering them to be made distinct.
    row = lambda i: (i, "s", "t", date(2024, 1, 1), date(2024, 2, 20), date(2023, 11, 5 + i % 3), 30, "_1", "_12", "_123", None, "_123x", None, 20.5 + i / 1000, -100.4, "qro", 6)
    r = linking.prepare(spark.createDataFrame([row(i) for i in range(12)], PREP))
    for found in linking.INDEXES.values():
        got = [tuple(x) for x in found(r).collect()]
        assert len(got) == len(set(got)) == 66
        assert "Aggregate" not in found(r)._jdf.queryExecution().optimizedPlan().toString()


def test_referrals_equal_the_steps(spark):
    r = linking.prepare(spark.createDataFrame(made(120, 7), PREP))
    want = {(x.inc, x.cand, x["rank"]) for x in linking.referred(linking.gated(linking.candidates(r), r), 3).collect()}
    got = [(x.inc, x.cand, x["rank"]) for x in linking.referrals(r, linking.LinkConfig(cap=3)).collect()]
    assert want and len(got) == len(want) and set(got) == want


# --- streaming ---------------------------------------------------------------------------------------------------------------

def test_claims(spark):
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    log = spark.createDataFrame([("working", "processing", at(0)), ("lapsed", "processing", at(-700)), ("done", "processing", at(0)), ("done", "processed", at(1)), ("old", "processed", at(-15 * 86400)), ("back", "processing", at(0)), ("back", "released", at(1))], "id string, state string, at timestamp")
    now = F.lit(at(10))
    assert {(r.id, r.state) for r in pipeline.current(log, now).collect()} == {("working", "processing"), ("done", "processed")}
    batch = spark.createDataFrame([(x,) for x in ("working", "lapsed", "done", "old", "back", "new", "new", "", None)], "id string")
    assert {r.id for r in pipeline.claimable(batch, log, "id", now).collect()} == {"lapsed", "old", "back", "new"}
    won = pipeline.claimable(batch, log, "id", now)
    after = log.unionByName(pipeline.marked(won, "id", "processed", now))
    assert pipeline.claimable(batch, after, "id", now).count() == 0
    t = spark.createDataFrame([(1, None, 0), (2, "sink", 1), (3, "sink", 5), (4, "malformed: x", 0)], "k int, why string, n int")
    assert {r.k: r.outcome for r in pipeline.outcomes(t, F.col("why"), F.col("n")).collect()} == {1: "ok", 2: "retry", 3: "dead", 4: "dead"}


def test_once_in_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, ids in enumerate((["a", "b", "a"], ["b", "c"])):
        (src / f"{i}.json").write_text("\n".join(json.dumps({"id": x, "at": "2024-01-01T00:00:00"}) for x in ids))
    docs = pipeline.once(pipeline.documents(spark, str(src), "id string, at timestamp", 1), "id", "at")
    q = docs.select("id").writeStream.format("memory").queryName("seen_once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert sorted(r.id for r in spark.table("seen_once").collect()) == ["a", "b", "c"]


def test_linked_batches_equal_one_batch(spark, tmp_path):
    data = sorted(made(60, 9), key=lambda r: (r[5] is not None, r[5] or date.min, r[0]))
    prep = lambda df: fold.link_ids(linking.prepare(df), "id")
    whole = {r.id: r.link_id for r in fold.link(prep(spark.createDataFrame(data, PREP)), ["published", "id"]).collect()}
    step = pipeline.linked_batches(spark, str(tmp_path / "state"), prep, ["published", "id"])
    for number, part in enumerate((data[:25], data[20:45], data[45:])):  # the second delivers five again
        step(spark.createDataFrame(part, PREP), number)
    step(spark.createDataFrame(data[45:], PREP), 2)  # a repeated batch overwrites itself
    got = {r.id: r.link_id for r in spark.read.parquet(str(tmp_path / "state" / "links")).collect()}
    assert got == whole


# --- reports -------------------------------------------------------------------------------------------------------------------

def test_near_vectors_find_planted_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((200, 32))
    near = base[:60] + 0.25 * rng.standard_normal((60, 32))
    data = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near]))] + [(900, [0.0] * 32), (901, None)]
    df = spark.createDataFrame(data, "k int, e array<double>")
    u = np.vstack([base, near])
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    c = u @ u.T
    want = {(i, j) for i in range(260) for j in range(i + 1, 260) if c[i, j] >= 0.9}
    got = {(r.a, r.b) for r in reports.near_vectors(df, "k", "e").collect()}
    assert len(want) > 40 and got <= want and len(got) >= 0.98 * len(want)


def test_prefix_links_and_boxes(spark):
    g = "_48" + "4" * 23
    d = date(2024, 1, 1)
    df = spark.createDataFrame([(1, g, d, d), (2, g[:17] + "x" * 9, d, d), (3, g, d, d + timedelta(400)), (4, g[:9] + "y" * 8, d + timedelta(90), d), (5, g[:9], d + timedelta(500), d + timedelta(500)), (6, None, d, d)], "id int, geoid string, start date, end date")
    assert rows(reports.prefix_links(df)) == [(2, 1, 5), (3, 1, 7), (4, 1, 3), (4, 2, 3), (4, 3, 3)]
    b = spark.createDataFrame([("[[-100, 20], [-99, 21]]",), ("1 2 3",), (None,)], "t string")
    assert [r.b for r in b.select(geo.parsed_box(F.col("t")).alias("b")).collect()] == [[-100.0, 20.0, -99.0, 21.0], None, None]
