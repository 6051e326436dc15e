"""Every query with SQL against DuckDB on the smallest tables; the entry; streaming and writes."""

import os
from datetime import date, timedelta
from random import Random

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from telar.operators import linking
from telar.queries import general, reference, survey
from telar.sources import readers
from telar.streaming import pipeline

SQL = general.SQL | reference.SQL | survey.SQL
QUERIES = general.QUERIES | reference.QUERIES | survey.QUERIES
#: Queries without SQL, with the least rows of each on the smallest tables; what they compute is tested on made cases.
LEAST = {"p2_found": 500, "p4_found": 5, "p4_table": 100, "g6_geo_keys": 1000, "proj8_flat_records": 200, "f1_rule_matches": 50, "f2_keyword_matches": 1, "j3_candidates": 10_000, "j4_range_candidates": 10_000, "t2_referred": 1000, "j17_near_duplicates": 0, "r0_linked": 900, "r0_canonicals": 900}


def canon(df):
    show = lambda v: "∅" if v is None or (not hasattr(v, "__len__") and pd.isna(v)) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(map(tuple, df[sorted(df.columns)].map(show).values.tolist()))


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, duck, name):
    assert canon(QUERIES[name](spark, sf).toPandas()) == canon(duck.execute(SQL[name]).fetchdf())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rows = df.collect()
    assert len(rows) >= LEAST[name] and len(set(map(str, rows))) == len(rows)


def test_entry(spark):
    assert entry.entry(spark).columns == ["tbl", "campo", "row_id", "utc_us"] and set(entry.oracle_sql()) <= set(entry.queries())


def test_stream_and_damaged_lines(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id":"1","text":"El congreso local sesionó","categories":["es"],"document_type":"news"}\n{"id":"1","text":\n')
    schema = "id string, text string, categories array<string>, document_type string"
    rules = spark.createDataFrame(reference.RULES, reference.RULE_SCHEMA)
    q = pipeline.run(pipeline.documents(spark, str(src), schema), rules, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert [r.ontology_class for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["congreso"]
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1
    good, bad = readers.read_damaged(spark, str(src), schema)
    assert (good.count(), bad.count()) == (1, 1)


def test_all_candidates_against_brute_force(spark):
    rng, day = Random(4), date(2024, 3, 1)
    rows = []
    for i in range(400):
        path, depth = {}, rng.choice([0, 1, 2, 3, 4, 5, 6])
        for n in (1, 2, 3, 5, 6, 7)[:depth]:
            path[n] = (path.get({2: 1, 3: 2, 5: 3, 6: 5, 7: 6}.get(n, 0), "_") + str(rng.randint(0, 1) if n < 5 else 0))
        if depth > 3 and rng.random() < 0.3:
            path.pop(3)
        at = rng.random() < 0.4
        start = day + timedelta(rng.randint(0, 12)) if rng.random() < 0.7 else None
        published = day + timedelta(rng.randint(0, 12)) if start is None or rng.random() < 0.8 else None
        rows.append((i, rng.choice("xy"), rng.choice("tu"), start, start, published, rng.choice([None, 1, 3]), *[path.get(n) for n in (1, 2, 3, 5, 6, 7)],
                     20.0001 + 0.003 * rng.randint(0, 3) if at else None, -100.0001 + 0.003 * rng.randint(0, 3) if at else None, path.get(2) or rng.choice([None, "s"])))
    schema = "id bigint, supertype string, event_type string, start date, end date, published date, precision_days int, " + ", ".join(f"level_{n}_id string" for n in (1, 2, 3, 5, 6, 7)) + ", lat double, lon double, state string"
    r = linking.prepare(spark.createDataFrame(rows, schema))
    full = [x.asDict() | {"w": x.window} for x in r.collect()]

    def days(lo, slack):
        return {lo + timedelta(k) for k in range(-slack, slack + 1)}

    def meet(a, b):
        fine = lambda x: {(n, x[f"level_{n}_id"]) for n in (3, 5, 6, 7) if x[f"level_{n}_id"]}
        near = a["row"] is not None and b["row"] is not None and abs(a["row"] - b["row"]) <= 1 and abs(a["col"] - b["col"]) <= 1
        vague = not fine(b) and b["row"] is None and (b["state"] is None or b["state"] == a["state"])
        registered = days(b["w"].start, b["w"].slack) | (days(b["published"], 2) if b["published"] else set())
        return a["supertype"] == b["supertype"] and b["id"] < a["id"] and (fine(a) & fine(b) or near or vague) and days(a["w"].start, a["w"].slack) & registered

    path = lambda x: {(n, x[f"level_{n}_id"]) for n in (1, 2, 3, 5, 6, 7) if x[f"level_{n}_id"]}
    pairs = {(a["id"], b["id"]) for a in full for b in full if meet(a, b)}
    assert {tuple(x) for x in linking.candidates(r).collect()} == pairs
    fit = {(a["id"], b["id"]) for a in full for b in full if (a["id"], b["id"]) in pairs and path(a) and path(b) and (path(a) <= path(b) or path(b) <= path(a))}
    gates = linking.gated(linking.candidates(r), r)
    certain = {x.inc for x in linking.decided(gates).collect()}
    late = {x["id"]: (x["published"] is None, -(x["published"] or day).toordinal(), x["id"]) for x in full}
    want = {(i, c, k) for i in {p[0] for p in fit} - certain for k, c in enumerate(sorted((c for j, c in fit if j == i), key=late.get)[:3], 1)}
    assert certain and want and {(x.inc, x.cand, x["rank"]) for x in linking.referred(gates, 3).collect()} == want
