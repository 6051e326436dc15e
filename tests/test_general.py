"""Instants, drifting schemas and repeated deliveries against plain Python."""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from telar.functions.instants import utc_micros, zone_ids
from telar.operators import delivery, drift


def micros(spark, rows, **kw):
    df = spark.createDataFrame(rows, "i int, v string, z string")
    return {r.i: r.u for r in df.select("i", utc_micros(F.col("v"), F.col("z"), zone_ids(spark), **kw).alias("u")).collect()}


def us(*a, zone="UTC", micro=0):
    return int(dt.datetime(*a, tzinfo=ZoneInfo(zone)).timestamp()) * 1_000_000 + micro


def test_instants_notations(spark):
    mx, ny = "America/Mexico_City", "America/New_York"
    cases = [
        ("2024-01-12", None, us(2024, 1, 12, zone=mx)), ("12/01/2024 3:05 p. m.", None, us(2024, 1, 12, 15, 5, zone=mx)), ("12/01/24", "Europe/Madrid", us(2024, 1, 12, zone="Europe/Madrid")),
        ("2024-01-12T10:00:00.123456789-05:00", None, us(2024, 1, 12, 15, micro=123456)), ("20240112T100000+0100", None, us(2024, 1, 12, 9)), ("1705053600", None, us(2024, 1, 12, 10)), ("1705053600123", None, us(2024, 1, 12, 10, micro=123000)),
        ("1705053600.5", None, us(2024, 1, 12, 10, micro=500000)), ("Fri, 12 Jan 2024 10:00:00 GMT", None, us(2024, 1, 12, 10)), ("viernes 12 de enero de 2024, 10:00 horas", None, us(2024, 1, 12, 10, zone=mx)),
        ("Jan 12, 2024 12:30 AM EST", None, us(2024, 1, 12, 5, 30)), ("2024-01-12 10:00:00 America/New_York", mx, us(2024, 1, 12, 10, zone=ny)), ("12-ene-2024 10:00", "no/zone", us(2024, 1, 12, 10, zone=mx)),
        ("31/02/2024", None, None), ("2024-01-12T25:00:00", None, None), ("13/13/2024", None, None), ("", None, None), ("  ", None, None), (None, None, None), ("por confirmar", None, None), ("0000-00-00", None, None), ("2024-01-12 10:00 Foo/Bar", None, None), ("12/01/2024 13:00 PM", None, None), ("x" * 50_000, None, None),
    ]
    got = micros(spark, [(i, v, z) for i, (v, z, _) in enumerate(cases)])
    assert {i: got[i] for i in got} == {i: u for i, (_, _, u) in enumerate(cases)}


def test_instants_policies(spark):
    twice, skipped = "2024-11-03 01:30:00", "2024-03-10 02:30:00"
    rows = [(0, twice, "America/New_York"), (1, skipped, "America/New_York")]
    assert micros(spark, rows) == {0: us(2024, 11, 3, 5, 30), 1: us(2024, 3, 10, 7, 30)}
    assert micros(spark, rows, ambiguous="second", nonexistent="null") == {0: us(2024, 11, 3, 6, 30), 1: None}
    assert micros(spark, rows, ambiguous="null")[0] is None
    with pytest.raises(ValueError):
        utc_micros(F.lit(""), None, [], ambiguous="maybe")


def test_quotient_is_invertible_and_exact(spark):
    ids = ["", "a", "A", "a ", "é", "abcdefgh", "abcdefgh\x00", "abcdefghi", "x" * 5000, None, "a"]
    df = spark.createDataFrame([(i, v, i // 2) for i, v in enumerate(ids)], "k bigint, v string, t int")
    q, low, rest = delivery.quotient(F.col("v"))
    assert [r.v for r in df.select("k", delivery.restore(q, low, rest).alias("v")).orderBy("k").collect()] == ids
    assert [r.k for r in delivery.repeats(df, "v", ["t", "k"]).collect()] == [10]
    assert sorted(r.k for r in delivery.once(df, "v", ["t", "k"]).collect()) == list(range(10))
    assert delivery.repeats(df.limit(0), "v", ["t", "k"]).count() == 0
    members = spark.createDataFrame([(1, ["a", "b", None]), (1, ["a"]), (2, []), (3, None), (None, ["c", "c"])], "e bigint, s array<string>")
    assert [tuple(r) for r in delivery.repeated_members(members, "e", "s").collect()] == [(1, "a")]


LINES = [
    (1, '{"_id":"1","text":"uno","n":1}'), (1, '{"_id":"2","text":"dos","n":null,"message":{"a":1}}'), (1, '{"_id":"3","text":'),
    (2, '{"_id":"1","cuerpo":"uno","n":"1"}'), (2, '{"_id":"2","cuerpo":"dos","message":{"b":1}}'), (2, None),
    (4, '{"_id":"9","cuerpo":"x","extra":true}'), (5, "[1]"),
]


def test_drift_changes_and_rescue(spark):
    raw = spark.createDataFrame([("f", s, p, i) for i, (s, p) in enumerate(LINES)], "feed string, file_seq bigint, payload string, text int")
    ing = drift.ingest(raw)
    got = {tuple(r) for r in drift.changes(ing).collect()}
    assert got == {
        ("f", 2, "renamed", "text", "cuerpo"), ("f", 2, "type", "n", "n"), ("f", 2, "renamed", "message.a", "message.b"),
        ("f", 4, "removed", "n", ""), ("f", 4, "removed", "message", ""), ("f", 4, "added", "", "extra"),
        ("f", 5, "removed", "_id", ""), ("f", 5, "removed", "cuerpo", ""), ("f", 5, "removed", "extra", ""),
    }
    rows = drift.replay(ing).where("_readable").select("_source.text", F.col("text").alias("t"), "_rescued").collect()
    assert [r.t for r in rows] == ["uno", "dos", "uno", "dos", "x"] and '"extra":true' in rows[-1]._rescued
    assert ing.where("NOT _readable").count() == 3 and drift.changes(drift.ingest(raw.limit(0))).count() == 0
