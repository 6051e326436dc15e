"""Geography and date windows as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
CELL = 0.003
LEVELS = (1, 2, 3, 5, 6, 7)  # level 4 is unused
MAX_DAYS = 365


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between two points on the sphere."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def cell(x: Column, size: float = CELL) -> Column:
    """The grid row or column of a coordinate; floor, so that negative coordinates go down."""
    return F.floor(x / size)


def neighbours(row: Column, col: Column) -> Column:
    """array<struct<r,c>> of the 3 x 3 cells around a cell."""
    return F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.struct((row + i).alias("r"), (col + j).alias("c")))))


def geo_keys(levels: dict[int, Column], row: Column, col: Column, state: Column, probe: bool) -> Column:
    """The place keys of a record. To register: its fine ids and its cell, else its state, else the empty key.
    To probe: fine ids, the 3 x 3 cells, the state and the empty key."""
    fine = [F.when(c.isNotNull(), F.concat(F.lit(f"l{n}:"), c)) for n, c in levels.items() if n >= 3]
    here = F.when(row.isNotNull(), F.concat(F.lit("g:"), row.cast("string"), F.lit(","), col.cast("string")))
    coarse = F.when(state.isNotNull(), F.concat(F.lit("so:"), state))
    located = F.array_compact(F.array(*fine, here))
    if not probe:
        return F.when(F.size(located) > 0, located).when(coarse.isNotNull(), F.array(coarse)).otherwise(F.array(F.lit("")))
    around = F.when(row.isNotNull(), F.transform(neighbours(row, col), lambda x: F.concat(F.lit("g:"), x["r"].cast("string"), F.lit(","), x["c"].cast("string"))))
    return F.array_distinct(F.array_compact(F.concat(F.array(*fine), F.coalesce(around, F.array().cast("array<string>")), F.array(coarse, F.lit("")))))


def compatible(a: dict[int, Column], b: dict[int, Column]) -> Column:
    """The hard gate: both have ids, and all ids of one are those of the other."""
    inside = lambda x, y: reduce(lambda p, q: p & q, [x[n].isNull() | F.coalesce(x[n] == y[n], F.lit(False)) for n in x])
    some = lambda x: F.coalesce(*x.values()).isNotNull()
    return some(a) & some(b) & (inside(a, b) | inside(b, a))


def window(start: Column, end: Column, published: Column, precision: Column, least: int = 1, publication: int = 2, most: int = MAX_DAYS) -> Column:
    """struct<start,end,slack,source>: the extracted window with max(``least``, min(precision, ``most``)) days of slack, else
    the publication date with ``publication``, else none. One missing end is the other, and inverted ends are swapped."""
    s, e = F.coalesce(start, end), F.coalesce(end, start)
    slack = F.greatest(F.lit(least), F.least(F.coalesce(precision, F.lit(0)), F.lit(most)))
    none = F.lit(None)
    return (
        F.when(s.isNotNull(), F.struct(F.least(s, e).alias("start"), F.greatest(s, e).alias("end"), slack.cast("int").alias("slack"), F.lit("extracted").alias("source")))
        .when(published.isNotNull(), F.struct(published.alias("start"), published.alias("end"), F.lit(publication).alias("slack"), F.lit("publication").alias("source")))
        .otherwise(F.struct(none.cast("date").alias("start"), none.cast("date").alias("end"), none.cast("int").alias("slack"), F.lit("missing").alias("source")))
    )


def day_span(start: Column, end: Column, slack: Column, most: int = MAX_DAYS) -> Column:
    """struct<lo,hi>: the days from start - slack to end + slack, ``most`` days and one at most."""
    lo, hi = F.date_sub(F.least(start, end), slack), F.date_add(F.greatest(start, end), slack)
    return F.struct(lo.alias("lo"), F.least(hi, F.date_add(lo, most)).alias("hi"))


def day_keys(start: Column, end: Column, slack: Column, most: int = MAX_DAYS) -> Column:
    """The days of ``day_span``."""
    span = day_span(start, end, slack, most)
    return F.sequence(span["lo"], span["hi"])


def box(row: Column, col: Column, size: float = CELL) -> Column:
    """struct<lat_min,lat_max,lon_min,lon_max>: the bounds of the 3 x 3 cells around a cell."""
    return F.when(row.isNotNull() & col.isNotNull(), F.struct(((row - 1) * size).alias("lat_min"), ((row + 2) * size).alias("lat_max"), ((col - 1) * size).alias("lon_min"), ((col + 2) * size).alias("lon_max")))


def parsed_box(c: Column) -> Column:
    """array<double> of four numbers out of a text: a JSON list or numbers with commas or blanks between; null where there
    aren't four."""
    found = F.regexp_extract_all(c, F.lit(r"([-+]?\d+(?:\.\d+)?)"), F.lit(1))
    return F.when(F.size(found) == 4, F.transform(found, lambda x: x.cast("double")))


def near_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column, limit: float = 0.0035) -> Column:
    """The older test of nearness: straight distance in degrees."""
    return F.sqrt(F.pow(lat1 - lat2, 2) + F.pow(lon1 - lon2, 2)) < limit


def partition_key(level_2: Column, state: Column, canonical_level: Column, canonical_state: Column, slug: Column) -> tuple[Column, Column]:
    """(key, provenance): the geocoder's state by the catalogue or as its slug, else the written state by the catalogue,
    else the empty key."""
    has = F.coalesce(F.trim(level_2), F.lit("")) != ""
    key = F.when(has, F.coalesce(canonical_level, slug)).when(state.isNotNull() & canonical_state.isNotNull(), canonical_state).otherwise(F.lit(""))
    return key, F.when(has, "geocoder").when(state.isNotNull() & canonical_state.isNotNull(), "state_catalogue").otherwise("none")


def overlaps(a_start: Column, a_end: Column, a_slack: Column, b_start: Column, b_end: Column) -> Column:
    """Whether the windows meet, with slack on the incoming side only."""
    return (F.date_sub(a_start, a_slack) <= b_end) & (b_start <= F.date_add(a_end, a_slack))


def midpoint(start: Column, end: Column) -> Column:
    """The day in the middle."""
    return F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int"))


def band(x: Column, limits: list[float]) -> Column:
    """1 below the first limit, 2 below the second, ...; null for null."""
    out = F.lit(len(limits) + 1)
    for i in range(len(limits), 0, -1):
        out = F.when(x < limits[i - 1], i).otherwise(out)
    return F.when(x.isNotNull(), out)


def populated(*cols: Column) -> Column:
    """How many of the columns are filled."""
    return sum((c.isNotNull().cast("int") for c in cols[1:]), cols[0].isNotNull().cast("int"))
