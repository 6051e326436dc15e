"""Free-form date texts to one instant in UTC, as Column expressions only.

An ordered cascade of anchored patterns rewrites each notation to ``Y|M|D|h|m|s|f|ap|zone``; the parts are then
checked strictly and resolved against the zone. Nothing leaves whole-stage Catalyst evaluation.

Defined results:
* null, empty, blank, placeholder or relative texts ("N/D", "por confirmar") give null;
* an impossible date, time, zone name or offset gives null;
* a date alone is its first midnight; two-digit years are 20xx; day comes before month unless the year leads or the
  month is a word; a weekday name is ignored;
* digits finer than microseconds are cut off;
* a value without zone takes ``zone`` (a column of the row), or ``default_zone`` where that is null or no known zone;
* ``ambiguous``: a local time that occurs twice means the ``first`` or the ``second`` instant, or ``null``;
* ``nonexistent``: a local time that the clock skips moves ``forward`` by the gap, or gives ``null``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Mexico_City"

# Month words of Spanish and English, without accents.
MONTHS = {
    1: "enero ene january jan", 2: "febrero feb february", 3: "marzo mar march", 4: "abril abr april apr",
    5: "mayo may", 6: "junio jun june", 7: "julio jul july", 8: "agosto ago august aug",
    9: "septiembre setiembre sep sept set september", 10: "octubre oct october", 11: "noviembre nov november",
    12: "diciembre dic december dec",
}
# Zone abbreviations with their offset in minutes (North American).
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}

_T = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?"
_AP = r"(?: ?([aApP])\.? ?[mM]\.?)?"
_H = r"(?: ?(?:[hH]oras|[hH]rs?\.?|[hH]s?\.?))?"
_Z = r"(Z|z|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5}|[A-Z][A-Za-z_]+(?:/[A-Za-z_+\-0-9]+){1,2})"
_W = r"(?:[A-Za-zÁÉÍÓÚáéíóúñ]{2,10}\.?,? )?"
_M = r"([A-Za-z]{3,10})\.?"
_Y = r"(\d{4}|\d{2})"

#: (name, pattern, rewriting) in order of precedence; the first pattern that matches the whole text decides.
CASCADE = [
    ("iso", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}})(?:[Tt ] ?{_T}{_AP})?(?: ?{_Z})?(?:\[([^\]]+)\])?$", "$1|$3|$4|$5|$6|$7|$8|$9|$10|$11"),
    ("basic", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt](\d{{2}})(\d{{2}})(?:(\d{{2}})(?:[.,](\d{{1,12}}))?)?(?: ?{_Z})?(?:\[([^\]]+)\])?)?$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    ("day_first", rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2{_Y}(?:[Tt,]? ?{_T}{_AP}{_H})?(?: {_Z})?$", "$4|$3|$1|$5|$6|$7|$8|$9|$10|"),
    ("day_word", rf"^{_W}(\d{{1,2}})(?:[-/. ]| de ){_M}(?:[-/. ]|,? del? |, ){_Y}(?:,? (?:a las )?{_T}{_AP}{_H})?(?: {_Z})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|"),
    ("word_day", rf"^{_W}{_M} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})(?:,? (?:at )?{_T}{_AP}{_H})?(?: {_Z})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|"),
]
#: Seconds, milliseconds, microseconds and nanoseconds since 1970, by their number of digits.
EPOCH = r"^(\d{10})(?:(\d{3})(\d{3})?(\d{3})?|\.(\d{1,12}))?$"


def zone_ids(spark: SparkSession) -> list[str]:
    """The zone names the JVM knows (a fixed few hundred)."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())


def _plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\s\u00A0\u1680\u2000-\u200B\u202F\u205F\u3000\uFEFF]+", " "))


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with ``value`` computed once (a lambda variable), so that nested use doesn't multiply the expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _int(c: Column) -> Column:
    return F.when(F.length(c) > 0, c.cast("int"))


def _month(c: Column) -> Column:
    words = [F.lit(x) for m, ws in MONTHS.items() for w in ws.split() for x in (w, m)]
    return F.when(c.rlike(r"^\d"), c.cast("int")).otherwise(F.try_element_at(F.create_map(*words), F.lower(c)))


def _resolve(local: Column, zone: Column, ambiguous: str, nonexistent: str) -> Column:
    """The instant of a local time (held as if it were UTC) in a named zone, after the policies."""
    first = F.to_utc_timestamp(local, zone)
    out = first
    if ambiguous != "first":
        later = [first + F.expr(f"INTERVAL {m} MINUTES") for m in (30, 60, 120)]
        second = reduce(lambda acc, t: F.when(F.from_utc_timestamp(t, zone) == local, t).otherwise(acc), reversed(later), F.lit(None).cast("timestamp"))
        out = F.coalesce(second, first) if ambiguous == "second" else F.when(second.isNull(), first)
    if nonexistent == "null":
        out = F.when(F.from_utc_timestamp(first, zone) == local, out)
    return out


def parts(x: Column) -> Column:
    """The rewritten parts of a plain date text as array<string> (year, month, day, hour, minute, second, fraction, am/pm, zone, bracketed zone), or null."""
    canon = F.lit(None).cast("string")
    for _, pattern, rewriting in reversed(CASCADE):
        canon = F.when(x.rlike(pattern), F.regexp_replace(x, pattern, rewriting)).otherwise(canon)
    return F.split(canon, r"\|", -1)


def _civil(p: Column, zone: Column | None, zones: list[str], default_zone: str, ambiguous: str, nonexistent: str) -> Column:
    at = lambda i: F.try_element_at(p, F.lit(i))
    year = F.when(F.length(at(1)) == 2, _int(at(1)) + 2000).otherwise(_int(at(1)))
    ap = F.lower(at(8))
    hour = let(_int(at(4)), lambda h: F.when(F.length(ap) == 0, F.coalesce(h, F.lit(0))).when(h.between(1, 12), h % 12 + F.when(ap == "p", 12).otherwise(0)))
    second = let(F.coalesce(_int(at(6)), F.lit(0)), lambda t: F.when(t < 60, t).cast("decimal(16,6)"))
    micro = F.rpad(F.substring(at(7), 1, 6), 6, "0").cast("int")
    local = F.try_make_timestamp(year, _month(at(2)), _int(at(3)), hour, F.coalesce(_int(at(5)), F.lit(0)), second, F.lit("UTC"))

    own = F.coalesce(zone, F.lit(default_zone)) if zone is not None else F.lit(default_zone)
    known = F.when(own.isin(zones), own).otherwise(F.lit(default_zone))
    z = F.coalesce(F.nullif(at(9), F.lit("")), F.nullif(at(10), F.lit("")), F.lit(""))
    minutes = lambda z: F.substring(z, 2, 2).cast("int") * 60 + F.coalesce(_int(F.regexp_extract(z, r"^[+-]\d{2}:?(\d{2})$", 1)), F.lit(0))
    signed = lambda z: let(minutes(z), lambda m: F.when((m <= 14 * 60) & (F.coalesce(_int(F.regexp_extract(z, r"^[+-]\d{2}:?(\d{2})$", 1)), F.lit(0)) < 60), F.when(z.startswith("-"), -m).otherwise(m)))
    table = F.create_map(*[F.lit(v) for kv in ABBREVIATIONS.items() for v in kv])
    offset = lambda z: F.when(z.rlike(r"^[+-]\d"), signed(z)).when(F.length(z) > 0, F.try_element_at(table, F.upper(z)))
    named = lambda z: F.when(F.length(z) == 0, known).when(z.isin(zones), z)
    instant = lambda t, z, o: F.when(o.isNotNull(), F.unix_micros(t) - o.cast("long") * 60_000_000).otherwise(F.unix_micros(_resolve(t, named(z), ambiguous, nonexistent)))
    return let(local, lambda t: F.when(t.isNotNull(), let(z, lambda z: let(offset(z), lambda o: instant(t, z, o))))) + micro


def utc_micros(text: Column, zone: Column | None, zones: list[str], default_zone: str = DEFAULT_ZONE, ambiguous: str = "first", nonexistent: str = "forward") -> Column:
    """Microseconds since 1970-01-01 UTC of the instant that ``text`` names, or null."""
    if ambiguous not in ("first", "second", "null") or nonexistent not in ("forward", "null"):
        raise ValueError("ambiguous is first, second or null; nonexistent is forward or null")

    def epoch(x: Column) -> Column:
        g = lambda i: F.regexp_extract(x, EPOCH, i)
        return g(1).cast("long") * 1_000_000 + F.rpad(F.substring(F.concat(g(2), g(3), g(4), g(5)), 1, 6), 6, "0").cast("long")

    civil = lambda x: let(parts(x), lambda p: F.when(p.isNotNull(), _civil(p, zone, zones, default_zone, ambiguous, nonexistent)))
    return F.when(text.rlike(r"\d"), let(_plain(text), lambda x: F.when(x.rlike(EPOCH), epoch(x)).otherwise(civil(x))))
