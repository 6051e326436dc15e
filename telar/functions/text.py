"""Text functions of the event graph as Column expressions. Null in, null out unless said otherwise."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from telar.functions.instants import let


@lru_cache(maxsize=2)
def _folding(form: str) -> tuple[str, str, dict[str, str]]:
    """Characters and what is left of each when it is decomposed and its marks are dropped: one for one, and one for several."""
    one, several = {}, {}
    for n in (*range(0xA0, 0xAC00), *range(0xF900, 0x10000)):
        c = chr(n)
        left = "".join(x for x in unicodedata.normalize(form, c) if unicodedata.category(x) != "Mn").lower()
        if left and left != c:
            (one if len(left) == 1 else several)[c] = left
    return "".join(one), "".join(one.values()), several


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without the marks."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(F.regexp_replace(c, r"\p{Mn}", ""), *_folding("NFD")[:2])).otherwise(c)


def normalize_text(c: Column) -> Column:
    """Lower case, accents dropped, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(strip_accents(F.lower(c)), r"\s+", " "))


def name_key(c: Column) -> Column:
    """Letters and digits of the compatibility form only: spacing, punctuation, width and accents don't tell names apart."""
    fold = _folding("NFKD")
    # Signs that stand for several letters or digits; few texts have one.
    several = {k: kept for k, v in fold[2].items() if (kept := re.sub("[^a-z0-9]", "", v))}
    signs = F.create_map(*[F.lit(y) for kv in several.items() for y in kv])
    spelled = lambda x: F.array_join(F.transform(F.split(x, ""), lambda y: F.coalesce(F.try_element_at(signs, y), y)), "")
    folded = lambda x: let(F.translate(F.regexp_replace(x, r"\p{Mn}", ""), *fold[:2]), lambda y: F.when(y.rlike("[" + "".join(several) + "]"), spelled(y)).otherwise(y))
    # Most names are ASCII and need no table.
    return F.regexp_replace(let(F.lower(c), lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), folded(x)).otherwise(x)), "[^a-z0-9]", "")


def slug(c: Column) -> Column:
    """Words of the normal form, other characters as single blanks."""
    return F.trim(F.regexp_replace(normalize_text(c), "[^a-z0-9]+", " "))


def trigrams(key: Column) -> Column:
    """The distinct 3-character pieces of a name key; a shorter key is its own piece, an empty one has none."""
    n = F.length(key)
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.substring(key, i, 3)))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(pieces)


def name_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the names' trigrams; 0 where a name is null or empty; keys under 3 characters must be equal."""
    def jaccard(x: Column, y: Column) -> Column:
        return let(F.size(F.array_intersect(x, y)), lambda n: n / (F.size(x) + F.size(y) - n))  # both hold each piece once

    def compared(k: Column) -> Column:
        ka, kb = k[0], k[1]
        short = F.least(F.length(ka), F.length(kb)) < 3
        pieces = let(F.array(trigrams(ka), trigrams(kb)), lambda t: jaccard(t[0], t[1]))
        return F.when((ka == "") | (kb == ""), 0.0).when(short, (ka == kb).cast("double")).otherwise(pieces)

    # Keys and pieces are bound, to be made once a pair.
    return let(F.array(name_key(F.coalesce(a, F.lit(""))), name_key(F.coalesce(b, F.lit("")))), compared)


def parse_list(c: Column) -> Column:
    """A list written as "a|b", "a, b" or '"a" "b"' as array<string>, without blanks."""
    quoted = F.regexp_extract_all(c, F.lit('"([^"]*)"'), F.lit(1))
    items = F.when(F.size(quoted) > 0, quoted).otherwise(F.split(c, r"[|,]"))
    return F.filter(F.transform(items, F.trim), lambda x: x != "")


def literal_list(c: Column) -> Column:
    """A text holding a JSON list as its items, any other text as a list of itself, null as an empty list."""
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(c, "array<string>"), F.array(c)))


def category_levels(c: Column) -> Column:
    """A path "A>B>C" as map level_1.. -> name, five levels at most."""
    parts = F.slice(F.filter(F.transform(F.split(c, ">"), F.trim), lambda x: x != ""), 1, 5)
    return F.map_from_entries(F.transform(parts, lambda x, i: F.struct(F.concat(F.lit("level_"), (i + 1).cast("string")), x)))


def url_host(c: Column) -> Column:
    """The host of an address, with its port; null where there is none."""
    return F.nullif(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def site_label(host: Column) -> Column:
    """The name of a site: the host without www and its endings."""
    return F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"\.(com|org|net|gob|edu|info|example)?(\.[a-z]{2})?$", "")


def is_url(c: Column) -> Column:
    """Whether a text is an address: http(s), labels of letters, digits and inner hyphens, at most 63 long, a last label of letters."""
    host = F.regexp_extract(c, r"^https?://([A-Za-z0-9.-]+)(:\d+)?(/.*)?$", 1)
    labels = F.split(host, r"\.")
    fits = F.forall(labels, lambda x: (F.length(x) <= 63) & x.rlike(r"^[A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?$"))
    return F.coalesce((host != "") & (F.size(labels) >= 2) & fits & F.element_at(labels, -1).rlike("^[A-Za-z]{2,}$"), F.lit(False))


def strip_fence(c: Column) -> Column:
    """JSON out of a Markdown fence, without commas before closing brackets."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(?:json)?\s*|\s*```$", ""), r",\s*([}\]])", "$1")


def record_hash(*cols: Column) -> Column:
    """SHA-256 of the canonical JSON of the columns; nulls are left out."""
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def named_hash(fields: dict[str, Column]) -> Column:
    """``record_hash`` with the fields in the order of their names, so that it doesn't hang on the order of arguments."""
    return record_hash(*[fields[k].alias(k) for k in sorted(fields)])


def pascal(c: Column) -> Column:
    """snake_case as PascalCase."""
    return F.array_join(F.transform(F.split(c, "_"), lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substr(x, F.lit(2)))), "")


def fixture_slug(c: Column) -> Column:
    """A name fit for a file: the normal form's letters and digits, joined by underscores."""
    return F.regexp_replace(slug(c), " ", "_")


def legacy_clean(c: Column) -> Column:
    """The older cleaning: lower case and six letters replaced, other accents left."""
    return F.translate(F.lower(c), "áéíóúñ", "aeioun")


def shortened(c: Column, most: int) -> Column:
    """The first ``most`` characters."""
    return F.left(c, F.lit(most))


def shingle_similarity(a: Column, b: Column, size: int = 3) -> Column:
    """Exact Jaccard similarity of the sets of words and of runs of ``size`` words of two texts; 0 where either is empty."""
    def pieces(c: Column) -> Column:
        w = F.filter(F.split(normalize_text(F.coalesce(c, F.lit(""))), " "), lambda x: x != "")
        runs = F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, F.lit(size)), " "))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(w, runs))

    x, y = pieces(a), pieces(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def identification_text(name: Column, description: Column) -> Column:
    """The description, with the name in brackets where it isn't part of it."""
    has = F.contains(F.lower(description), F.lower(name))
    return F.when(description.isNull() | (F.trim(description) == ""), name).when(name.isNull() | has, description).otherwise(F.concat(description, F.lit(" (nombre: "), name, F.lit(")")))


def display_name(name: Column, description: Column, kind: Column, key: Column) -> Column:
    """The name, else the description's first 120 characters, else the type, else the key."""
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(full(name), F.left(full(description), F.lit(120)), full(kind), key.cast("string"))


def human_date(d: Column) -> Column:
    """A date in Spanish words: "lunes 3 de marzo del 2026"."""
    days = F.array(*[F.lit(x) for x in "domingo lunes martes miércoles jueves viernes sábado".split()])
    months = F.array(*[F.lit(x) for x in "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()])
    return F.concat(F.element_at(days, F.dayofweek(d)), F.lit(" "), F.day(d).cast("string"), F.lit(" de "), F.element_at(months, F.month(d)), F.lit(" del "), F.year(d).cast("string"))
