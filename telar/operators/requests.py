"""Corpus selection: a rule row compiled to a request, a request to a predicate, and requests run over documents.

A request is a plain dictionary, so that it can be stored and shown: ``doctype``, ``period`` ([start, end] or a letter),
``keywords`` and ``phrases`` (a text, a list, or a tree of AND, OR, NOT), ``categories`` (level -> names), ``bounding_box``
([lon_min, lat_min, lon_max, lat_max]), ``cvegeo`` (place ids), ``location_type``, ``topic_id``, ``sort``, ``page_size``,
``page_number``. Predicates are built-in expressions on the documents' columns, which reach the scan where they can.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.text import normalize_text

#: Days of the period letters.
PERIODS = {"d": 1, "w": 7, "m": 30, "y": 365}


def _items(text: str | None, split: str) -> list[str]:
    return [x.strip() for x in (text or "").split(split) if x.strip()]


def _quoted(text: str | None) -> list[str]:
    return re.findall(r'"([^"]+)"', text or "") or _items(text, ",")


def category_levels(paths: list[str]) -> dict[str, list[str]]:
    """Paths "A>B>C" as {"level_1": [A], ...}, five levels at most, names once."""
    out: dict[str, list[str]] = {}
    for path in paths:
        for n, name in enumerate(_items(path, ">")[:5], 1):
            if name not in out.setdefault(f"level_{n}", []):
                out[f"level_{n}"].append(name)
    return out


def box(text: str | None) -> list[float]:
    """Four numbers of a text, [] where there aren't four."""
    try:
        flat = json.loads(text or "")
        flat = [y for x in flat for y in (x if isinstance(x, list) else [x])]
    except (ValueError, TypeError):
        flat = [float(x) for x in re.findall(r"-?\d+(?:\.\d+)?", text or "")]
    return [float(x) for x in flat] if len(flat) == 4 else []


def compiled(rule: dict, default_type: str = "news", default_period: str = "w", size: int = 1000) -> dict:
    """The request of a rule row (kw, phrase, not, categories, document_type, period, bbox, cvegeo), all texts."""
    some = lambda xs: {"OR": xs} if len(xs) > 1 else xs
    kw, ph, no = _quoted(rule.get("kw")), _quoted(rule.get("phrase")), _quoted(rule.get("not"))
    words = some(kw) if not no else {"AND": [some(kw), {"NOT": {"OR": no}}]} if kw else {"NOT": {"OR": no}}
    out = {
        "doctype": ([x.lower() for x in _items(rule.get("document_type"), ",")] or [default_type])[0], "period": (rule.get("period") or "").strip() or default_period,
        "keywords": words, "phrases": some(ph), "sort": "date_created", "page_size": size,
    }
    if levels := category_levels(_items(rule.get("categories"), "|")):
        out["categories"] = levels
    if corners := box(rule.get("bbox")):
        out |= {"bounding_box": corners, "geo_filter": True}
    if places := _items(rule.get("cvegeo"), ","):
        out["cvegeo"] = places
    if "cvegeo" in out or "bounding_box" in out:
        out["location_type"] = rule.get("location_type") or "mentioned"
    return out


def tree(node, leaf) -> Column | None:
    """A text, list (all of it) or AND/OR/NOT tree as a predicate; None where it says nothing."""
    if isinstance(node, str):
        return leaf(node)
    if isinstance(node, list):
        node = {"AND": node}
    parts = []
    for op, kids in node.items():
        found = [c for k in (kids if isinstance(kids, list) else [kids]) if (c := tree(k, leaf)) is not None]
        if found:
            joined = reduce((lambda a, b: a & b) if op == "AND" else (lambda a, b: a | b), found)
            parts.append(~joined if op == "NOT" else joined)
    return reduce(lambda a, b: a & b, parts) if parts else None


def mentions_place(locations: Column, ids: list[str], least_precision: int = 0) -> Column:
    """Whether one and the same location has an id among ``ids`` (with or without leading underscores) and a precision of at
    least ``least_precision``."""
    plain = [x.lstrip("_") for x in ids]
    return F.coalesce(F.exists(locations, lambda x: F.ltrim(x["level_2_id"], F.lit("_")).isin(*plain) & (F.coalesce(x["precision_level"].try_cast("int"), F.lit(0)) >= least_precision)), F.lit(False))


def wanted(locations: Column, categories: Column, ids: list[str], least_precision: int = 3, dismissed: str = "deportes") -> Column:
    """The producer's filter: a precise enough location in one of the places, and not of the dismissed category."""
    return mentions_place(locations, ids, least_precision) & ~F.coalesce(F.array_contains(F.transform(categories, F.lower), dismissed), F.lit(False))


def predicate(request: dict, columns: list[str], text: str = "text", now: Column | None = None) -> Column:
    """The predicate of a request over documents with ``text`` and, as far as ``columns`` has them, doctype, published_at,
    categories (map level -> names), lat, lon, locations_mentioned and topic_id. Words are matched whole, phrases as substrings,
    both in normal form."""
    norm = normalize_text(F.coalesce(F.col(text), F.lit("")))
    word = lambda w: F.concat(F.lit(" "), F.regexp_replace(norm, r"[^\p{L}\p{N}]+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), normalize_text(F.lit(w)), F.lit(" ")))
    phrase = lambda p: norm.contains(normalize_text(F.lit(p)))
    both = [c for c in (tree(request.get("keywords") or [], word), tree(request.get("phrases") or [], phrase)) if c is not None]
    out = [reduce(lambda a, b: a & b, both)] if both else []
    if request.get("doctype") and "doctype" in columns:
        out.append(F.lower("doctype") == request["doctype"].lower())
    if "published_at" in columns and request.get("period"):
        p = request["period"]
        if isinstance(p, list):
            out.append((F.col("published_at") >= F.lit(p[0]).cast("timestamp")) & (F.col("published_at") <= F.lit(p[1]).cast("timestamp")))
        elif p in PERIODS:
            last = now if now is not None else F.current_timestamp()
            out.append((F.col("published_at") > last - F.make_interval(days=F.lit(PERIODS[p]))) & (F.col("published_at") <= last))
    if request.get("categories") and "categories" in columns:
        out += [F.coalesce(F.arrays_overlap(F.try_element_at("categories", F.lit(k)), F.array(*[F.lit(x) for x in v])), F.lit(False)) for k, v in request["categories"].items()]
    if request.get("bounding_box") and {"lat", "lon"} <= set(columns):
        x0, y0, x1, y1 = request["bounding_box"]
        out.append(F.col("lon").between(min(x0, x1), max(x0, x1)) & F.col("lat").between(min(y0, y1), max(y0, y1)))
    if request.get("cvegeo") and "locations_mentioned" in columns:
        out.append(mentions_place(F.col("locations_mentioned"), request["cvegeo"]))
    if request.get("topic_id") and "topic_id" in columns:
        out.append(F.col("topic_id").isin(*request["topic_id"]))
    return reduce(lambda a, b: a & b, out) if out else F.lit(True)


def fetched(docs: DataFrame, request: dict, fields: list[str], key: str, text: str = "text") -> DataFrame:
    """One page of the documents of a request: ``fields``, in the order of its ``sort`` (a column; the key decides ties)."""
    t = docs.where(predicate(request, docs.columns, text))
    if request.get("sort") in docs.columns:
        t = t.orderBy(F.col(request["sort"]).asc_nulls_last(), key)
    if size := request.get("page_size"):
        t = t.offset(size * request.get("page_number", 0)).limit(size)
    return t.select(*fields)


def fetched_by_rules(docs: DataFrame, requests: list[dict], key: str, extra: Column | None = None, text: str = "text") -> DataFrame:
    """The documents that any request wants (and ``extra`` admits), each once, with ``request``, the number of the first that does.

    One pass over the documents, whatever the number of requests; nothing is merged afterwards."""
    hit = F.coalesce(*[F.when(predicate(r, docs.columns, text), F.lit(i)) for i, r in enumerate(requests)], F.lit(-1))
    t = docs.where(extra) if extra is not None else docs
    return t.withColumn("request", hit).where("request >= 0")


def rules_of(rules: DataFrame, types: DataFrame, supertype: str) -> DataFrame:
    """The rules of the classes of a supertype."""
    return rules.join(types.where(F.col("supertype") == supertype).select(F.col("event_type").alias("ontology_class")), "ontology_class", "left_semi")


def products(words: DataFrame, bounds: DataFrame, places: DataFrame) -> DataFrame:
    """Every keyword with every bound and place: the one product that is the feature, of three lists written by hand. Built by
    exploding the two shorter lists in each row of the first, whose rows stay where they are."""
    lists = [t.agg(F.collect_list(F.struct(*t.columns)).alias(n)) for t, n in ((bounds, "_b"), (places, "_p"))]
    t = words.withColumn("_k", F.lit(1))
    for x in lists:
        t = t.join(x.withColumn("_k", F.lit(1)), "_k")
    return t.withColumn("_b", F.explode("_b")).withColumn("_p", F.explode("_p")).select(*words.columns, "_b.*", "_p.*")
