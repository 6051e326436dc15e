"""Rule matching of articles: keywords in any order, phrases, exclusions, categories and document types.

Rules are configuration: hand-written, and at most ``MOST_RULES``. They are read by the driver and become one projection
over the articles, so that matching takes no join and no shuffle however many articles there are. Words are stemmed only
where they begin like a keyword's stem, which leaves a handful of words a text for Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from telar.functions.stem import stem, stems
from telar.functions.text import normalize_text

MOST_RULES = 10_000
#: A word and its stem have their first letters in common, as no ending begins earlier.
HEAD = 3

def prepared_rules(rules: DataFrame) -> list[Row]:
    """Enabled rules (a missing flag counts as enabled) with keywords as lists of words and phrases in normal form."""
    none = F.array().cast("array<string>")
    norm = lambda c: F.transform(F.coalesce(c, none), normalize_text)
    out = rules.where(F.coalesce("enabled", F.lit(True))).select(
        "ontology_class", F.transform(F.coalesce("kw", none), lambda k: F.split(normalize_text(k), " ")).alias("kw"), norm(F.col("phrase")).alias("phrase"), norm(F.col("not_kw")).alias("not_kw"),
        F.coalesce("categories", none).alias("categories"), F.coalesce("dismiss_categories", none).alias("dismiss_categories"), F.transform(F.coalesce("document_type", none), F.lower).alias("document_type")
    ).limit(MOST_RULES + 1).collect()
    if len(out) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return out


def _every(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _some(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def keyword_hit(keyword: list[str], found: Column) -> Column:
    """Whether all stems of a keyword are among ``found``, in any order."""
    return _every([F.array_contains(found, x) for x in sorted({stem(w) for w in keyword})])


def rule_matches(rule: Row, found: Column, norm: Column, categories: Column, document_type: Column) -> Column:
    """The predicate of a rule: all conditions that it has hold; one without conditions matches everything.

    Keywords need all their stems among the text's, in any order; phrases and exclusions are substrings of the normal form.
    """
    overlap = lambda names: F.arrays_overlap(categories, F.array(*[F.lit(x) for x in names]))
    conditions = []
    if rule.kw or rule.phrase:
        conditions.append(_some([keyword_hit(k, found) for k in rule.kw] + [F.contains(norm, F.lit(p)) for p in rule.phrase]))
    conditions += [~F.contains(norm, F.lit(p)) for p in rule.not_kw]
    if rule.categories:
        conditions.append(F.coalesce(overlap(rule.categories), F.lit(False)))
    if rule.dismiss_categories:
        conditions.append(~F.coalesce(overlap(rule.dismiss_categories), F.lit(False)))
    if rule.document_type:
        conditions.append(F.coalesce(document_type.isin(*rule.document_type), F.lit(False)))
    return _every(conditions)


def match(articles: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, ontology_class): every article (id, text, categories, document_type) with the classes of the rules it meets."""
    known = prepared_rules(rules)
    heads = sorted({w[:HEAD] for r in known for k in r.kw for w in k})
    a = articles.select("id", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), F.lower("document_type").alias("document_type"), normalize_text(F.col("text")).alias("norm"))
    if heads:
        words = F.filter(F.array_distinct(F.split("norm", " ")), lambda w: F.left(w, F.lit(HEAD)).isin(*heads))
        a = a.withColumn("found", stems(words))
    else:
        a = a.withColumn("found", F.array().cast("array<string>"))
    hits = [F.when(rule_matches(r, F.coalesce("found", F.array().cast("array<string>")), F.coalesce("norm", F.lit("")), F.col("categories"), F.col("document_type")), F.lit(r.ontology_class)) for r in known]
    classes = F.array_distinct(F.array_compact(F.array(*hits))) if hits else F.array().cast("array<string>")
    return a.select("id", F.explode(classes).alias("ontology_class"))
