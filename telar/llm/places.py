"""Which address records denote the same place, by probabilistic record linkage.

Addresses become components (street, number, neighbourhood, city, venue and its kind), whatever the order, abbreviation
or field they were written in. Records with equal components are one form. Forms are compared in two ways: every pair that
the rules admit, by joins on families of near values (street or venue near, city and number near, equal or missing), and
pairs that share a block: halves of the sound of street, venue or city, combined with each other or with the number. The
blocks also hold pairs that differ, and alone would lose pairs, as a letter dropped or swapped can change both halves.
Each pair of forms has a vector of agreement levels, missing values being a level of their own.
Expectation-maximization over the counts of the vectors (a bounded table: at most the product of the levels) estimates
how often each level occurs among matches and among others; the sum of log ratios is the linkage weight.

Forms linked are joined into places by spreading the smallest label, with the lineage cut at each step. Pairs of records
come from the places at the end, leaving out pairs that the rules exclude: another number, another city, or another
neighbourhood at the same street and number.

Each join on the way is written before the next one reads it (``cut``): adaptive execution plans the whole of a query
anew after every stage, which for all the joins in one query took most of the driver's memory. Sides that ``explode``
made are joined by merging, as the size that Spark estimates for them is that of the rows before, and the driver would
gather what it takes for a small table.

Defined results: records with neither street nor venue denote no place; nulls are missing values; equal records are
pairs; the smaller key comes first; empty tables give none.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.instants import let
from telar.session import cut, dropped

# Words for kinds of street, neighbourhood, number and venue, without accents or stops.
STREET = "avenida|avda|avd|ave|av|calle|cll|cl|c|calzada|calz|czda|cda|cerrada|boulevard|bulevar|blvd|blvr|boul|bvd|privada|priv|pvda|prol|prolongacion|andador|andad|and|camino|carretera|carr|circuito|cto|callejon|cjon|periferico|paseo|pso|retorno|via"
COLONIA = "colonia|col|clo|cl|barrio|bo|fraccionamiento|fracc|fracto|residencial|unidad habitacional|ejido|pueblo|pblo"
NUMBER = "numero|num|no|nro|n|ext|exterior|numm|nm"
VENUES = {
    "auditorio": "auditorio|aud|audit", "biblioteca": "biblioteca|bibl|biblio|bib", "convenciones": "centro de convenciones|c de convenciones|ctro de convenciones|cto de convenciones|centro convenciones|convenciones",
    "deportiva": "unidad deportiva|u deportiva|unid deportiva|ud deportiva|deportiva", "estadio": "estadio|est|estad", "explanada": "explanada|expl|explan", "foro": "foro|fro|f", "hospital": "hospital|hosp|hptal",
    "mercado": "mercado|mdo|merc|mcdo", "museo": "museo|mus|mseo", "parque": "parque|pque|pq|parq", "plaza": "plaza|pza|plz|plza", "salon": "salon|sln|sal", "teatro": "teatro|tto|teat|tro", "escuela": "escuela|esc",
}
LEVELS = {"street": 4, "number": 3, "colonia": 4, "city": 4, "venue": 4, "kind": 3}  # 0 missing, 1 differs, 2 near, 3 equal (number, kind: 2 equal)
TURNS = 40


def _plain(c: Column) -> Column:
    x = F.translate(F.regexp_replace(F.lower(c), r"\p{M}", ""), "áàäâãéèëêíìïîóòöôõúùüûñç", "aaaaaeeeeiiiiooooouuuunc")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^a-z0-9,()]+", " "), " +", " "))


def _none(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, " +", " ")), F.lit(""))


def _longest(c: Column) -> Column:
    return F.array_max(F.transform(F.split(c, " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]


def components(df: DataFrame, key: str) -> DataFrame:
    """(key, street, number, colonia, city, venue, kind) of every record with a street or a venue."""
    t = df.select(F.col(key), *[_plain(F.col(c)).alias(c) for c in ("calle", "numero", "colonia", "lugar", "ciudad")])
    t = t.withColumn("inner", _none(F.regexp_extract("calle", rf"(?:^|[ ,])(?:{COLONIA}) ([a-z ]+?) ?(?:,|$)", 1)))
    street = F.regexp_replace(F.col("calle"), rf"(?:^|, ?)(?:{COLONIA}) [a-z ]+", "")
    street = F.regexp_replace(street, r"\b(entre|esq|esquina|casi)\b[^,]*", "")
    street = F.regexp_replace(F.regexp_replace(street, r"[0-9]+[a-z]?\b", " "), rf"\b({STREET}|{NUMBER}|de|del|la|el|los|las)\b|[,()]", " ")
    number = F.coalesce(F.nullif(F.regexp_extract("numero", r"([0-9]+)", 1), F.lit("")), F.nullif(F.regexp_extract("calle", r"([0-9]+)", 1), F.lit("")))
    colonia = F.coalesce(_none(F.regexp_replace("colonia", rf"^({COLONIA}) |[,()]", " ")), F.col("inner"))
    city = _none(F.regexp_replace(F.regexp_replace("ciudad", r",.*$", ""), r"[()]", " "))
    kind = F.lit(None).cast("string")
    for k, words in VENUES.items():
        kind = F.when(F.col("lugar").rlike(rf"\b({words})\b"), k).otherwise(kind)
    every = "|".join(sorted((w for ws in VENUES.values() for w in ws.split("|")), key=len, reverse=True))
    venue = _none(F.regexp_replace(F.regexp_replace("lugar", rf"^(el|la|los|las) |\(|\)|,", " "), rf"\b({every})\b", " "))
    # A slip in the word for the kind, at either end, or in an article before the name.
    whole = sorted({k for name, ws in VENUES.items() for k in (name, *ws.split("|")[0].split(" ")) if len(k) > 3})
    slip = lambda w: (F.length(w) >= 4) & F.exists(F.array(*[F.lit(k) for k in whole]), lambda k: F.levenshtein(w, k) <= F.when(F.length(k) < 5, 1).otherwise(2))
    more = lambda c: F.contains(c, F.lit(" "))
    head = lambda e: let(e, lambda c: F.when(more(c) & let(F.substring_index(c, " ", 1), lambda w: (F.length(w) <= 3) | (F.col("kind").isNull() & slip(w))), F.regexp_replace(c, "^[^ ]+ ", "")).otherwise(c))
    tail = lambda e: let(e, lambda c: F.when(more(c) & F.col("kind").isNull() & F.contains("lugar", F.lit("(")) & let(F.substring_index(c, " ", -1), slip), F.regexp_replace(c, " [^ ]+$", "")).otherwise(c))
    t = t.withColumns({"kind": kind, "venue": venue}).withColumn("venue", tail(head(head(head(F.col("venue"))))))
    kind, venue = F.col("kind"), F.col("venue")
    colonia = _longest(colonia)
    out = t.select(key, _longest(_none(street)).alias("street"), F.ltrim(F.regexp_replace(number, "^0+", "")).alias("number"), colonia.alias("colonia"), city.alias("city"), venue.alias("venue"), kind.alias("kind"))
    return out.where("street IS NOT NULL OR venue IS NOT NULL")


def _sound(c: Column) -> Column:
    """A Spanish word by its sound: letters of one sound alike, doubled and silent letters once or not at all."""
    x = F.translate(F.regexp_replace(c, "qu|k", "c"), "vzxyhw ", "bssi")
    return F.regexp_replace(x, r"(.)\1+", "$1")


def _halves(c: Column) -> Column:
    def cut_in_two(s: Column) -> Column:
        n = F.ceil(F.length(s) / 2).cast("int")
        return F.array(F.concat(F.lit("<"), F.substr(s, F.lit(1), n)), F.concat(F.lit(">"), F.substr(s, n + F.when(F.length(s) % 2 == 0, 1).otherwise(0))))

    return F.when(c.isNotNull(), let(_sound(c), cut_in_two))


def _near(a: Column, b: Column) -> Column:
    """0 missing, 1 differs, 2 near, 3 equal."""
    n = F.least(F.length(a), F.length(b))
    limit = F.when(n < 5, 1).when(n < 9, 2).otherwise(3)
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 3).when(F.levenshtein(a, b, 3).between(0, limit), 2).otherwise(1)


def _flat(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 2).otherwise(1)


def _marks(c: Column) -> tuple[Column, Column]:
    """Which letters and which pairs of neighbours a value holds, as bits; an edit changes 2 bits of the first at most, 4 of the second."""
    bits = lambda size, bit: F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - size + 1)), lambda i: bit(F.substr(c, i, F.lit(size)))), F.lit(0).cast("bigint"), lambda x, y: x.bitwiseOR(y))
    shift = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))
    return bits(1, lambda x: shift(F.ascii(x) % 64)), bits(2, lambda x: shift(F.pmod(F.crc32(x.cast("binary")), F.lit(64))))


def _marked(values: DataFrame, on: list[str]) -> DataFrame:
    """The distinct values ``v`` (with ``on``) other than null, with their marks."""
    letters, pairs = _marks(F.col("v"))
    return values.select(*on, "v").where("v IS NOT NULL").distinct().select(*on, "v", letters.alias("m1"), pairs.alias("m2"))


def _near_longer(short: DataFrame, long: DataFrame, on: list[str]) -> DataFrame:
    """(on, a, b): values of ``short`` with the values of ``long`` near or equal to them that aren't shorter.

    The shorter value is cut into one segment more than the edits its length allows, so one segment is left whole in
    the longer value, shifted by no more than the edits before and after it allow; nothing near is lost. Values that
    share a segment are held against each other by their letters and pairs of letters first, which leaves few to be
    aligned.
    """
    edits = lambda n: f"CASE WHEN {n} < 5 THEN 1 WHEN {n} < 9 THEN 2 ELSE 3 END"
    first = lambda n, k, i: f"({i} * ({n} DIV ({k} + 1)) + greatest(0, {i} - ({k} + 1 - {n} % ({k} + 1))))"
    size = lambda n, k, i: f"({n} DIV ({k} + 1) + CASE WHEN {i} >= {k} + 1 - {n} % ({k} + 1) THEN 1 ELSE 0 END)"
    key = lambda part: f"xxhash64({', '.join([*on, 'n', 'i', part])}) AS part"
    same = " AND ".join(f"a_{c} = b_{c}" for c in on) or "true"
    short = short.selectExpr(*on, "v AS a", "m1 AS a1", "m2 AS a2", "length(v) AS n", f"{edits('length(v)')} AS k").selectExpr("*", "explode(sequence(0, k)) AS i")
    short = short.selectExpr(*[f"{c} AS a_{c}" for c in on], "a", "a1", "a2", "k", key(f"substring(a, CAST({first('n', 'k', 'i')} + 1 AS int), CAST({size('n', 'k', 'i')} AS int))"))
    long = long.selectExpr(*on, "v AS b", "m1 AS b1", "m2 AS b2", "explode(sequence(0, 3)) AS d").selectExpr("*", "length(b) - d AS n").where("n > 0")
    long = long.selectExpr("*", f"{edits('n')} AS k").where("d <= k").selectExpr("*", "explode(sequence(0, k)) AS i")
    long = long.selectExpr("*", f"CAST({first('n', 'k', 'i')} AS int) AS p", f"CAST({size('n', 'k', 'i')} AS int) AS z").selectExpr("*", "greatest(0, p - i, p + d - (k - i)) AS lo", "least(n + d - z, p + i, p + d + (k - i)) AS hi")
    long = long.where("lo <= hi").selectExpr(*on, "b", "b1", "b2", "n", "i", "explode(sequence(lo, hi)) AS at", "z").selectExpr(*[f"{c} AS b_{c}" for c in on], "b", "b1", "b2", key("substring(b, at + 1, z)"))
    alike = f"{same} AND bit_count(a1 ^ b1) <= 2 * k AND bit_count(a2 ^ b2) <= 4 * k AND levenshtein(a, b, k) >= 0"
    return short.hint("merge").join(long, "part").where(alike).select(*[F.col(f"a_{c}").alias(c) for c in on], "a", "b")


def near_between(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """(on, a, b): each value ``v`` of ``left`` with all values of ``right`` of the same ``on`` that ``_near`` calls near or equal."""
    x, y = cut(_marked(left, on)), cut(_marked(right, on))
    return _near_longer(x, y, on).union(_near_longer(y, x, on).select(*on, "b", "a")).distinct()


def near_values(values: DataFrame, name: str) -> DataFrame:
    """(name, near): the distinct values of ``name``, each with all that ``_near`` calls near or equal, itself included."""
    x = cut(_marked(values.select(F.col(name).alias("v")), []))
    met = _near_longer(x, x, [])
    return met.union(met.select("b", "a")).distinct().toDF(name, "near")


def families(forms: DataFrame) -> DataFrame:
    """``forms`` with ``f_street`` and ``f_city``: one name for all values of the component that chains of near values
    connect. Near values are always of one family, so that a family is a join key that loses nothing and takes one row a
    form, however many spellings it has; pairs are held against ``_near`` afterwards."""
    fields = ("street", "city")
    node = lambda f, c: F.concat(F.lit(f[0] + ":"), F.col(c))
    near = reduce(DataFrame.union, [cut(near_values(forms, f).where(F.col(f) < F.col("near")).select(node(f, f).alias("i"), node(f, "near").alias("j"))) for f in fields])
    nodes = near.select(F.col("i").alias("form")).union(near.select("j")).distinct()
    family = cut(joined(near, nodes).where("form <> place"))
    for f in fields:
        names = family.where(F.col("form").startswith(f[0] + ":")).select(F.substr("form", F.lit(3)).alias(f), F.substr("place", F.lit(3)).alias("f_" + f))
        forms = forms.join(names, f, "left").withColumn("f_" + f, F.coalesce("f_" + f, f))
    return forms


def admitted(forms: DataFrame) -> DataFrame:
    """(i, j) of all pairs with a near street or venue whose cities and numbers are near, equal or missing, i < j."""
    t = cut(families(forms.select("form", "street", "venue", "city", "number")))
    out = []
    side = lambda rows, k, p: rows.select(F.col("form").alias(k), F.col("street").alias(p), F.col("f_street"), F.col("city").alias(p + "c"), F.col("f_city"), "number")
    streets = t.where("street IS NOT NULL")
    left, right = side(streets, "i", "x"), side(streets, "j", "y")
    kept = lambda met: cut(met.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")))
    out.append(left.drop("f_city").join(right.drop("f_city"), ["f_street", "number"]).where("i < j"))
    # The number is missing in one form at least: by the city, or, where a city is missing too, by the street alone.
    loose = left.where("number IS NULL").drop("number")
    open_ = right.withColumn("even", F.col("number").isNull()).drop("number")
    once = (F.col("i") < F.col("j")) | ~F.col("even")
    out.append(loose.join(open_, ["f_street", "f_city"]).where(once))
    out.append(loose.where("xc IS NULL").drop("f_city").join(open_.drop("f_city"), "f_street").where(once & (F.col("i") != F.col("j"))))
    out.append(loose.where("xc IS NOT NULL").drop("f_city").join(open_.where("yc IS NULL").drop("f_city"), "f_street").where(F.col("i") != F.col("j")))
    fits = (_near(F.col("x"), F.col("y")) >= 2) & (_near(F.col("xc"), F.col("yc")) != 1)
    found = [kept(met.where(fits)) for met in out]
    # Venues: near ones are looked for within a family of cities; those without city among all.
    venues = t.where("venue IS NOT NULL").select("form", F.col("venue").alias("v"), "city", "f_city", "number")
    a = lambda rows: rows.select(F.col("form").alias("i"), F.col("v").alias("a"), F.col("city").alias("xc"), "f_city", F.col("number").alias("xn"))
    b = lambda rows: rows.select(F.col("form").alias("j"), F.col("v").alias("b"), F.col("city").alias("yc"), "f_city", F.col("number").alias("yn"))
    fits = (F.col("i") != F.col("j")) & ((F.col("xn") == F.col("yn")) | F.col("xn").isNull() | F.col("yn").isNull()) & (_near(F.col("xc"), F.col("yc")) != 1)
    here, nowhere = venues.where("city IS NOT NULL"), venues.where("city IS NULL")
    within = cut(near_between(here, here, ["f_city"]).where("a <= b"))
    found.append(kept(a(here).join(within, ["f_city", "a"]).join(b(here), ["f_city", "b"]).where(fits & ((F.col("a") < F.col("b")) | (F.col("i") < F.col("j"))))))
    among = cut(near_between(nowhere, venues, []))
    found.append(kept(a(nowhere).drop("f_city").join(among, "a").join(b(venues).drop("f_city"), "b").where(fits)))
    for read in (t, within, among):
        dropped(read)
    return reduce(DataFrame.union, found)


def compared(forms: DataFrame) -> DataFrame:
    """(i, j, level of each component) of the pairs of forms that the rules can admit or that share a block, i < j."""
    main = F.when(F.col("city").isNotNull(), _longest(F.col("city")))
    k = forms.withColumns({"hs": _halves(F.col("street")), "hv": _halves(_longest(F.col("venue"))), "hc": _halves(main)})
    cross = lambda tag, a, b: F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.concat_ws("|", F.lit(tag), x, y))))
    keys = F.array_distinct(F.flatten(F.array_compact(F.array(
        F.transform("hs", lambda x: F.concat(F.lit("sn|"), x, F.lit("|"), F.col("number"))),
        cross("sc", F.col("hs"), F.col("hc")), cross("vc", F.col("hv"), F.col("hc")),
        F.transform("hc", lambda x: F.concat(F.lit("cn|"), x, F.lit("|"), F.col("number"))),
        F.when(F.col("venue").isNotNull(), F.array(F.concat(F.lit("v|"), _sound(F.col("venue"))))),
    ))))
    block = k.select("form", F.explode(F.transform(F.array_compact(keys), lambda x: F.xxhash64(x))).alias("block"))  # a digest in common adds a pair to compare, no more
    met = cut(block.select(F.col("form").alias("i"), "block").hint("merge").join(block.select(F.col("form").alias("j"), "block"), "block").where("i < j").select("i", "j").distinct())
    pairs = cut(met.union(admitted(forms)).distinct())
    cols = ("street", "number", "colonia", "city", "venue", "kind")
    side = lambda name, p: forms.select(F.col("form").alias(name), *[F.col(c).alias(p + c) for c in cols])
    both = pairs.join(side("i", "a_"), "i").join(side("j", "b_"), "j")
    lv = {c: (_flat if c in ("number", "kind") else _near)(F.col(f"a_{c}"), F.col(f"b_{c}")).cast("int") for c in cols}
    return both.select("i", "j", *[e.alias(c) for c, e in lv.items()])


def weights(counts: list[tuple], turns: int = TURNS) -> tuple[float, dict[str, list[float]]]:
    """(log prior odds, log ratio of each component's levels) by expectation-maximization over the counts of vectors.

    Matches start out as mostly agreeing, others as mostly disagreeing; these starting values stay as a prior worth a
    twentieth of the pairs, 20 at least, so that few or one-sided pairs can't turn the classes round.
    """
    names = list(LEVELS)
    agree = {c: LEVELS[c] - 1 for c in names}
    m = {c: [0.3 if v == 0 else 0.01 if v == 1 else 0.55 if v == agree[c] else 0.14 for v in range(LEVELS[c])] for c in names}
    u = {c: [0.3 if v == 0 else 0.5 if v == 1 else 0.2 / (LEVELS[c] - 2) for v in range(LEVELS[c])] for c in names}
    p = 0.5
    weight = max(20.0, 0.05 * sum(n for *_, n in counts))
    pm, pu = {c: [weight * x for x in m[c]] for c in names}, {c: [weight * x for x in u[c]] for c in names}
    for _ in range(turns):
        sm, su = {c: list(pm[c]) for c in names}, {c: list(pu[c]) for c in names}
        tm = total = 0.0
        for *vector, n in counts:
            a = math.log(p) + sum(math.log(m[c][v]) for c, v in zip(names, vector))
            b = math.log(1 - p) + sum(math.log(u[c][v]) for c, v in zip(names, vector))
            g = 1 / (1 + math.exp(min(700, b - a)))
            tm, total = tm + g * n, total + n
            for c, v in zip(names, vector):
                sm[c][v] += g * n
                su[c][v] += (1 - g) * n
        p = min(0.999, max(0.001, tm / max(total, 1e-9)))
        for c in names:  # missing is a level of both classes with one rate: whether a part was written says nothing of the place
            gone = (sm[c][0] + su[c][0]) / (sum(sm[c]) + sum(su[c]))
            m[c] = [gone, *((1 - gone) * x / sum(sm[c][1:]) for x in sm[c][1:])]
            u[c] = [gone, *((1 - gone) * x / sum(su[c][1:]) for x in su[c][1:])]
    return math.log(p / (1 - p)), {c: [math.log(x / y) for x, y in zip(m[c], u[c])] for c in names}


ALLOWED = "number <> 1 AND city <> 1 AND NOT (street >= 2 AND number = 2 AND colonia = 1) AND (street >= 2 OR venue >= 2)"


def balanced(counts: list[tuple]) -> list[tuple]:
    """(vector, n) of (vector, n, whether the rules admit it), where excluded pairs weigh no more than the admitted ones.

    Excluded pairs show what others look like; how many there are says nothing of the admitted ones. A block of a city
    grows with the square of its records and the places only with their number, so that unweighted the excluded pairs
    lowered the prior and all weights as the table grew, and took true pairs that have little written.
    """
    admitted, excluded = (sum(n for *_, n, ok in counts if ok == k) for k in (True, False))
    share = min(1.0, admitted / excluded) if admitted and excluded else 1.0
    return [(*v, n if ok else n * share) for *v, n, ok in counts]


def linked(pairs: DataFrame, threshold: float = 0.0) -> DataFrame:
    """(i, j, weight) of the compared pairs whose posterior log odds are above ``threshold`` and that no rule excludes.

    The probabilities are estimated on all pairs of the blocks, as those that the rules exclude show what others look like.
    """
    names = list(LEVELS)
    rows = pairs.groupBy(*names).count().select(*names, "count", F.expr(ALLOWED)).collect()  # at most the product of the levels
    counts = balanced([tuple(r) for r in rows])
    prior, w = weights(counts) if counts else (0.0, {c: [0.0] * LEVELS[c] for c in names})
    score = F.lit(prior)
    for c in names:
        score = score + F.element_at(F.array(*[F.lit(x) for x in w[c]]), F.col(c) + 1)
    return pairs.where(ALLOWED).withColumn("weight", score).where(F.col("weight") > threshold)


def joined(links: DataFrame, forms: DataFrame) -> DataFrame:
    """(form, place): the smallest form reachable over links. It ends when no label moves; pointer jumping makes the
    turns few (about the logarithm of the longest chain)."""
    edges = cut(links.select("i", "j").unionByName(links.select(F.col("j").alias("i"), F.col("i").alias("j"))))
    label = forms.select("form", F.col("form").alias("place"))
    last, moved = None, True
    while moved:
        best = edges.join(label, edges.j == label.form).groupBy("i").agg(F.min("place").alias("near"))
        new = label.join(best, label.form == best.i, "left").select("form", F.least("place", F.coalesce("near", "place")).alias("place"), (F.coalesce("near", "place") < F.col("place")).alias("moved"))
        # pointer jumping: a form also takes the label of its label
        up = new.select(F.col("form").alias("place"), F.col("place").alias("root"))
        new = cut(new.join(up, "place", "left").select("form", F.least("place", F.coalesce("root", "place")).alias("place"), "moved"))
        moved = not new.where("moved").isEmpty()
        if last is not None:
            dropped(last)
        last, label = new, new.drop("moved")
    dropped(edges)
    return label


def same_place(df: DataFrame, key: str) -> DataFrame:
    """(a, b): two records that denote the same place, a < b."""
    cols = ("street", "number", "colonia", "city", "venue", "kind")
    # Components are of letters, digits, blanks and commas, so that the joined text is the form itself, not a digest.
    written = cut(components(df, key).withColumn("written", F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in cols])))
    forms = cut(written.groupBy("written").agg(F.min(key).alias("form"), *[F.first(c).alias(c) for c in cols]))
    recs = cut(written.select(key, "written").join(forms.select("written", "form"), "written").select(key, "form"))
    dropped(written)
    pairs = cut(compared(forms))
    place = joined(linked(pairs), forms)
    dropped(pairs)
    full = cut(forms.join(place, "form").drop("written"))
    dropped(forms)
    side = lambda p: full.select(F.col("form").alias(p), "place", *[F.col(c).alias(f"{p}_{c}") for c in cols])
    i, j = F.col("i"), F.col("j")
    fits = (_flat(F.col("i_number"), F.col("j_number")) != 1) & (_near(F.col("i_city"), F.col("j_city")) != 1) & ~(
        (_near(F.col("i_street"), F.col("j_street")) >= 2) & (_flat(F.col("i_number"), F.col("j_number")) == 2) & (_near(F.col("i_colonia"), F.col("j_colonia")) == 1))
    pairs = cut(side("i").join(side("j"), "place").where((i <= j) & ((i == j) | fits)).select("i", "j"))
    a, b = recs.select(F.col("form").alias("i"), F.col(key).alias("a")), recs.select(F.col("form").alias("j"), F.col(key).alias("b"))
    out = pairs.join(a, "i").join(b, "j").where((i != j) | (F.col("a") < F.col("b")))
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
