"""Free-entered values mapped to the closest entry of a reference list, with the unmatched reported. SQL functions only.

The distinct values of a field are brought to plain words (lower case, no accents, no punctuation) and, as alternative
readings, relieved of what people add ("en X", "X, México", "edo. de X"). A reading that is a name, alias or code is
that entry. The rest goes through a pigeonhole join: every reference string is cut into k+1 segments, so that a reading
within k edits holds one of them unchanged, shifted by k places at most; an equality join on (segment, substring) finds
these candidates, the built-in ``levenshtein`` verifies them, and the nearest entry wins. Then abbreviations are read
word by word. What has no entry is reported with -1 through an anti-join.

Defined results: null and blank values and values that are an entry's name character by character are not listed; a
reading equally near to two entries has none (-1); repeated values are mapped once; an empty list gives -1 throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.session import cut

# Names in use that the list's aliases leave out.
SYNONYMS = {
    "Ciudad de México": "distrito federal|df|mexico df|cd mx|mexico city",
    "Estado de México": "edomex|edo mex|estado mexico|mexico estado de",
    "Querétaro": "queretaro de arteaga", "Coahuila": "coahuila de zaragoza", "Michoacán": "michoacan de ocampo", "Veracruz": "veracruz de ignacio de la llave|veracruz llave",
    "Hidalgo": "hgo", "Baja California": "baja california norte", "Puebla": "puebla de zaragoza", "Oaxaca": "oaxaca de juarez",
    "México": "estados unidos mexicanos|republica mexicana|mexique|mexico|mejico|mx|rep mexicana",
    "Estados Unidos": "usa|u s a|us|u s|united states|united states of america|estados unidos de america|estados unidos de norteamerica|eeuu|ee uu|e e u u|norteamerica eua|eu",
    "Reino Unido": "united kingdom|great britain|inglaterra y gales|gbr|u k", "Brasil": "brazil", "Alemania": "deu", "Países Bajos": "nld|netherlands", "Corea del Sur": "kor|republica de corea",
    "Francia": "fra", "Italia": "ita", "Japón": "jpn", "China": "chn", "Suiza": "che", "Suecia": "swe", "Austria": "aut", "Australia": "aus", "Portugal": "prt", "España": "esp",
    "Ecuador": "ecu", "Costa Rica": "cri", "Panamá": "pan", "Honduras": "hnd", "El Salvador": "slv", "Nicaragua": "nic", "Cuba": "cub", "República Dominicana": "dom", "Venezuela": "ven",
    "Bolivia": "bol", "Paraguay": "pry", "Uruguay": "ury", "Estados Unidos de América": "estados unidos",
}

#: Edits that a reading may have against a reference string, by the string's length.
SHORT, LONG, LENGTH = 2, 4, 8


def plain(c: Column) -> Column:
    """Lower case words without accents or punctuation."""
    x = F.translate(F.regexp_replace(F.lower(c), r"\p{M}", ""), "áàäâãåéèëêíìïîóòöôõúùüûñç", "aaaaaaeeeeiiiiooooouuuunc")
    return F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))


def _letters(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def reference(ref: DataFrame) -> DataFrame:
    """(clase, ref_id, s, w): every plain string that means an entry: name (w 0), alias (1), code or synonym (2)."""
    names = ref.select("clase", "ref_id", F.inline(F.concat(
        F.array(F.struct(F.col("nombre").alias("v"), F.lit(0).alias("w")), F.struct(F.col("clave").alias("v"), F.lit(2).alias("w"))),
        F.transform(F.coalesce("alias", F.array()), lambda a: F.struct(a.alias("v"), F.lit(1).alias("w"))))))
    more = F.create_map(*[F.lit(x) for kv in SYNONYMS.items() for x in kv])
    extra = ref.select("clase", "ref_id", F.explode(F.split(F.try_element_at(more, F.col("nombre")), r"\|")).alias("v"), F.lit(2).alias("w"))
    # Two-letter codes of states without the country prefix, too.
    return names.unionByName(extra).select("clase", "ref_id", plain(F.col("v")).alias("s"), "w").where("s <> ''").groupBy("clase", "ref_id", "s").agg(F.min("w").alias("w"))


def _readings(v: Column, clase: Column) -> Column:
    """array<struct<p,f>>: the plain value and its relieved forms, in order of trust."""
    p = plain(v)
    # A code counts as added only in brackets: two letters at the end may be all that is left of a word.
    tail = F.regexp_replace(plain(F.regexp_replace(v, r"\([A-Za-z]{2,3}\)\s*$", "")), r" (mexico|mex|mx|estado|edo|pais|republica mexicana)$", "")
    head = F.regexp_replace(p, r"^(en el|en la|en|edo de|edo|estado de|estado libre y soberano de|el estado de|republica de|reino de) ", "")
    both = F.regexp_replace(tail, r"^(en el|en la|en|edo de|edo|estado de|republica de|reino de) ", "")
    return F.array(*[F.struct(F.lit(i).alias("p"), f.alias("f")) for i, f in ((0, p), (1, tail), (1, head), (2, both))])


def mapped(values: DataFrame, ref: DataFrame) -> DataFrame:
    """(clase, v, ref_id): ``values`` (clase, v; distinct) each with the entry meant, or -1."""
    # Distinct values and what is found for them are small and used by every later step: each is written once.
    strings, values = cut(reference(ref)), cut(values)
    forms = values.select("clase", "v", F.inline(_readings(F.col("v"), F.col("clase")))).where("f <> ''").groupBy("clase", "v", "f").agg(F.min("p").alias("p"))
    forms = cut(forms)

    exact = forms.join(strings.withColumnRenamed("s", "f"), ["clase", "f"]).groupBy("clase", "v").agg(
        F.min(F.struct("p", "w")).alias("best"), F.collect_set(F.struct("p", "w", "ref_id")).alias("all"))
    exact = exact.select("clase", "v", F.array_distinct(F.transform(F.filter("all", lambda x: (x["p"] == F.col("best.p")) & (x["w"] == F.col("best.w"))), lambda x: x["ref_id"])).alias("ids"))
    exact = cut(exact)

    open_ = cut(forms.join(exact, ["clase", "v"], "left_anti").where(F.length("f") >= 3))
    k = F.when(F.length("s") < LENGTH, SHORT).otherwise(LONG)
    n, size = k + 1, F.floor(F.length("s") / (k + 1)).cast("int")
    # Segments 0..k of the string, the last with the remainder; (start, length) from its own length alone.
    cutting = strings.where((F.length("s") >= 4) & (F.col("w") < 2) | (F.length("s") >= 9)).select("clase", "ref_id", "s", "w", n.alias("n"), size.alias("z"))
    segments = cutting.select("clase", "ref_id", "s", "w", "n", F.posexplode(F.expr("transform(sequence(0, n - 1), i -> substring(s, i * z + 1, if(i = n - 1, length(s), z)))")).alias("i", "seg")).withColumn("len", F.length("s"))
    lens = cutting.select("clase", F.length("s").alias("len"), "n", "z").distinct()
    probes = open_.join(lens, "clase").where(F.abs(F.length("f") - F.col("len")) <= F.col("n") - 1).select("clase", "v", "f", "p", "len", F.explode(F.expr(
        """flatten(transform(sequence(0, n - 1), i -> transform(sequence(greatest(1, i * z + 1 - (n - 1)), i * z + 1 + (n - 1)),
           a -> struct(i AS i, substring(f, a, if(i = n - 1, len - i * z, z)) AS seg))))""")).alias("q")).select("clase", "v", "f", "p", "len", "q.i", "q.seg").distinct()
    candidates = probes.join(segments, ["clase", "len", "i", "seg"]).select("clase", "v", "f", "p", "ref_id", "s", "w").distinct()

    # One slip is allowed in short strings, two in long ones. A swap of neighbours is two edits to levenshtein and none to
    # the sorted letters, which tells it from other edits.
    d, moved = F.levenshtein("f", "s"), F.levenshtein(_letters(F.col("f")), _letters(F.col("s")))
    near = F.expr(f"CASE WHEN length(s) < {LENGTH} THEN d <= 1 OR (d = 2 AND moved = 0) ELSE d <= 2 OR (d = 3 AND moved <= 2) OR (d = 4 AND moved = 0) END")
    fuzzy = candidates.select("*", d.alias("d"), moved.alias("moved")).where(near)
    fuzzy = fuzzy.groupBy("clase", "v", "ref_id").agg(F.min(F.struct("d", "p")).alias("c"))
    fuzzy = fuzzy.groupBy("clase", "v").agg(F.min("c.d").alias("d"), F.collect_set(F.struct("c.d", "ref_id")).alias("all"))
    fuzzy = fuzzy.select("clase", "v", "d", F.transform(F.filter("all", lambda x: x["d"] == F.col("d")), lambda x: x["ref_id"]).alias("ids"))
    fuzzy = cut(fuzzy.select("clase", "v", "d", "ids"))

    # Abbreviated words: as many words, each a beginning or a skeleton of the name's word. Letters left out of words are an
    # abbreviation sooner than two slips towards another string ("cd de mexico" isn't "edo de mexico").
    words = lambda c: F.filter(F.split(c, " "), lambda x: ~x.isin("de", "del", "la", "el"))
    rest = open_.join(fuzzy.where("d < 2"), ["clase", "v"], "left_anti").select("clase", "v", "f", words(F.col("f")).alias("a")).withColumns({"m": F.size("a"), "first": F.substring(F.element_at("a", 1), 1, 1)}).where("m >= 2")
    full = strings.where("w = 0").select("clase", "ref_id", words(F.col("s")).alias("b")).withColumns({"m": F.size("b"), "first": F.substring(F.element_at("b", 1), 1, 1)})
    skeleton = lambda x, y: (F.length(x) < F.length(y)) & F.rlike(y, F.concat(F.lit("^"), F.regexp_replace(x, "(.)", "$1.*"))) | (x == y)
    short = rest.join(full, ["clase", "m", "first"]).where(F.forall(F.zip_with("a", "b", skeleton), lambda x: x))
    short = short.groupBy("clase", "v").agg(F.collect_set("ref_id").alias("ids"))

    one = lambda t: t.where(F.size("ids") == 1).select("clase", "v", F.element_at("ids", 1).alias("ref_id"))
    short = cut(one(short))
    hit = cut(one(exact).unionByName(short).unionByName(one(fuzzy).join(short, ["clase", "v"], "left_anti")))
    return hit.unionByName(values.select("clase", "v").join(hit, ["clase", "v"], "left_anti").select("clase", "v", F.lit(-1).cast("bigint").alias("ref_id")))


def found(events: DataFrame, ref: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(campo, key, ref_id) of every value that isn't null, blank or a name of its class character by character."""
    long = events.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("clase"), F.col(f).alias("v")) for f in fields]))).where(F.col("v").isNotNull() & (F.length(F.regexp_replace("v", r"[\s\u00A0\u2000-\u200B\u202F\u205F\u3000\uFEFF]", "")) > 0))
    values = long.groupBy("clase", "v").agg(F.count(F.lit(1)).alias("n"))
    values = values.join(ref.select("clase", F.col("nombre").alias("v")), ["clase", "v"], "left_anti")
    return long.join(mapped(values, ref), ["clase", "v"]).select(F.col("clase").alias("campo"), key, "ref_id")
