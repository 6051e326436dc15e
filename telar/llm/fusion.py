"""One surviving record for each group of records that describe the same thing, field by field.

Records become claims: (group, field, value, source, record), where only values that say something count (``says``).
Two rules select among the claims of a field.

* ``fused``: Bayesian fusion with copy detection. Sources have accuracies and pairs of sources a probability for each
  direction of copying, estimated in turns from each other: values shared by two sources although they are probably
  false speak for copying; a copied vote is discounted; a value's posterior follows from the remaining votes, weighted by
  the accuracies' log odds. The value of maximum posterior survives.
* ``latest``: the claim with the latest time, then the highest trust, then the lowest record key.

Claims of one source in one group and field for one value are one vote, combined before the shuffle, so that a group
that holds a third of all rows costs a row per distinct value and source. The tables of sources and of pairs of sources
are as long as the numbers of sources, and joined, not broadcast by force.

Defined results: a null group is no group; a group of one record has no survivor; a field without any claim has no row;
null trust is lowest, null time earliest; a claim without a source is a source of its own, with the starting accuracy and
no copying; ties end at the lowest record key; equal records are all members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telar.functions.instants import utc_micros
from telar.session import cut

# Texts without accents that stand for no value, or put it off.
NOTHING = (
    r"^(n ?/? ?d|n ?/? ?a|s ?/? ?d|s ?/? ?f|s ?/? ?i|n\.? ?d\.?|n\.? ?a\.?|s\.? ?d\.?|nan|null|nulo|none|nil|na|vacio|x+|sin (informacion|datos?|especificar|definir|confirmar|registro|fecha|precio|costo definido)|"
    r"no (especificad[oa]|disponible|aplica|definid[oa]|informa(do)?|se sabe|identificad[oa]|determinad[oa])|desconocid[oa]|indefinid[oa]|indeterminad[oa]|pendiente.*|tbd|tba|"
    r"por (definir|confirmar|contar|anunciar|determinar|establecer|asignar|publicar|calcular|informar|precisar|revisar)(se)?|a (confirmar|definir|convenir|determinar)|"
    r"consult(ar|e|a)( .*)?|proximamente|en breve|en (tramite|proceso de definicion)|ver .*|preguntar.*)$"
)
NEGATIVE = r"^[^0-9a-z]*[-−][^0-9a-z]*[0-9][0-9.,\s]*"


def says(value: Column) -> Column:
    """Whether a free entry says something: neither null, blank, placeholder, deferral nor negative number."""
    t = F.trim(F.regexp_replace(F.translate(F.lower(value), "áéíóúü", "aeiouu"), r"[\s ]+", " "))
    return F.coalesce(t.rlike(r"[\p{L}\p{N}]") & ~t.rlike(NOTHING) & ~t.rlike(NEGATIVE), F.lit(False))


def claims(df: DataFrame, group: str, record: str, fields: dict[str, Column], keep: list[str]) -> DataFrame:
    """(group, campo, valor, record, *keep) of every value that says something, in groups of two or more records. ``fields``
    gives each field's condition."""
    items = [F.struct(F.lit(f).alias("campo"), F.when(ok, F.col(f)).alias("valor")) for f, ok in fields.items()]
    rows = df.where(F.col(group).isNotNull())
    several = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(group)
    return rows.join(several, group, "left_semi").select(group, record, *keep, F.inline(F.array(*items))).where("valor IS NOT NULL")


def event_fields(zones: list[str]) -> dict[str, Column]:
    """The conditions of the four fields of event records."""
    return {**{f: says(F.col(f)) for f in ("estatus", "precio_inf", "afluencia")}, "fecha_fin": utc_micros(F.col("fecha_fin"), F.col("zona_horaria"), zones).isNotNull()}


def latest(df: DataFrame, group: str, record: str, fields: dict[str, Column], time: str, trust: str) -> DataFrame:
    """(group, campo, record) of each field's latest claim, of groups of two or more records; one aggregation."""
    rank = F.struct(F.col(time).alias("t"), F.nanvl(F.col(trust), F.lit(None).cast("double")).alias("c"), (-F.col(record)).alias("r"))
    rows = df.where(F.col(group).isNotNull())
    best = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.max(F.when(ok, rank)).alias(f"_{f}") for f, ok in fields.items()]).where("n > 1")
    items = [F.struct(F.lit(f).alias("campo"), (-F.col(f"_{f}.r")).alias(record)) for f in fields]
    return best.select(group, F.inline(F.array(*items))).where(F.col(record).isNotNull())


def _posteriors(votes: DataFrame, acc: DataFrame, pair: DataFrame | None, group: str, wrong: int, copying: float, accuracy: float) -> DataFrame:
    """(group, campo, v, record, posterior): the votes for each value, weighted by accuracy and discounted for copies."""
    item = [group, "campo"]
    w = votes.join(acc, "s", "left").withColumn("a", F.coalesce("a", F.lit(accuracy))).withColumn("weight", F.col("n") * F.log(F.lit(float(wrong)) * F.col("a") / (1 - F.col("a"))))
    if pair is not None:
        # A vote counts by the probability that it was copied from none of the sources that say the same.
        said = votes.where("s IS NOT NULL").select(*item, "v", F.col("s").alias("o"))
        free = votes.where("s IS NOT NULL").select(*item, "v", "s").join(pair, "s").join(said, [*item, "v", "o"]).groupBy(*item, "v", "s").agg(F.exp(F.sum(F.log1p(-F.lit(copying) * F.col("p")))).alias("free"))
        w = w.join(free, [*item, "v", "s"], "left").withColumn("weight", F.col("weight") * F.coalesce("free", F.lit(1.0)))
    score = cut(w.groupBy(*item, "v").agg(F.sum("weight").alias("score"), F.min("record").alias("record")))
    # log-sum-exp over the values of a field, with the false values nobody claims at score 0
    top = score.groupBy(*item).agg(F.greatest(F.max("score"), F.lit(0.0)).alias("m"))
    shifted = score.join(top, item)
    total = shifted.groupBy(*item).agg((F.sum(F.exp(F.col("score") - F.col("m"))) + F.greatest(F.lit(wrong + 1) - F.count(F.lit(1)), F.lit(0)) * F.exp(-F.first("m"))).alias("z"))
    return cut(shifted.join(total, item).select(*item, "v", "record", (F.exp(F.col("score") - F.col("m")) / F.col("z")).alias("posterior")))


def _copies(judged: DataFrame, acc: DataFrame, fields: int, group: str, wrong: int, copying: float, prior: float) -> DataFrame:
    """(s, o, p): the probability that source ``s`` copies ``o``, for pairs that share a probably false value.

    Only votes for values that are probably false are joined, on the value: what is true is shared by all good sources and
    says little. Each shared one speaks for copying by how much likelier it is to be copied than to be hit upon twice, given
    both accuracies; the fields on which both speak without agreeing so, whose number follows from how much each speaks,
    speak against. Either may be the copier: the three cases (s copies o, o copies s, neither) share the probability.
    """
    item = [group, "campo"]
    false = judged.where("posterior < 0.5").select(*item, "v", "s", (1 - F.col("posterior")).alias("f"))
    kf = false.join(false.select(*item, "v", F.col("s").alias("o")), [*item, "v"]).where("s < o").groupBy("s", "o").agg(F.sum("f").alias("kf"))
    spoken = judged.groupBy("s").agg(F.count(F.lit(1)).alias("n")).join(acc, "s")
    x, y = spoken.select("s", F.col("n").alias("ns"), F.col("a").alias("a")), spoken.select(F.col("s").alias("o"), F.col("n").alias("no"), F.col("a").alias("ao"))
    t = kf.join(x, "s").join(y, "o")
    c, es, eo = F.lit(copying), 1 - F.col("a"), 1 - F.col("ao")
    both = F.greatest(F.col("kf"), F.col("ns") * F.col("no") / F.lit(float(max(1, fields))))
    apart = (both - F.col("kf")) * (1 - F.col("a") * F.col("ao"))
    chance = es * eo / wrong
    odds = lambda e: F.col("kf") * F.log((c * e + (1 - c) * chance) / chance) + apart * F.log(1 - c)
    e1, e2 = (F.exp(F.greatest(F.lit(-50.0), F.least(o, F.lit(50.0)))) for o in (odds(eo), odds(es)))
    whole = (1 - 2 * prior) + prior * e1 + prior * e2
    t = t.select("s", "o", (prior * e1 / whole).alias("p1"), (prior * e2 / whole).alias("p2"))
    return t.select(F.inline(F.array(F.struct("s", "o", F.col("p1").alias("p")), F.struct(F.col("o").alias("s"), F.col("s").alias("o"), F.col("p2").alias("p"))))).where("p > 0.01")


def fused(found: DataFrame, group: str, source: str, record: str, turns: int = 30, settled: float = 0.03, wrong: int = 10, copying: float = 0.8, accuracy: float = 0.8, prior: float = 0.1) -> DataFrame:
    """(group, campo, valor, record, posterior): the value of maximum posterior of each field of each group.

    ``found`` are claims with ``source``; ``wrong`` is the number of false values a field is taken to have, ``copying`` the
    probability that a copier copies a value, ``accuracy`` the accuracy sources start with, ``prior`` the probability that
    one of two sources copies the other. It ends when no accuracy moves by more than ``settled``; that this takes more than
    ``turns`` turns is an error. Each turn goes three quarters of the way, so that accuracies and copies don't swing each other.
    """
    # Claims of no source are as many votes as there are records, in one row; those of a source are one vote.
    votes = cut(found.groupBy(group, "campo", F.lower(F.trim("valor")).alias("v"), F.col(source).alias("s")).agg(F.min(record).alias("record"), F.count(F.lit(1)).alias("n")).withColumn("n", F.when(F.col("s").isNull(), F.col("n")).otherwise(1)))
    acc = cut(votes.where("s IS NOT NULL").groupBy("s").agg(F.lit(accuracy).alias("a")))
    fields = votes.where("s IS NOT NULL").select(group, "campo").distinct().count()
    pair = None
    for _ in range(turns):
        post = _posteriors(votes, acc, pair, group, wrong, copying, accuracy)
        judged = votes.where("s IS NOT NULL").join(post.drop("record"), [group, "campo", "v"])
        new = judged.groupBy("s").agg(F.least(F.greatest(F.avg("posterior"), F.lit(0.05)), F.lit(0.95)).alias("b"))
        new = cut(acc.join(new, "s").select("s", (0.25 * F.col("a") + 0.75 * F.col("b")).alias("a"), F.abs(0.75 * (F.col("b") - F.col("a"))).alias("moved")))
        pair = cut(_copies(judged, new.drop("moved"), fields, group, wrong, copying, prior))
        moved = new.agg(F.max("moved")).first()[0]
        acc = new.drop("moved")
        if moved is None or moved <= settled:
            break
    else:
        raise RuntimeError(f"accuracies have not settled in {turns} turns")
    best = post.groupBy(group, "campo").agg(F.max(F.struct("posterior", (-F.col("record")).alias("r"), "v")).alias("b"))
    return best.select(group, "campo", F.col("b.v").alias("valor"), (-F.col("b.r")).alias(record), F.round("b.posterior", 6).alias("posterior"))
