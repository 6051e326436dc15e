"""Reports and the older analyses: pivots, model comparisons, tiers, place-prefix linking, near vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a place id that name levels 3, 5 and 7.
PREFIXES = {7: 26, 5: 17, 3: 9}


def model_comparison(documents: DataFrame, calls: DataFrame) -> DataFrame:
    """Per model: documents, records, seconds, their mean and errors, with mean and longest call (1 digit)."""
    d = documents.groupBy("model").agg(F.count("source_id").alias("docs"), F.sum("n_records").alias("total_records"), F.round(F.sum("llm_s"), 1).alias("total_llm_s"), F.round(F.avg("llm_s"), 1).alias("mean_llm_s_per_doc"), F.count_if(F.col("error").isNotNull()).alias("errors"))
    c = calls.groupBy("model").agg(F.round(F.avg("seconds"), 1).alias("mean_call_s"), F.round(F.max("seconds"), 1).alias("max_call_s"))
    return d.join(c, "model", "left")


def overridden(rows: DataFrame, key: str, base: DataFrame, manual: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``value`` of the manual table where it has the key, else of the base table."""
    return rows.join(base.select(key, F.col(value).alias("_b")), key, "left").join(manual.select(key, F.col(value).alias("_m")), key, "left").withColumn(value, F.coalesce("_m", "_b")).drop("_b", "_m")


def not_in_topics(news: DataFrame, topics: DataFrame, key: str) -> DataFrame:
    """News that aren't in topics already, and the topics' own."""
    return topics.unionByName(news.join(topics.select(key), key, "left_anti"))


def prefix_links(events: DataFrame, key: str = "id", geoid: str = "geoid", lo: str = "start", hi: str = "end", bucket: int = 32) -> DataFrame:
    """(id, match, level): for each event the earlier ones (smaller id) that share a day and the place prefix of the finest
    level, 7 before 5 before 3, at which it finds any. Buckets of days are the join key, days are compared after."""
    number = lambda d: F.floor(F.unix_date(d) / bucket).cast("int")
    t = events.where(F.col(lo).isNotNull() & F.col(geoid).isNotNull()).select(F.col(key).alias("k"), F.col(geoid).alias("g"), F.least(lo, hi).alias("lo"), F.greatest(lo, hi).alias("hi"))
    levels = F.array_compact(F.array(*[F.when(F.length("g") >= n, F.struct(F.lit(lv).alias("level"), F.left("g", F.lit(n)).alias("p"))) for lv, n in PREFIXES.items()]))
    t = t.select("k", "lo", "hi", F.inline(levels)).withColumn("bucket", F.explode(F.sequence(number(F.col("lo")), number(F.col("hi")))))
    a = t.select("level", "p", "bucket", F.col("k").alias("id"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    b = t.select("level", "p", "bucket", F.col("k").alias("match"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    met = a.join(b, ["level", "p", "bucket"]).where("match < id AND a_lo <= b_hi AND b_lo <= a_hi").groupBy("id", "match").agg(F.max("level").alias("level"))
    best = met.groupBy("id").agg(F.max("level").alias("level"))
    return met.join(best, ["id", "level"]).select("id", "match", "level")


def plausible(start: Column, geoid: Column, precision: Column, years: tuple[int, int] = (2010, 2030), least: int = 3) -> Column:
    """The older filter: a year strictly between, a place id, and enough precision."""
    return F.coalesce((F.year(start) > years[0]) & (F.year(start) < years[1]) & geoid.isNotNull() & (precision >= least), F.lit(False))


def relevant(relevance: Column, sentence: Column, category: Column, dismissed: tuple[str, ...] = (), least: int = 2, length: int = 150) -> Column:
    """Relevance and sentence length reached, and no dismissed word within the category."""
    out = (relevance >= least) & (F.length(sentence) >= length)
    for d in dismissed:
        out = out & ~F.coalesce(F.contains(F.lower(category), F.lit(d)), F.lit(False))
    return F.coalesce(out, F.lit(False))


def by_date_text(df: DataFrame, date: str, key: str, limit: int | None = None) -> DataFrame:
    """Sorted by the date as text, missing ones first, ties by key; the first ``limit`` where given."""
    t = df.orderBy(F.coalesce(F.col(date).cast("string"), F.lit("")), key)
    return t.limit(limit) if limit is not None else t


def located_rows(df: DataFrame, locations: str) -> DataFrame:
    """A row per location of a list, one with null where there is none."""
    return df.withColumn(locations, F.explode_outer(locations))


def unit(v: Column) -> Column:
    """A vector of length 1 in double precision; null for the zero vector."""
    d = F.transform(v, lambda x: x.cast("double"))
    z = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(z > 0, F.transform(d, lambda x: x / z))


def nearest(queries: DataFrame, df: DataFrame, key: str, vector: str, count: int) -> DataFrame:
    """(a, b, rank, cosine): the ``count`` nearest of all rows to each of a stated set of queries, exact. The queries are read
    in one block (they are a set of stated size, at most 10,000); each row is held against the block in an Arrow batch, and
    every task keeps ``count`` rows a query before the shuffle."""
    rows = queries.select(key, vector).where(F.col(vector).isNotNull()).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 queries")
    ids, q = [r[0] for r in rows], np.array([r[1] for r in rows], dtype="float64")
    q = q / np.linalg.norm(q, axis=1, keepdims=True) if len(rows) else q

    def block(batches):
        best: pd.DataFrame | None = None
        for b in batches:
            if not len(b) or not ids:
                continue
            m = np.array(b[vector].tolist(), dtype="float64")
            c = q @ (m / np.linalg.norm(m, axis=1, keepdims=True)).T
            new = pd.DataFrame({"a": np.repeat(ids, len(b)), "b": np.tile(b[key].to_numpy(), len(ids)), "cosine": c.ravel().round(9)})
            best = pd.concat([best, new[new["a"] != new["b"]]]) if best is not None else new[new["a"] != new["b"]]
            best = best.sort_values(["a", "cosine", "b"], ascending=[True, False, True]).groupby("a").head(count)
        if best is not None:
            yield best

    kind = dict(df.dtypes)[key]
    found = df.select(key, vector).where(F.col(vector).isNotNull()).mapInPandas(block, f"a {kind}, b {kind}, cosine double")
    w = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count).select("a", "b", "rank", "cosine")


def near_vectors(df: DataFrame, key: str, vector: str, least: float = 0.9, tables: int = 24, bits: int = 8, seed: int = 7) -> DataFrame:
    """(a, b, cosine): pairs of cosine ``least`` or more that share a bucket of one of ``tables`` random-plane hashes of ``bits``
    signs each, a < b. Candidates come by equi-joins only. At cosine 0.9 two vectors differ in one plane's sign with probability
    0.144, so a table of 8 keeps 29 % of the pairs and 24 tables all but 0.03 %."""
    @F.pandas_udf("array<bigint>")
    def codes(vectors: pd.Series) -> pd.Series:
        def code(v):
            planes = np.random.default_rng(seed).standard_normal((tables * bits, len(v[0])))
            signs = (np.asarray(v, dtype="float64") @ planes.T >= 0).reshape(len(v), tables, bits)
            return (np.arange(tables) << bits) + signs @ (1 << np.arange(bits))

        out: list = [None] * len(vectors)
        for n, at in vectors.map(len).groupby(vectors.map(len)).groups.items():  # vectors of other lengths have planes of their own
            for i, c in zip(at, code(vectors.loc[at].tolist()), strict=True):
                out[vectors.index.get_loc(i)] = c.tolist()
        return pd.Series(out)

    t = df.select(F.col(key).alias("k"), unit(F.col(vector)).alias("u")).where("u IS NOT NULL")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda p, q: p + q)
    b = t.select("k", F.explode(codes("u")).alias("bucket"))
    met = b.select(F.col("k").alias("a"), "bucket").join(b.select(F.col("k").alias("b"), "bucket"), "bucket").where("a < b").select("a", "b").distinct()
    u = lambda n: t.select(F.col("k").alias(n), F.col("u").alias(n + "_u"))
    return met.join(u("a"), "a").join(u("b"), "b").select("a", "b", dot(F.col("a_u"), F.col("b_u")).alias("cosine")).where(F.col("cosine") >= least)
