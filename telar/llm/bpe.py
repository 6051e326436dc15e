"""Encoding of a whole corpus by a byte-level BPE vocabulary, with Spark's higher-order functions.

A text is split by the vocabulary's pattern. The distinct words of the corpus are counted (combined in each task before
the shuffle, which carries distinct words only), and the most frequent are folded once: a word's bytes are an array of
pieces, and each step of ``aggregate`` joins the adjacent pair of lowest rank, leftmost first. They become a literal of
the plan: two arrays addressed by a hash of the word, where each word has two places (a cuckoo table), so that a lookup is
a hash and two comparisons. Words outside that table are folded in their texts, each once a text. Words go back in order.
Texts are never shuffled: the work follows the scan's splits.

The vocabulary's ranks are a literal too: an array of buckets, each a text of pieces (their bytes in hex) with ranks.

Words longer than ``LONG`` bytes, where the fold's quadratic cost would show, are merged over a heap in an Arrow UDF
with the same result; the UDF is in the plan only where the counts hold such a word.

Defined results: null and empty texts have an empty list; strings that look like special tokens are ordinary text;
texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import json
import os
import zlib
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from telar.session import cut

VOCABULARY = os.environ.get("TELAR_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"
#: The vocabulary's pattern (a fixed value), with Java's names for letters, numbers and white space; letters, the most
#: frequent, are tried first, as no other branch begins like them.
PATTERN = r" ?\p{L}++|'(?:[stmd]|re|ve|ll)| ?\p{N}++| ?[^\p{IsWhite_Space}\p{L}\p{N}]++|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
BUCKETS = 1 << 16
#: Bytes of a word up to which it is folded by higher-order functions.
LONG = 48
#: Words that are folded once for the whole corpus and then known by a literal of the plan.
FREQUENT = 1 << 15


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def _literal(entries: dict[str, str]) -> Column:
    """A hash table as a literal: one text per bucket, ";key=value;key=value;". Texts are cheap to ship with a task; maps aren't."""
    out: list[list[str]] = [[] for _ in range(BUCKETS)]
    for key, value in entries.items():
        out[zlib.crc32(key.encode()) % BUCKETS].append(f"{key}={value};")
    return F.split(F.lit("\n".join(";" + "".join(x) if x else "" for x in out)), "\n")


@lru_cache(maxsize=4)
def _pieces(path: str) -> dict[str, str]:
    return {piece.hex().upper(): str(rank) for piece, rank in ranks(path).items()}


def _find(table: Column, key: Column) -> Column:
    """The value of ``key`` in a literal table, or null."""
    return _let(F.element_at(table, (F.crc32(key.cast("binary")) % BUCKETS + 1).cast("int")), lambda bucket: _let(
        F.instr(bucket, F.concat(F.lit(";"), key, F.lit("="))), lambda p: F.when(p > 0, F.substring_index(F.substr(bucket, p + F.length(key) + 2), ";", 1))))


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


@lru_cache(maxsize=100_000)
def _merged(word: bytes, path: str) -> tuple[int, ...]:
    """The ids of a word: pairs of lowest rank join first, over a heap and a linked list."""
    table = ranks(path)
    pieces: list[bytes | None] = [bytes([b]) for b in word]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(r, i, word[i : i + 2]) for i in range(len(word) - 1) if (r := table.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if pieces[i] is None or j >= len(word) or pieces[i] + pieces[j] != joined:
            continue
        pieces[i], pieces[j] = joined, None
        after[i] = after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < len(word) and (r := table.get(pieces[a] + pieces[after[a]])) is not None:
                heapq.heappush(heap, (r, a, pieces[a] + pieces[after[a]]))
    return tuple(table[p] for p in pieces if p is not None)


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))


class _Table:
    """Words with their ids as literal arrays, each word in one of the two places that its hash names."""

    def __init__(self, words: dict[str, list[int]]):
        bits = 10
        while (slots := self._placed(words, bits)) is None:
            bits += 1
        self._mask = (1 << bits) - 1
        self._keys = F.from_json(F.lit(json.dumps([w or "" for w in slots], ensure_ascii=False)), "array<string>")
        self._ids = F.from_json(F.lit(json.dumps([words[w] if w else [] for w in slots])), "array<array<int>>")

    @staticmethod
    def _placed(words: dict[str, list[int]], bits: int) -> list[str | None] | None:
        """The word of each place, or None where they don't fit: a word that finds its place taken moves the other to its second."""
        if len(words) > 0.4 * (1 << bits):
            return None
        slots: list[str | None] = [None] * (1 << bits)
        mask = len(slots) - 1
        for word in words:
            at = xxhash.xxh64_intdigest(word.encode(), 42) & mask
            for _ in range(500):
                word, slots[at] = slots[at], word
                if word is None:
                    break
                h = xxhash.xxh64_intdigest(word.encode(), 42)
                at = (h >> 24) & mask if at == h & mask else h & mask
            else:
                return None
        return slots

    def ids(self, words: Column) -> Column:
        """The ids of each of ``words``, null where the table lacks it."""

        def look(w: Column, h: Column) -> Column:
            one, two = (x.bitwiseAND(F.lit(self._mask)).cast("int") for x in (h, F.shiftright(h, 24)))
            return F.when(F.get(self._keys, one) == w, F.get(self._ids, one)).when(F.get(self._keys, two) == w, F.get(self._ids, two))

        return F.zip_with(words, F.transform(words, lambda w: F.xxhash64(w)), look)


def _fold(table: Column, h: Column) -> Column:
    """The ids of a word, given as hex bytes: ranked merges folded over the array of its pieces."""
    rank = lambda piece: _find(table, piece).cast("int")

    def step(acc: Column, _: Column) -> Column:
        p = acc["p"]
        joins = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p)), lambda a, b: rank(F.concat(a, b)))
        join = lambda i: F.struct(F.concat(F.slice(p, F.lit(1), i - 1), F.array(F.concat(F.element_at(p, i), F.element_at(p, i + 1))), F.slice(p, i + 2, F.size(p))).alias("p"), F.lit(False).alias("done"))
        merged = _let(joins, lambda rs: _let(F.array_min(rs), lambda m: F.when(m.isNull(), F.struct(p.alias("p"), F.lit(True).alias("done"))).otherwise(_let(F.array_position(rs, m).cast("int"), join))))
        return F.when(acc["done"] | (F.size(p) < 2), acc).otherwise(merged)

    n = (F.length(h) / 2).cast("int")
    start = F.struct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(h, i * 2 - 1, 2)).alias("p"), F.lit(False).alias("done"))
    return F.transform(F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), n)), start, step)["p"], rank)


def _short_plans(spark: SparkSession, most: int = 200_000) -> None:
    """Keeps the literals out of the plans' descriptions, which the driver stores for every query."""
    if int(spark.conf.get("spark.sql.maxPlanStringLength", str(2**31 - 16))) > most:
        spark.conf.set("spark.sql.maxPlanStringLength", str(most))


def frequent(df: DataFrame, text: str, path: str = VOCABULARY, long: int = LONG, most: int = FREQUENT) -> tuple[dict[str, list[int]], bool]:
    """The ids of the ``most`` frequent words of the corpus, and whether it has words of over ``long`` bytes.

    All words are counted; the bound only says how many are folded once here, and the rest are folded in their texts.
    """
    spark, pieces = df.sparkSession, _pieces(path)
    words = cut(df.select(F.explode(_words(F.col(text))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    top = [w for (w,) in words.where(F.octet_length("w") <= long).orderBy(F.desc("n"), "w").limit(most).select("w").collect()]
    hexed = {w: w.encode().hex().upper() for w in top}
    rows = spark.createDataFrame([(w, h) for w, h in hexed.items() if h not in pieces], "w string, h string").repartition(spark.sparkContext.defaultParallelism)
    folded = dict(rows.select("w", _let(_literal(pieces), lambda t: _let(F.col("h"), lambda h: _fold(t, h))).alias("ids")).collect())
    return {w: list(folded[w]) if w in folded else [int(pieces[h])] for w, h in hexed.items()}, not words.where(F.octet_length("w") > long).isEmpty()


def encoded(df: DataFrame, text: str, out: str = "ids", path: str = VOCABULARY, long: int = LONG, most: int = FREQUENT) -> DataFrame:
    """``df`` with the ids of ``text`` in ``out`` (array<int>, never null)."""

    @F.pandas_udf(ArrayType(ArrayType(IntegerType())))
    def merge_long(words: pd.Series) -> pd.Series:
        return words.map(lambda ws: None if ws is None else [list(_merged(w.encode(), path)) for w in ws])

    _short_plans(df.sparkSession)
    known, any_long = frequent(df, text, path, long, most)
    table, pieces = _Table(known), _literal(_pieces(path))
    long_ones = lambda w: F.array_distinct(F.filter(w, lambda x: F.octet_length(x) > long))
    rows = df
    if any_long:  # only texts with a run of as many characters of one class can hold one
        run = "{%d}" % max(1, (long - 1) // 4)
        maybe = F.col(text).rlike(rf"\p{{L}}{run}|\p{{N}}{run}|[^\p{{IsWhite_Space}}\p{{L}}\p{{N}}]{run}|\p{{IsWhite_Space}}{run}")
        rows = df.withColumn("_long", merge_long(F.when(maybe, long_ones(_words(F.col(text))))))

    # w: the words; r: the ids of the known ones; u: the others, each once. Bound by lambdas, to be evaluated once a text.
    place = lambda a, w: F.nullif(F.array_position(a, w).cast("int"), F.lit(0))

    def rest(w: Column, r: Column) -> Column:
        fold = lambda x: F.when(F.octet_length(x) <= long, _let(F.hex(F.encode(x, "UTF-8")), lambda h: _fold(pieces, h)))
        merged = lambda x: F.try_element_at("_long", place(long_ones(w), x)) if any_long else F.lit(None).cast("array<int>")
        others = F.array_distinct(F.filter(w, lambda x, i: F.get(r, i).isNull()))
        return _let(others, lambda u: _let(F.transform(u, fold), lambda f: F.flatten(F.transform(w, lambda x, i: F.coalesce(F.get(r, i), F.try_element_at(f, place(u, x)), merged(x))))))

    ids = _let(_words(F.col(text)), lambda w: _let(table.ids(w), lambda r: F.when(F.exists(r, lambda x: x.isNull()), rest(w, r)).otherwise(F.flatten(r))))
    return rows.withColumn(out, ids).drop("_long")


def decoded(ids: Column, path: str = VOCABULARY) -> Column:
    """The text of ``ids``: the pieces' bytes concatenated."""
    table = ranks(path)
    pieces = [""] * (max(table.values()) + 1)
    for p, r in table.items():
        pieces[r] = p.hex().upper()
    literal = F.split(F.lit(",".join(pieces)), ",")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(literal, i + 1)), "")), "UTF-8")


def check_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> int:
    """The number of ranks in the vocabulary file."""
    return len(ranks(path))
