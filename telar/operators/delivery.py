"""Exact removal of repeated deliveries by quotient hash tables.

An identifier is laid out in fixed width (its length, then its UTF-8 bytes in 8-byte words), and one Feistel round
permutes it: the first word is XORed with a hash of the rest. The permutation is invertible, so (quotient, remainder)
is the identifier itself: the quotient, the top bits of the permuted word, names a shard; the remainder, the other bits
with the rest, is stored completely. Equal remainders in a shard are equal identifiers, with no false match, and
identifiers that resemble each other spread over the shards. Each shard's table is a hash aggregation that keeps the
first delivery, combined before the shuffle, so that an identifier that holds a third of all rows costs one table row
per map task.

Defined results:
* a null identifier identifies nothing: such rows are all kept and never reported;
* the empty text is an identifier; upper and lower case, blanks and Unicode forms differ;
* deliveries are ordered by ``order`` (nulls first), ties included by naming a unique key last; rows that repeat the
  whole order are one delivery;
* empty tables give empty results; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the quotient. Shards, not tasks: Spark spreads them over its partitions.
QUOTIENT_BITS = 16


def _word(hex8: Column) -> Column:
    """16 hex digits as a signed 64-bit word."""
    hi, lo = F.conv(F.substring(hex8, 1, 8), 16, 10).cast("bigint"), F.conv(F.substring(hex8, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(hi, 32).bitwiseOR(lo)


def quotient(identifier: Column, bits: int = QUOTIENT_BITS) -> tuple[Column, Column, Column]:
    """(shard, remainder of the first word, the rest): together the identifier, invertibly permuted."""
    b = F.encode(identifier, "UTF-8")
    head = _word(F.rpad(F.hex(F.substring(b, 1, 8)), 16, "0"))
    rest = F.concat(F.lpad(F.hex(F.octet_length(b)), 8, "0"), F.hex(F.substring(b, 9, 2**31 - 1)))
    mixed = head.bitwiseXOR(F.xxhash64(rest))
    return F.shiftrightunsigned(mixed, 64 - bits), mixed.bitwiseAND(F.lit((1 << (64 - bits)) - 1)), F.unhex(rest)


def restore(shard: Column, low: Column, rest: Column, bits: int = QUOTIENT_BITS) -> Column:
    """The identifier of a table row; the inverse of ``quotient``."""
    mixed = F.shiftleft(shard, 64 - bits).bitwiseOR(low)
    head = F.lpad(F.hex(mixed.bitwiseXOR(F.xxhash64(F.hex(rest)))), 16, "0")
    length = F.conv(F.hex(F.substring(rest, 1, 4)), 16, 10).cast("int")
    body = F.concat(head, F.hex(F.substring(rest, 5, 2**31 - 1)))
    # Up to 8 bytes all of the identifier is in the first word, padded on the right.
    return F.decode(F.unhex(body.substr(F.lit(1), length * 2)), "UTF-8")


def _tabled(df: DataFrame, identifier: Column) -> DataFrame:
    q, low, rest = quotient(identifier)
    return df.withColumns({"_q": q, "_low": low, "_rest": rest})


def first_deliveries(df: DataFrame, identifier: str, order: list[str]) -> DataFrame:
    """One row per identifier other than null: its table row and ``_first``, the struct of ``order`` of its first delivery, and ``_n``."""
    rows = _tabled(df.where(F.col(identifier).isNotNull()).select(identifier, *[c for c in order if c != identifier]), F.col(identifier))
    return rows.groupBy("_q", "_low", "_rest").agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n"))


def repeats(df: DataFrame, identifier: str, order: list[str]) -> DataFrame:
    """The deliveries of ``df`` whose identifier came before. The last of ``order`` is the unique key of a delivery."""
    key = order[-1]
    firsts = first_deliveries(df, identifier, order).select(F.col(f"_first.{key}").alias(key))
    return df.where(F.col(identifier).isNotNull()).join(firsts, key, "left_anti")


def once(df: DataFrame, identifier: str, order: list[str]) -> DataFrame:
    """``df`` with exactly one delivery of each identifier, the first; rows without identifier stay."""
    key = order[-1]
    firsts = first_deliveries(df, identifier, order).select(F.col(f"_first.{key}").alias(key))
    known = df.where(F.col(identifier).isNotNull()).dropDuplicates([key]).join(firsts, key, "left_semi")
    return known.unionByName(df.where(F.col(identifier).isNull()))


def repeated_members(df: DataFrame, holder: str, members: str) -> DataFrame:
    """(holder, source_id): each member that occurs more than once in all arrays of one holder; null holders and members count for nothing."""
    rows = df.where(F.col(holder).isNotNull()).select(F.col(holder), F.explode(members).alias("source_id")).where("source_id IS NOT NULL")
    table = _tabled(rows, F.col("source_id")).groupBy(holder, "_q", "_low", "_rest").agg(F.count(F.lit(1)).alias("_n"))
    return table.where("_n > 1").select(holder, restore(F.col("_q"), F.col("_low"), F.col("_rest")).alias("source_id"))


def members_once(df: DataFrame, holder: str, members: str) -> DataFrame:
    """(holder, source_id): each member of a holder once."""
    rows = df.where(F.col(holder).isNotNull()).select(F.col(holder), F.explode(members).alias("source_id")).where("source_id IS NOT NULL")
    table = _tabled(rows, F.col("source_id")).groupBy(holder, "_q", "_low", "_rest").agg(F.count(F.lit(1)).alias("_n"))
    return table.select(holder, restore(F.col("_q"), F.col("_low"), F.col("_rest")).alias("source_id"))
