"""One consistent form of texts that look the same and differ in their characters.

Most text is stable, and stays in the JVM untouched, found in two steps. A regular expression over a short list of
characters known to be stable (ASCII, composed Latin letters, common signs) passes over nearly everything; the words that
hold another character are held against the normalization quick check: the class of all characters whose NFKC quick-check
property isn't "yes" or that combine with their neighbours, computed from the Unicode data, with the invisible ones, the
kinds of space and the look-alike letters. Only these unstable segments, widened to the whole run of letters for context
(a combining mark needs its base letter, a look-alike letter the script of its word), go to Python as one array per text;
the canonical segments are then spliced between the unchanged pieces.

The form of a segment: compatibility decomposition (width, style, ligatures, encoding of accents), invisible characters
dropped, every kind of space as a blank and of hyphen as "-", look-alike letters of other scripts as Latin, and canonical
composition. Case, accents and punctuation stay. A word with Latin letters takes Latin for its look-alikes; a word of
look-alikes only (a Cyrillic "a" or "yxo") is Latin unless a word beyond doubt of such a script stands beside it.

Defined results: null stays null, the empty text empty; line breaks, tabs and repeated blanks stay; words truly of
another script stay; texts of any length work by segments.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from telar.session import cut

# Letters that look like a Latin letter or a hyphen, by script (Cyrillic, Greek, Armenian, Cherokee, Latin).
LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝӏѵАВЕЅКМНОРСТХУІЈԚԜѴӀ" "οναρικυϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ" "հոսօցՏՕ" "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ" "ɑɡⱭꞬıȷ‐‑",
    "aeopcyxijshdqwlvABESKMHOPCTXYIJQWVI" "ovapikucjABEZHIKMNOPTYXCJ" "hnuogSO" "ABCDEGHJKLMPRSTVWZ" "agAGij--", strict=True))

#: Characters that need no look: ASCII, composed Latin letters, common signs and punctuation.
_STABLE = r"\t\n\r\x20-\x7E¡¢£§©«®°±»¿À-ÖØ-öø-İĴ-ľŁ-ňŊ-žƠơƯư–—‘’‚“”„†‡•€"
#: Letters of that set and digits: the rest of a word around an unstable character.
_LETTER = r"A-Za-z0-9À-ÖØ-öø-İĴ-ľŁ-ňŊ-ž"
SEGMENT = rf"(?<![{_LETTER}])[{_LETTER}]*+[^{_STABLE}][{_LETTER}[^{_STABLE}]]*+"

# Control and format characters, fillers, joiners, variation selectors and tags.
_INVISIBLE = re.compile(
    "[\u0000-\u0008\u000b\u000c\u000e-\u001f\u007f-\u0084\u0086-\u009f\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f"
    "\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0000-\U000e0fff]")
_SPACE = re.compile("[\u00a0\u1680\u2000-\u200a\u202f\u205f\u2800\u3000]")
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
_TABLE = str.maketrans(LOOKALIKES)
_HYPHENS = str.maketrans({"‐": "-", "‑": "-"})
_SCRIPTS = r"\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}\p{IsCherokee}"


@lru_cache(maxsize=1)
def unstable() -> str:
    """The characters that need a look, as ranges of a Java character class, from the properties of the Unicode data."""
    def needs(n: int) -> bool:
        c = chr(n)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Cs", "Co") and not _INVISIBLE.match(c):
            return False
        return not unicodedata.is_normalized("NFKC", c) or kind in ("Mn", "Mc", "Me") or unicodedata.combining(c) > 0 or 0x1161 <= n <= 0x11FF or c in LOOKALIKES or bool(_INVISIBLE.match(c)) or bool(_SPACE.match(c))

    out, start = [], None
    for n in (*range(0xA0, 0xD800), *range(0xE000, 0x30000), *range(0xE0000, 0xE1000), 0x110000):
        hit = n < 0x110000 and needs(n)
        if hit and start is None:
            start = n
        elif not hit and start is not None:
            out.append(f"\\x{{{start:X}}}-\\x{{{last:X}}}")
            start = None
        last = n
    return r"\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x84\x86-\x9F" + "".join(out)


def _of_word(word: str, foreign: bool) -> str:
    if word.isascii():
        return word
    out = word.translate(_TABLE)
    latin = sum(c < "\u0250" for c in word)
    left = sum(not (c < "\u0250" or "\u0300" <= c < "\u0370") for c in out)
    if latin:  # a word of two scripts is Latin, unless more of it is beyond doubt of the other
        return out if latin > left else word
    return word if foreign or left else out


@lru_cache(maxsize=200_000)
def canonical(segment: str, foreign: bool = False) -> str:
    """The consistent form of a segment (or of a whole text); ``foreign``: a word beyond doubt of a script that has
    look-alikes stands beside it."""
    out = _INVISIBLE.sub("", segment)
    out = _SPACE.sub(" ", unicodedata.normalize("NFKD", out)) if not out.isascii() else out
    out = _INVISIBLE.sub("", out).translate(_HYPHENS)
    return unicodedata.normalize("NFC", _WORD.sub(lambda m: _of_word(m[0], foreign), out))


_BEYOND_DOUBT = re.compile(f"[\u0370-\u058f\u13a0-\u13f5]+")


def _sure(segment: str) -> bool:
    """Whether a segment holds a word (two letters at least, no lone sign such as the ohm) with a letter beyond doubt."""
    return any(len(w) > 1 and any(c not in LOOKALIKES for c in w) for w in _BEYOND_DOUBT.findall(segment))


def beside_foreign(found: list[str], gaps: list[bool]) -> list[bool]:
    """Of each segment, whether a word beyond doubt of a script that has look-alikes stands next to it, or next to a run of
    words in doubt that it is part of. ``gaps``: whether there are letters before the first segment, between, and after."""
    sure, out = [_sure(x) for x in found], [False] * len(found)
    for order, step in ((range(len(found)), 1), (range(len(found) - 1, -1, -1), -1)):
        near, last = False, False
        for i in order:
            if gaps[i if step == 1 else i + 1]:
                near = last = False
            near = last or near
            out[i] = out[i] or near
            last = sure[i]
    return out


@F.pandas_udf(ArrayType(StringType()))
def _canonical_segments(odd: pd.Series, found: pd.Series, gaps: pd.Series) -> pd.Series:
    out = []
    for segments, all_, between in zip(odd, found, gaps, strict=True):
        foreign = beside_foreign(list(all_), list(between)) if all_ is not None and segments is not None else None
        out.append(segments if segments is None else [x if x is None else canonical(x, foreign is not None and foreign[i]) for i, x in enumerate(segments)])
    return pd.Series(out)


def normalized(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the consistent form of ``text`` in ``out``: canonical segments spliced into the unchanged pieces. Each
    step is a projection of its own, so that no expression is evaluated twice."""
    t = F.col(text)
    doubt = t.rlike(f"[{_SCRIPTS}&&[^{''.join(LOOKALIKES)}]]")
    steps = df.withColumn("_some", t.rlike(f"[^{_STABLE}]"))
    steps = steps.withColumns({"_found": F.when(F.col("_some"), F.regexp_extract_all(t, F.lit(SEGMENT), F.lit(0))), "_pieces": F.when(F.col("_some"), F.split(t, SEGMENT, -1))})
    steps = steps.withColumn("_odd", F.transform("_found", lambda x: F.when(x.rlike(f"[{unstable()}]"), x)))
    # What stands beside a segment matters only in texts with letters beyond doubt of such a script.
    steps = steps.withColumns({"_odd": F.when(F.exists("_odd", lambda x: x.isNotNull()), F.col("_odd")), "_beside": F.when(F.col("_some") & doubt, F.col("_found"))})
    steps = steps.withColumn("_ready", _canonical_segments(F.col("_odd"), F.col("_beside"), F.when(F.col("_beside").isNotNull(), F.transform("_pieces", lambda x: x.rlike(r"[\p{L}\p{N}]")))))
    # Segments that need nothing stay as they are; where none needs anything, so does the text.
    whole = F.zip_with("_found", "_ready", lambda a, b: F.coalesce(b, a))
    spliced = F.array_join(F.zip_with("_pieces", whole, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return steps.withColumn(out, F.when(F.col("_ready").isNull(), t).otherwise(spliced)).drop("_some", "_found", "_pieces", "_odd", "_beside", "_ready")


def _digest(c: Column) -> Column:
    return F.unhex(F.sha2(c, 256))


def same_reading(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(campo, a, b): two rows whose field reads the same and isn't the same string, a < b.

    Rows are compared by digests of the consistent form and of the string. Equal strings are one variant: the join is
    between the variants of one form, so copies never meet each other, and only pairs that belong to the result are built.
    """
    long = df.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("campo"), F.col(f).alias("t")) for f in fields]))).where("t IS NOT NULL AND t <> ''")
    rows = cut(normalized(long, "t", "form").select(F.col(key).alias("id"), "campo", _digest(F.col("form")).alias("form"), F.md5("t").alias("own")))
    variants = rows.groupBy("campo", "form", "own").agg(F.count(F.lit(1)).alias("n"))
    left, right = variants.select("campo", "form", F.col("own").alias("x")), variants.select("campo", "form", F.col("own").alias("y"))
    pairs = left.join(right, ["campo", "form"]).where("x < y")
    a = rows.select("campo", "form", F.col("own").alias("x"), F.col("id").alias("i"))
    b = rows.select("campo", "form", F.col("own").alias("y"), F.col("id").alias("j"))
    out = pairs.join(a, ["campo", "form", "x"]).join(b, ["campo", "form", "y"])
    return out.where("i <> j").select("campo", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
