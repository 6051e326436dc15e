"""The Snowball stemmer for Spanish, after its published description, for words whose accents were dropped before."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The endings of the published algorithm, by step.
PRONOUNS = "selas selos sela selo las les los nos me se la le lo".split()
BEFORE_PRONOUN = "iendo ando ar er ir".split()
STEP_1 = {
    "delete": "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos".split(),
    "delete_ic": "adora ador acion adoras adores aciones ante antes ancia ancias".split(),
    "log": "logia logias".split(), "u": "ucion uciones".split(), "ente": "encia encias".split(), "adverb": ["amente"], "mente": ["mente"],
    "idad": "idad idades".split(), "iv": "iva ivo ivas ivos".split(),
}
STEP_2A = "ya ye yan yen yeron yendo yo yas yes yais yamos".split()
STEP_2B_GU = "en es eis emos".split()
STEP_2B = (
    "arian arias aran aras ariais aria areis ariamos aremos ara are erian erias eran eras eriais eria ereis eriamos eremos era ere irian irias iran iras iriais iria ireis "
    "iriamos iremos ira ire aba ada ida ia ara iera ad ed id ase iese aste iste an aban ian aran ieran asen iesen aron ieron ado ido ando iendo io ar er ir as abas adas idas ias "
    "aras ieras ases ieses is ais abais iais arais ierais aseis ieseis asteis isteis ados idos amos abamos iamos imos aramos ieramos iesemos asemos").split()
STEP_3 = "os a o".split()
_VOWELS = set("aeiou")


def _after_vowel_consonant(w: str, start: int) -> int:
    """The place after the first consonant that follows a vowel, from ``start`` on."""
    for i in range(start + 1, len(w)):
        if w[i] not in _VOWELS and w[i - 1] in _VOWELS:
            return i + 1
    return len(w)


def _rv(w: str) -> int:
    if len(w) < 3:
        return len(w)
    if w[1] not in _VOWELS:
        return next((i + 1 for i in range(2, len(w)) if w[i] in _VOWELS), len(w))
    if w[0] in _VOWELS:
        return next((i + 1 for i in range(2, len(w)) if w[i] not in _VOWELS), len(w))
    return 3


def _ending(w: str, endings, start: int = 0) -> str:
    """The longest of ``endings`` that ``w`` ends with, behind ``start``; empty where there is none."""
    return max((e for e in endings if w.endswith(e) and len(w) - len(e) >= start), key=len, default="")


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """The stem of a lower-case word without accents."""
    w, rv = word, _rv(word)
    r1 = _after_vowel_consonant(w, 0)
    r2 = _after_vowel_consonant(w, r1) if r1 < len(w) else len(w)
    if p := _ending(w, PRONOUNS, rv):  # attached pronouns
        base = w[: -len(p)]
        if (v := _ending(base, BEFORE_PRONOUN, rv)) or (base.endswith("uyendo") and len(base) - 5 >= rv):
            w = base if v or base.endswith("uyendo") else w
    before = w
    kind, e = max(((k, _ending(w, es)) for k, es in STEP_1.items()), key=lambda x: len(x[1]))
    at = len(w) - len(e)
    if e and kind == "adverb":
        if at >= r1:
            w = w[:at]
            for x in ("ativ", "iv", "os", "ic", "ad"):
                if w.endswith(x) and len(w) - len(x) >= r2:
                    w = w[: -len(x)]
                    break
    elif e and at >= r2:
        w = w[:at] + {"log": "log", "u": "u", "ente": "ente"}.get(kind, "")
        more = {"delete_ic": ("ic",), "mente": ("ante", "able", "ible"), "idad": ("abil", "ic", "iv"), "iv": ("at",)}.get(kind, ())
        for x in more:
            if w.endswith(x) and len(w) - len(x) >= r2:
                w = w[: -len(x)]
                break
    if w == before:
        y = _ending(w, STEP_2A, rv)
        if y and w[: -len(y)].endswith("u"):
            w = w[: -len(y)]
        else:
            e = _ending(w, [*STEP_2B, *STEP_2B_GU], rv)
            if e:
                w = w[: -len(e)]
                if e in STEP_2B_GU and w.endswith("gu"):
                    w = w[:-1]
    if e := _ending(w, STEP_3, rv):
        w = w[: -len(e)]
    elif w.endswith("e") and len(w) - 1 >= rv:
        w = w[:-1]
        if w.endswith("gu") and len(w) - 1 >= rv:
            w = w[:-1]
    return w


@F.pandas_udf(ArrayType(StringType()))
def _stems(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: None if ws is None else [stem(w) for w in ws])


def stems(words: Column) -> Column:
    """The stem of each of ``words``; Python, as no built-in stems. Hand it few words (see ``matching``)."""
    return _stems(words)
