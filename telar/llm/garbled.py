"""Texts decoded with the wrong character encoding: found, and restored where possible.

A hidden Markov model labels the characters beyond ASCII (which no encoding pair changes) with one clean state, one
state per encoding pair and one for lost characters. A pair's state explains a character by what it was before the
damage: the emission compares the probability of the restored character, between its neighbours, with that of the
character as it stands. States of UTF-8 read as something else take whole sequences, lead character with its
continuations, as one unit; such a sequence hardly ever occurs by chance. Viterbi finds the labels; each labelled span
gets its state's inverse transform. Text damaged repeatedly is labelled again until nothing changes.

The probabilities are trained on the corpus itself: all characters beyond ASCII of all documents are counted with the
symbols of both neighbours, combined in each task before the shuffle. The symbols are a fixed alphabet (letters without
accents, and classes) and only characters that some encoding pair can yield or restore are told apart, so the table that
goes to every task is bounded by the alphabets, not by the corpus. As the corpus holds damage too, the rate of each single-
byte pair is estimated over all contexts, and counts that the rates explain are taken out (``separated``); the clean
rest gives the emissions, the rates the costs of entering a state.

A text whose characters could not pay for entering any state, even all gains added, is clean without Viterbi; that
bound is exact.

Defined results: null and empty texts and texts in ASCII are clean; U+FFFD is always damage, and stays; texts of any
length are labelled whole; repeated rows are judged alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Encodings that UTF-8 was read as; ``sequences`` of C2..F4 leads.
UTF8_AS = ("cp1252", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "cp1253", "iso8859_15")
#: (written in, read as) of single-byte pairs.
BYTE_AS = (
    ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "cp1251"), ("cp1252", "iso8859_7"), ("cp1252", "cp1250"), ("cp1252", "latin_1"),
    ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"),
    ("utf-8", "stripped"),  # UTF-8 read as cp1252 that lost its soft hyphen: the lead of an accented i stands alone
)
#: Log probabilities: of entering a UTF-8 state, of leaving a state, of a UTF-8 sequence by chance, of what a state can't explain.
ENTER_UTF8, LEAVE, CHANCE, NEVER = -4.0, -1.0, -13.8, -40.0
#: Bounds of the estimated log probabilities of entering a single-byte state.
ENTER_BYTE = (-10.0, -5.0)
#: Damage comes by documents and their copies: how many times its mean a count may be.
BURST = 3.0
OTHER = "\U0010ffff"

_TRIPLES = re.compile(r"(?=(.[^\x00-\x7f].))", re.S)


@lru_cache(maxsize=None)
def _decoder(codec: str) -> list[str]:
    """The character of each byte; bytes without one stand for the control character of their number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(maxsize=None)
def _bytes_of(codec: str) -> dict[str, int]:
    table = {c: b for b, c in enumerate(_decoder(codec)) if b > 127}
    return {chr(b): b for b in range(128, 160)} | table  # controls pass through lenient decoders


@lru_cache(maxsize=None)
def _units(codec: str) -> re.Pattern:
    d = _bytes_of(codec)
    cls = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in d.items() if lo <= b <= hi) + "]"
    t = cls(0x80, 0xBF)
    return re.compile(f"{cls(0xC2, 0xDF)}{t}|{cls(0xE0, 0xEF)}{t}{{2}}|{cls(0xF0, 0xF4)}{t}{{3}}")


@lru_cache(maxsize=None)
def _inverse(pair: tuple[str, str]) -> dict[str, str]:
    """What a character was before it was read wrongly; only where it changed."""
    if pair[1] == "stripped":
        return {"Ã": "í"}
    written, read = _decoder(pair[0]), _decoder(pair[1])
    return {read[b]: written[b] for b in range(128, 256) if read[b] != written[b] and ord(read[b]) > 127}


@lru_cache(maxsize=None)
def _known() -> frozenset:
    """The characters that some encoding pair yields or restores."""
    out = {c for codec in UTF8_AS for c in _decoder(codec)} | set("\u00a0áéíóúüñ")
    for pair in BYTE_AS:
        inv = _inverse(pair)
        out |= set(inv) | set(inv.values())
    return frozenset(c for c in out | set(map(chr, range(0x80, 0x250))) if c > "\x7f")


@lru_cache(maxsize=None)
def _symbol(c: str) -> str:
    """A neighbour by its symbol: a letter without accent, or the class of other characters."""
    if c == "\0":
        return "^"
    if c < "\x80":
        return c if c.isalpha() else "0" if c.isdigit() else " " if c.isspace() else "."
    if c.isalpha():
        base = unicodedata.normalize("NFD", c)[0]
        return base if base < "\x80" else "ø" if c < "ɐ" else "я"
    return " " if c.isspace() else ","


def _class(s: str) -> str:
    return ("A" if s.isupper() else "a") if s.isascii() and s.isalpha() else s


def contexts(texts: pd.Series) -> Counter:
    """Counts of (symbol before, character, symbol after) of the characters beyond ASCII."""
    raw: Counter = Counter()
    for t in texts:
        if t and not t.isascii():
            raw.update(_TRIPLES.findall(f"\0{t}\0"))
    n: Counter = Counter()
    for (a, c, b), k in raw.items():
        n[_symbol(a), c if c in _known() else OTHER, _symbol(b)] += k
    return n


def separated(rows: list[tuple[str, str, str, int]], kept: float = 0.75, chance: float = 1e-4) -> tuple[list[tuple[str, str, str, float]], list[float]]:
    """(counts without what single-byte damage explains, the damage rate of each pair).

    A pair damages a character at one rate whatever its neighbours, so the count of what it yields, over that of the
    original between the same neighbours, is about that rate everywhere; the yielded character's own clean use adds to
    a few contexts only. The rate is the ratio over the ``kept`` share of the originals with the lowest ratios. A count
    that the rates alone reach with a probability over ``chance`` (Poisson) is damage; of larger ones the excess is clean.
    """
    n = {(a, c, b): k for a, c, b, k in rows}
    letters = [(key, k) for key, k in n.items() if key[0].isalpha() or key[2].isalpha()]
    rates, expected, coarse = [], Counter(), Counter()
    classed = lambda key: (_class(key[0]), key[1], _class(key[2]))
    places = Counter((_class(a), _class(b)) for a, b in {(key[0], key[2]) for key in n})
    for pair in BYTE_AS:
        forward = {}
        for damaged, original in _inverse(pair).items():
            forward.setdefault(original, damaged)
        ratios = sorted((n.get((key[0], forward[key[1]], key[2]), 0) / k, k, key) for key, k in letters if key[1] in forward)
        limit, seen, hits = kept * sum(k for _, k, _ in ratios), 0, 0.0
        for r, k, _ in ratios:
            if seen and seen + k > limit:
                break
            seen, hits = seen + k, hits + r * k
        rate = (hits + 0.1) / (seen + 1000.0)
        rates.append(rate)
        for _, k, key in ratios:
            yielded = (key[0], forward[key[1]], key[2])
            expected[yielded] += rate * k
            coarse[classed(yielded)] += rate * k

    def excess(mean: float, k: int) -> float:
        mean *= BURST
        term, below = math.exp(-mean), 0.0
        for i in range(min(k, 100_000)):
            below += term
            term *= mean / (i + 1)
            if term < 1e-18 and i > mean:
                break
        return 0.0 if 1 - below > chance else max(0.0, k - mean)

    def clean(key: tuple[str, str, str], k: int) -> float:
        # Where the original is rare between the same neighbours, its mean between neighbours of their classes stands in.
        at = classed(key)
        mean = max(expected.get(key, 0.0), coarse.get(at, 0.0) / max(1, places[at[0], at[2]]))
        return excess(mean, k) if mean else float(k)

    return [(a, c, b, clean((a, c, b), k)) for a, c, b, k in rows], rates


class Model:
    """Smoothed probabilities of characters between symbols, and the costs of entering each state, from all counts."""

    def __init__(self, rows: list[tuple[str, str, str, int]]):
        self.three: dict[tuple[str, str], Counter] = {}
        self.two: dict[tuple[str, str], Counter] = {}
        self.one: Counter = Counter()
        clean, rates = separated(rows)
        for a, c, b, n in clean:
            self.three.setdefault((a, b), Counter())[c] += n
            self.two.setdefault((_class(a), _class(b)), Counter())[c] += n
            self.one[c] += n
        self.n3 = {k: sum(v.values()) for k, v in self.three.items()}
        self.n2 = {k: sum(v.values()) for k, v in self.two.items()}
        self.n1 = max(1.0, sum(self.one.values()))
        low, high = ENTER_BYTE
        self.enter = np.array([0.0] + [ENTER_UTF8] * len(UTF8_AS) + [min(high, max(low, math.log(r))) for r in rates] + [0.0])
        self.enter_byte = float(self.enter[1 + len(UTF8_AS) : -1].max())
        self._log: dict[tuple[str, str, str], float] = {}
        self._row: dict[str, tuple[np.ndarray, float]] = {}

    def log(self, a: str, c: str, b: str) -> float:
        """Log probability of ``c`` between the neighbours ``a`` and ``b``."""
        if c < "\x80":
            return -6.0
        key = (_symbol(a), c if c in _known() else OTHER, _symbol(b))
        c = key[1]
        if (got := self._log.get(key)) is not None:
            return got
        p = self.one[c] / self.n1 * 0.999 + 1e-7
        k2, k3 = (_class(key[0]), _class(key[2])), (key[0], key[2])
        if k2 in self.two:
            p = (self.two[k2][c] + 20 * p) / (self.n2[k2] + 20)
        if k3 in self.three:
            p = (self.three[k3][c] + 2 * p) / (self.n3[k3] + 2)
        out = self._log[key] = math.log(p)
        return out

    def row(self, triple: str) -> tuple[np.ndarray, float]:
        """(log odds of each state for the middle character, the most that any path can gain by it; inf where it may begin
        a UTF-8 sequence)."""
        if (got := self._row.get(triple)) is not None:
            return got
        a, c, b = triple
        e = np.full(N_STATES, NEVER)
        e[0] = 0.0
        if c == "\ufffd":
            e[0], e[-1] = NEVER, 0.0
        else:
            own = None
            for k, pair in enumerate(BYTE_AS, 1 + len(UTF8_AS)):
                inv = _inverse(pair)
                x = inv.get(c)
                if x is None:
                    # The same character under both encodings fits either state; one that the pair can't yield doesn't.
                    e[k] = 0.0 if c in _same(pair) else NEVER
                    continue
                own = self.log(a, c, b) if own is None else own
                e[k] = self.log(inv.get(a, a), x, inv.get(b, b)) - own
            if own is None and "\x80" <= c < "\xa0":
                e[0] = -12.0
        gain = math.inf if b > "\x7f" and c in _leads() else max(0.0, float(e[1:].max() - e[0]))
        if len(self._row) < 500_000:
            self._row[triple] = (e, gain)
        return e, gain


N_STATES = 2 + len(UTF8_AS) + len(BYTE_AS)  # clean, UTF-8 states, byte states, lost


@lru_cache(maxsize=None)
def _leads() -> dict[str, list[tuple[int, str]]]:
    """The UTF-8 states that a character can begin a unit of."""
    out: dict[str, list[tuple[int, str]]] = {}
    for k, codec in enumerate(UTF8_AS, 1):
        for c, b in _bytes_of(codec).items():
            if 0xC2 <= b <= 0xF4:
                out.setdefault(c, []).append((k, codec))
    return out


def _utf8_units(text: str, at: list[int]) -> list[tuple[int, int, int, str]]:
    """(state, index of the first position, end, restored) of the UTF-8 sequences in ``text``."""
    out = []
    for i, p in enumerate(at[:-1]):
        if at[i + 1] != p + 1:
            continue
        for k, codec in _leads().get(text[p], ()):
            if m := _units(codec).match(text, p):
                d = _bytes_of(codec)
                try:
                    out.append((k, i, m.end(), bytes(d[x] for x in m[0]).decode("utf-8")))
                except UnicodeDecodeError:
                    continue
    return out


@lru_cache(maxsize=None)
def _same(pair: tuple[str, str]) -> frozenset:
    if pair[1] == "stripped":
        return frozenset()
    a, b = _decoder(pair[0]), _decoder(pair[1])
    return frozenset(a[x] for x in range(128, 256) if a[x] == b[x])


def labels(text: str, model: Model) -> tuple[list[int], list[int], dict[tuple[int, int], tuple[int, str]]]:
    """Positions beyond ASCII, the state of each by Viterbi, and the units: (state, start) -> (end, restored); nothing
    where all are clean for certain."""
    triples = _TRIPLES.findall(f"\0{text}\0")
    rows = [model.row(t) for t in triples]
    if sum(g for _, g in rows) + model.enter_byte <= 0:
        return [], [], {}
    at = [m.start() for m in _TRIPLES.finditer(f"\0{text}\0")]
    units8 = _utf8_units(text, at)
    if not units8 and sum(max(0.0, float(r[1:].max() - r[0])) if g == math.inf else g for r, g in rows) + model.enter_byte <= 0:
        return [], [], {}
    e = np.array([r for r, _ in rows])
    units: dict[tuple[int, int], tuple[int, str]] = {}
    for k, i, end, c in units8:
        # What comes before and after is read as it stands; if it is damaged itself, the classes' probabilities serve.
        e[i, k] = model.log(text[at[i] - 1] if at[i] else "\0", c, text[end] if end < len(text) else "\0") - CHANCE
        e[i + 1 : i + end - at[i], k] = 0.0
        units[k, at[i]] = (end, c)
    # A state that explains no character better than the clean one is on no best path.
    active = [0, *(k for k in range(1, N_STATES) if (e[:, k] > e[:, 0]).any())]
    for k in active:
        if len(UTF8_AS) < k < N_STATES - 1:
            inv = _inverse(BYTE_AS[k - 1 - len(UTF8_AS)])
            units.update({(k, p): (p + 1, inv[text[p]]) for p in at if text[p] in inv})
    rows_, enter = e[:, active].tolist(), model.enter[active].tolist()
    score, back = [x + y for x, y in zip(rows_[0], enter)], []
    states = range(len(active))
    for now in rows_[1:]:
        # From any state to clean (leaving costs), from clean or by leaving to another state (entering costs).
        hub = max(states, key=lambda k: score[k] + LEAVE if k else score[k])
        best = score[hub] + (LEAVE if hub else 0.0)
        step = [k if score[k] >= best + enter[k] else hub for k in states]
        score = [(score[k] if step[k] == k else best + enter[k]) + now[k] for k in states]
        back.append(step)
    s = max(states, key=score.__getitem__)
    out = [s]
    for step in reversed(back):
        s = step[s]
        out.append(s)
    return at, [active[s] for s in reversed(out)], units


def restore(text: str, model: Model) -> tuple[bool, str]:
    """(affected, text with each labelled span inverted, again and again until nothing new comes out)."""
    if not text or text.isascii():
        return False, text
    hit, seen = "\ufffd" in text, {text}
    while True:
        at, states, units = labels(text, model)
        out, done = [], 0
        for p, s in zip(at, states, strict=True):
            if s and p >= done and (s, p) in units:
                end, c = units[s, p]
                out += [text[done:p], c]
                done = end
        if not out:
            return hit, text
        new = "".join(out) + text[done:]
        if new in seen:
            return True, text
        hit, text = True, new
        seen.add(text)


def counted(docs: DataFrame, text: str) -> list[tuple[str, str, str, int]]:
    """The counts of all texts of ``docs``: as many rows as the alphabets allow at most, whatever the corpus."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()
        for b in batches:
            n.update(contexts(b[text]))
        yield pd.DataFrame([(*k, v) for k, v in n.items()], columns=["a", "c", "b", "n"])

    rows = docs.where(F.col(text).rlike(r"[^\x00-\x7F]")).select(text).mapInPandas(count, "a string, c string, b string, n bigint")
    return sorted(tuple(r) for r in rows.groupBy("a", "c", "b").agg(F.sum("n").alias("n")).collect())


@lru_cache(maxsize=2)
def _model(rows: tuple) -> Model:
    return Model(list(rows))


def restored(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, restored) of the affected documents."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(counted(docs, text)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = _model(shared.value)  # once a worker
        for b in batches:
            got = [(k, *restore(t, m)) for k, t in zip(b[key], b[text], strict=True)]
            yield pd.DataFrame([(k, t) for k, hit, t in got if hit], columns=[key, "restored"])

    kind = dict(docs.dtypes)[key]
    return docs.where(F.col(text).rlike(r"[^\x00-\x7F]")).select(key, text).mapInPandas(judge, f"`{key}` {kind}, restored string")
