"""Quantities in mixed units, scales and spellings converted to one unit per field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prefixes, roots and exponents of units. A dimension counts mass (g), length (dm, so that a litre is
# length cubed), amount (mol), time (min) and temperature (K).
PREFIXES = {"p": 1e-12, "n": 1e-9, "u": 1e-6, "µ": 1e-6, "μ": 1e-6, "mc": 1e-6, "m": 1e-3, "c": 1e-2, "d": 1e-1, "k": 1e3, "M": 1e6, "G": 1e9,
            "pico": 1e-12, "nano": 1e-9, "micro": 1e-6, "milli": 1e-3, "centi": 1e-2, "deci": 1e-1, "kilo": 1e3, "mega": 1e6}
MASS, LENGTH, AMOUNT, TIME, HEAT = (tuple(int(i == j) for j in range(5)) for i in range(5))
VOLUME, MOLAR, MOLAR_MASS, PER_VOLUME = (0, 3, 0, 0, 0), (0, -3, 1, 0, 0), (1, 0, -1, 0, 0), (0, -3, 0, 0, 0)
#: spelling: dimension, factor, offset, whether a prefix may stand before it.
ROOTS = {
    "M": (MOLAR, 1.0, 0.0, True), "molar": (MOLAR, 1.0, 0.0, True),
    "mol": (AMOUNT, 1.0, 0.0, True), "mole": (AMOUNT, 1.0, 0.0, True), "moles": (AMOUNT, 1.0, 0.0, True),
    "L": (VOLUME, 1.0, 0.0, True), "l": (VOLUME, 1.0, 0.0, True), "litre": (VOLUME, 1.0, 0.0, True), "liter": (VOLUME, 1.0, 0.0, True), "litres": (VOLUME, 1.0, 0.0, True), "liters": (VOLUME, 1.0, 0.0, True),
    "m": (LENGTH, 10.0, 0.0, True), "metre": (LENGTH, 10.0, 0.0, True), "meter": (LENGTH, 10.0, 0.0, True),
    "g": (MASS, 1.0, 0.0, True), "gram": (MASS, 1.0, 0.0, True), "grams": (MASS, 1.0, 0.0, True),
    "Da": (MOLAR_MASS, 1.0, 0.0, True), "dalton": (MOLAR_MASS, 1.0, 0.0, True), "daltons": (MOLAR_MASS, 1.0, 0.0, True),
    "s": (TIME, 1 / 60, 0.0, True), "sec": (TIME, 1 / 60, 0.0, True), "secs": (TIME, 1 / 60, 0.0, False), "second": (TIME, 1 / 60, 0.0, True), "seconds": (TIME, 1 / 60, 0.0, True),
    "min": (TIME, 1.0, 0.0, False), "mins": (TIME, 1.0, 0.0, False), "minute": (TIME, 1.0, 0.0, False), "minutes": (TIME, 1.0, 0.0, False),
    "h": (TIME, 60.0, 0.0, False), "hr": (TIME, 60.0, 0.0, False), "hrs": (TIME, 60.0, 0.0, False), "hour": (TIME, 60.0, 0.0, False), "hours": (TIME, 60.0, 0.0, False),
    "d": (TIME, 1440.0, 0.0, False), "day": (TIME, 1440.0, 0.0, False), "days": (TIME, 1440.0, 0.0, False), "week": (TIME, 10080.0, 0.0, False), "weeks": (TIME, 10080.0, 0.0, False),
    "K": (HEAT, 1.0, 0.0, False), "kelvin": (HEAT, 1.0, 0.0, False),
    "C": (HEAT, 1.0, 273.15, False), "celsius": (HEAT, 1.0, 273.15, False), "centigrade": (HEAT, 1.0, 273.15, False), "℃": (HEAT, 1.0, 273.15, False),
    "F": (HEAT, 5 / 9, 459.67 * 5 / 9, False), "fahrenheit": (HEAT, 5 / 9, 459.67 * 5 / 9, False), "℉": (HEAT, 5 / 9, 459.67 * 5 / 9, False),
    "%": (PER_VOLUME, 10.0, 0.0, False),  # after a mass: per decilitre
}
DEGREE = ("degrees ", "degree ", "deg ", "deg. ", "degrees", "degree", "deg", "° ", "°", "º")
SUPERSCRIPTS = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁻", "0123456789-")
DIVIDE, TIMES = ("/", " per ", " / "), (" ", "·", "*", "⋅", ".")

#: Costs in bits of the choices that a segmentation makes, and of a dimension other than the field's.
COST = {"term": 2.0, "prefix": 1.0, "case": 3.0, "exponent": 1.0, "separator": 0.5, "wrong_dimension": 40.0}


class Trie:
    """Spellings that start at a place of a text, longest or shortest, exact or apart from case."""

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for ch in w:
                node = node.setdefault(ch, {})
            node[""] = w

    def at(self, text: str, i: int) -> Iterator[tuple[str, bool]]:
        """(word, exact case) of every word that matches from place i on."""
        todo = [(self.root, i, True)]
        while todo:
            node, j, exact = todo.pop()
            if "" in node:
                yield node[""], exact
            if j < len(text):
                for ch in {text[j], text[j].lower(), text[j].upper()}:
                    if ch in node:
                        todo.append((node[ch], j + 1, exact and ch == text[j]))


_PREFIX, _ROOT, _DEGREE, _DIVIDE, _TIMES = Trie(PREFIXES), Trie(ROOTS), Trie(DEGREE), Trie(DIVIDE), Trie(TIMES)
_EXPONENT = re.compile(r"\^?([-−]?\d)")


@dataclass(frozen=True)
class Unit:
    dims: tuple
    factor: float
    offset: float  # kelvin at zero, for temperatures
    cost: float


@lru_cache(maxsize=65536)
def segment(text: str, expected: tuple | None = None) -> Unit | None:
    """The cheapest reading of a unit text as prefixes, roots and exponents; null if none covers it.

    Dynamic programming over the places of the text: a state is a place with the dimension reached and whether the
    next term divides; it keeps its cheapest way. Spellings in another case, more terms and more prefixes cost more, and a
    reading whose dimension is not that of the field costs far more, which settles cases such as m, M, d, or min.
    """
    text = re.sub(r"\s+", " ", text.translate(SUPERSCRIPTS)).strip()
    if not text:
        return None
    # place -> {(dims, sign of the next term, term expected): (cost, factor, offset, terms)}
    states: list[dict] = [{} for _ in range(len(text) + 1)]
    states[0][((0,) * 5, 1, True)] = (0.0, 1.0, 0.0, 0)

    def offer(i: int, key: tuple, new: tuple) -> None:
        if key not in states[i] or new[0] < states[i][key][0]:
            states[i][key] = new

    for i in range(len(text)):
        for (dims, sign, term), (cost, factor, offset, terms) in list(states[i].items()):
            if not term:
                for word, _ in _DIVIDE.at(text, i):
                    offer(i + len(word), (dims, -1, True), (cost + COST["separator"], factor, offset, terms))
                for word, _ in _TIMES.at(text, i):
                    offer(i + len(word), (dims, 1, True), (cost + COST["separator"], factor, offset, terms))
                if text[i] == "%" and dims == MASS:
                    offer(i + 1, (tuple(a + b for a, b in zip(dims, PER_VOLUME)), 1, False), (cost + COST["term"], factor * ROOTS["%"][1], offset, terms + 1))
                continue
            starts = [(i, 1.0, 0.0, False, False)]
            for word, exact in _PREFIX.at(text, i):
                long = len(word) > 2
                starts.append((i + len(word), PREFIXES[word], COST["prefix"] + (0 if exact or long else COST["case"]), True, False))
            for word, _ in _DEGREE.at(text, i):
                starts.append((i + len(word), 1.0, 0.0, False, True))
            for j, scale, paid, prefixed, degree in starts:
                for word, exact in _ROOT.at(text, j):
                    d, f, off, may = ROOTS[word]
                    if prefixed and not may or degree and d != HEAT or word == "%":
                        continue
                    here = cost + paid + COST["term"] + (0 if exact or len(word) > 3 else COST["case"])
                    k = j + len(word)
                    ends = [(k, 1, 0.0)]
                    if m := _EXPONENT.match(text, k):
                        ends.append((m.end(), int(m[1].replace("−", "-")), COST["exponent"]))
                    for end, power, more in ends:
                        p = power * sign
                        offer(end, (tuple(a + b * p for a, b in zip(dims, d)), 1, False), (here + more, factor * (scale * f) ** p, off if not terms else 0.0, terms + 1))
    best = None
    for (dims, _, term), (cost, factor, offset, terms) in states[-1].items():
        if term:
            continue
        total = cost + (COST["wrong_dimension"] if expected and dims != expected else 0)
        if best is None or total < best.cost:
            best = Unit(dims, factor, offset if terms == 1 else 0.0, total)
    return best


_NUMBER = re.compile(r"(?<![^\W\d_])(?<![\d.,])([-+−]?(?:\d[\d.,]*|\.\d+))(?:\s*(?:[x×*·]\s*10\s*\^?\s*|[eE])([-+−]?\d+)(?![\d.]))?")
_MARGIN = re.compile(r"\s*(?:±|\+/-|\+-|\+/−)\s*[\d.,]+(?:\s*(?:[x×*·]\s*10\s*\^?\s*|[eE])[-+−]?\d+)?")
_REMARK = re.compile(r"\s+[(\[][^()\[\]]*[)\]]\s*$|^\s*[(\[][^()\[\]]*\s[^()\[\]]*[)\]]\s*$")
_LOG = re.compile(r"^([-−]?)\s*(?:log|lg)\s*_?(?:10)?\s*[(\[]?\s*([^()\[\]]*?)\s*[)\]]?$", re.IGNORECASE)
_P_LABEL = re.compile(r"(?:^|[^\w])p(?:[A-Z][A-Za-z]*\d*)\s*(?:value|of|is)?\s*[:=]?\s*(?:>=|<=|[<>~=≥≤]|ca\.)?\s*$")
_THOUSANDS = re.compile(r"[-+]?\d{1,3}(?:,\d{3})+\.\d*$|[-+]?\d{1,3}(?:,\d{3}){2,}$")


def stated(text: str) -> tuple[float, str, str] | None:
    """(number, text before it, text after it and its error margin) of the first number that a text states."""
    m = _NUMBER.search(text)
    if not m:
        return None
    digits = m[1].replace("−", "-")
    after = text[m.end() :]
    if m[2] is None:
        digits = digits.rstrip(".,")
    digits = digits.replace(",", "") if _THOUSANDS.match(digits) else digits.replace(",", ".")
    try:
        number = float(f"{digits}e{m[2].replace('−', '-')}" if m[2] else digits)
    except ValueError:
        return None
    if margin := _MARGIN.match(after):
        after = after[margin.end() :]
    return number, text[: m.start()], _REMARK.sub("", after).strip(" \t\r\n;,")


@dataclass(frozen=True)
class Field:
    """How a field's quantities are read: their common unit, and the scale of a number that stands alone.

    bare: "" (counts not), "unit" (already in the common unit) or "-log" (negative decadic logarithm of mol/L).
    """

    common_unit: str
    bare: str = ""


def convert(field: Field, term: str, value: str, unit: str | None) -> float | None:
    """The value in the field's common unit, or None if no number, no unit, or one of another dimension is stated."""
    target = segment(field.common_unit)
    value = value.replace(" ", " ").strip()
    if target is None or not (found := stated(value)):
        return None
    number, before, rest = found
    column = (unit or "").replace(" ", " ").strip()
    in_term = re.search(r"[(\[]([^()\[\]]+)[)\]]", term or "")
    for text in (rest, column, in_term[1] if in_term else ""):
        if not text:
            continue
        if log := _LOG.match(text):
            inner = segment(log[2] or "M", target.dims)
            if inner and inner.dims == target.dims and abs(number) < 300:
                return 10.0 ** (-number if log[1] else number) * inner.factor / target.factor
            return None
        own = segment(text, target.dims)
        if own is None and text is rest and column:
            continue
        if own is None or own.dims != target.dims:
            return None
        if target.dims == HEAT:
            return (number * own.factor + own.offset - target.offset) / target.factor
        return number * (own.factor / target.factor)
    if target.dims == MOLAR and (_P_LABEL.search(before) or field.bare == "-log") and abs(number) < 300:
        return 10.0**-number / target.factor
    return number if field.bare == "unit" and not column and not rest else None


def convert_units(df: DataFrame, keep: list[str], field: str, term: str, value: str, unit: str, fields: dict[str, Field]) -> DataFrame:
    """`keep` columns, common_unit and common_value (text in the form %.3e) of every row that can be converted.

    `fields` says for each content of column `field` what its common unit is. Comparison signs, error margins,
    labels and remarks are ignored. Rows with a null, unreadable or incompatible value give no row; repeats
    stay. Nothing is shuffled: each Arrow batch is read once, and every distinct unit text is segmented once
    per worker (a bounded cache).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [convert(fields[f], t, v, u) for f, t, v, u in zip(pdf["__f"], pdf["__t"], pdf["__v"], pdf["__u"])]
            text = [None if x is None else "%.3e" % x for x in got]
            out = pdf[[f"__k{i}" for i in range(len(keep))]].copy()
            out["__unit"] = [fields[f].common_unit for f in pdf["__f"]]
            out["__value"] = text
            yield out[out["__value"].notna()]

    rows = df.where(F.col(field).isin(list(fields)) & F.col(value).rlike(r"\d"))
    rows = rows.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(field).alias("__f"), F.col(term).alias("__t"), F.col(value).alias("__v"), F.col(unit).alias("__u"))
    kinds = ", ".join(f"__k{i} {dict(df.dtypes)[c]}" for i, c in enumerate(keep))
    out = rows.mapInPandas(run, f"{kinds}, __unit string, __value string")
    return out.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("__unit").alias("common_unit"), F.col("__value").alias("common_value"))
