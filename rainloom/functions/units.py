"""A small grammar of measuring units in English and French texts.

A unit expression becomes a vector of exponents over (length, mass, time) and a scale to SI; 1 kg of water on a square
metre is 1 mm, so mass per area is folded into length. `statement` finds the unit that a text states for its values and
passes over lengths that belong to something else ("funnel of 8 inches").
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import lru_cache

# Scale to SI and exponents of (length, mass, time).
_LENGTH, _MASS, _TIME = (1, 0, 0), (0, 1, 0), (0, 0, 1)
_BASE = {
    "m": (1.0, _LENGTH), "metre": (1.0, _LENGTH), "meter": (1.0, _LENGTH),
    "dm": (0.1, _LENGTH), "decimetre": (0.1, _LENGTH), "decimeter": (0.1, _LENGTH),
    "cm": (0.01, _LENGTH), "centimetre": (0.01, _LENGTH), "centimeter": (0.01, _LENGTH),
    "mm": (0.001, _LENGTH), "millimetre": (0.001, _LENGTH), "millimeter": (0.001, _LENGTH),
    "in": (0.0254, _LENGTH), "inch": (0.0254, _LENGTH), "pouce": (0.0254, _LENGTH), "ft": (0.3048, _LENGTH),
    "kg": (1.0, _MASS), "kilogram": (1.0, _MASS), "kilogramme": (1.0, _MASS),
    "l": (0.001, (3, 0, 0)), "litre": (0.001, (3, 0, 0)), "liter": (0.001, (3, 0, 0)),
    "s": (1.0, _TIME), "sec": (1.0, _TIME), "second": (1.0, _TIME), "seconde": (1.0, _TIME),
    "h": (3600.0, _TIME), "hour": (3600.0, _TIME), "heure": (3600.0, _TIME),
    "d": (86400.0, _TIME), "day": (86400.0, _TIME), "jour": (86400.0, _TIME),
}
_PLURAL = {"inches": "inch"}
_TENTHS = {"tenth", "tenths", "dixieme", "dixiemes"}
_SQUARE, _CUBIC = {"square", "sq", "carre"}, {"cubic", "cube"}
_PER, _OF = {"per", "par", "/"}, {"of", "de", "a", "an", "d"}
# Words that announce a unit of the values.
_LEAD = {"in", "en", "as", "unit", "units", "unite", "still", "already", "origine", "kept", "expressed", "rate", "de"}
_PUNCT = {",", ";", ":", "(", "="}
_WATER = ("of water equivalent", "w.e.", "d'eau", "of water")
_TOKEN = re.compile(r"\d+(?:[.,]\d+)?(?:e[+-]?\d+)?(?:/\d+)?|\*\*|\^|[a-z]+|[-+]?\d+|[^\sa-z0-9]")

#: Canonical names of the units that precipitation is recorded in, by (scale, length exponent, time exponent).
CANONICAL = {"m": (1.0, 0), "cm": (0.01, 0), "mm": (0.001, 0), "inch": (0.0254, 0), "tenth_mm": (0.0001, 0), "mm_per_s": (0.001, -1), "m_per_s": (1.0, -1)}
SECONDS_A_DAY = 86400.0


def factor(unit: str) -> float:
    """Millimetres (of a day, for rates) in one `unit`."""
    scale, time = CANONICAL[unit]
    return scale * 1000.0 * (SECONDS_A_DAY if time else 1.0)


def _fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.casefold())
    text = "".join(c for c in text if not unicodedata.combining(c))
    for phrase in _WATER:
        text = text.replace(phrase, " ")
    return text.replace("−", "-").replace("’", "'")


def _tokens(text: str) -> list[str]:
    return _TOKEN.findall(text)


def _word(t: str) -> str | None:
    t = _PLURAL.get(t, t)
    if t in _BASE:
        return t
    return t[:-1] if len(t) > 3 and t.endswith("s") and t[:-1] in _BASE else None


def _number(t: str) -> float | None:
    if not t[:1].isdigit():
        return None
    try:
        if "/" in t:
            a, b = t.split("/")
            return float(a.replace(",", ".")) / float(b)
        return float(t.replace(",", "."))
    except (ValueError, ZeroDivisionError):
        return None


def _expression(tokens: list[str], at: int) -> tuple[float, tuple[int, ...], int, float | None] | None:
    """The unit expression starting at `at`: scale, exponents, end, leading number; None where none starts."""
    i, scale, lead = at, 1.0, None
    if tokens[i] in _TENTHS:
        scale, lead, i = 0.1, 0.1, i + 1
        while i < len(tokens) and tokens[i] in _OF | {"'"}:
            i += 1
    elif (n := _number(tokens[i])) is not None:
        scale, lead, i = n, n, i + 1
    exponents, sign, any_unit, power = [0, 0, 0], 1, False, 1
    while i < len(tokens):
        t = tokens[i]
        if t in _PER:
            if not any_unit and t != "/":
                break
            if t == "/" and any_unit and i + 1 < len(tokens) and _number(tokens[i + 1]) is not None:
                scale /= _number(tokens[i + 1])
                lead = 1.0 / _number(tokens[i + 1])
                i += 2
                continue
            sign, i = -1, i + 1
            continue
        if t in _SQUARE | _CUBIC and any_unit:
            power, i = (2 if t in _SQUARE else 3), i + 1
            continue
        if any_unit and sign < 0 and (t in {"and", "et", "(", ")"}) and i + 1 < len(tokens) + (t == ")") and (t == ")" or _word(tokens[i + 1])):
            if t == ")" and "(" not in tokens[at:i]:
                break
            i += 1
            continue
        w = _word(t)
        if w is None or (any_unit and w == "in"):
            break
        k, e = _BASE[w]
        i += 1
        p = power
        power = 1
        if i < len(tokens) and tokens[i] in {"**", "^"}:
            i += 1
        if i < len(tokens) and re.fullmatch(r"[-+]\d", tokens[i]):
            p, i = int(tokens[i]), i + 1
        elif i < len(tokens) and tokens[i].isdigit() and tokens[i] in "23":
            p, i = int(tokens[i]), i + 1
        p *= sign
        scale *= k**p
        exponents = [x + p * y for x, y in zip(exponents, e)]
        any_unit = True
    if not any_unit:
        return None
    if exponents[1]:  # kg of water: a litre, 0.001 m3
        scale *= 0.001 ** exponents[1]
        exponents = [exponents[0] + 3 * exponents[1], 0, exponents[2]]
    return scale, tuple(exponents), i, lead


def canonical(scale: float, exponents: tuple[int, ...]) -> str | None:
    """The canonical name of a depth or a rate of water; `per day` counts as none. None for other dimensions or scales."""
    length, mass, time = exponents
    if mass or length != 1 or time not in (0, -1):
        return None
    if time and math.isclose(scale * SECONDS_A_DAY, round(scale * SECONDS_A_DAY, 9), rel_tol=1e-6) and any(math.isclose(scale * SECONDS_A_DAY, k, rel_tol=1e-6) for k, t in CANONICAL.values() if not t):
        scale, time = scale * SECONDS_A_DAY, 0
    return next((u for u, (k, t) in CANONICAL.items() if t == time and math.isclose(scale, k, rel_tol=1e-6)), None)


@lru_cache(1 << 16)
def attribute(text: str | None) -> str | None:
    """The unit that a units attribute holds as a whole; None where it holds none."""
    tokens = _tokens(_fold(text or ""))
    while tokens and tokens[-1] == ".":
        tokens.pop()
    found = _expression(tokens, 0) if tokens else None
    return canonical(*found[:2]) if found and found[2] == len(tokens) else None


@lru_cache(1 << 16)
def statement(text: str | None) -> str | None:
    """The unit that a remark, note or title states for the values; None where it states none.

    A unit counts if a leading word or mark announces it, or if it opens the text and a mark, `not` or the end follows.
    A number in front other than a decimal fraction of one unit, or `not`, takes it out.
    """
    tokens = _tokens(_fold(text or ""))
    for i in range(len(tokens)):
        before = tokens[i - 1] if i else ""
        if before == "not" or (before and _number(before) is not None and before != "1"):
            continue
        if before == "/" or (before in _OF - {"de"}):
            continue
        found = _expression(tokens, i)
        if not found:
            continue
        scale, exponents, end, lead = found
        if lead is not None and not (0 < lead < 1):
            continue
        while end < len(tokens) and tokens[end] == ".":
            end += 1
        after = tokens[end] if end < len(tokens) else ""
        closed = after in {"", ",", ";", ")", ":", "not"}
        announced = before in _LEAD or (before in _PUNCT and closed)
        if tokens[i] == "in" and not (announced and closed):
            continue
        if (announced and (closed or before in _LEAD)) or (not before and closed):
            if unit := canonical(scale, exponents):
                return unit
    return None
