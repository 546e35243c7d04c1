"""Numeric-text expressions: number guard, unit and percent parsing, decimals."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from prepwise.functions.text import WS, strip_ws

# A plain number the way Python's float() reads it (Spark would also accept
# "1d" / "1f" suffixes, which must stay non-numeric).
NUMBER_RE = "^" + WS + "*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?" + WS + "*$"
NUM_TOKEN = "[+-]?\\p{Nd}[\\p{Nd},]*\\.?\\p{Nd}*"
PERCENT_RE = "^" + WS + "*([+-]?[0-9]*\\.?[0-9]+)" + WS + "*[%％]" + WS + "*$"
PERMILLE_RE = "^" + WS + "*([+-]?[0-9]*\\.?[0-9]+)" + WS + "*[‰‱]" + WS + "*$"


def is_number(c: Column) -> Column:
    return to_number(c).isNotNull()


def to_number(c: Column) -> Column:
    """Text → double, NULL where it is not a plain number."""
    return F.when(c.rlike(NUMBER_RE), strip_ws(c).try_cast("double"))


def unit_regex(units: list[str]) -> str:
    alt = "|".join(re.escape(u) for u in units)
    return "^" + WS + "*(" + NUM_TOKEN + ")" + WS + "*(" + alt + ")" + WS + "*$"


def range_regex(units: list[str]) -> str:
    alt = "|".join(re.escape(u) for u in units)
    return ("^" + WS + "*(" + NUM_TOKEN + ")" + WS + "*[-~～]" + WS + "*(" + NUM_TOKEN + ")"
            + WS + "*(" + alt + ")" + WS + "*$")


def strip_commas_to_double(c: Column) -> Column:
    return F.regexp_replace(c, ",", "").try_cast("double")


def decimal_places(x: Column) -> Column:
    """Decimals of ``%.10f`` without trailing zeros (0 for whole numbers)."""
    s = F.regexp_replace(F.format_string("%.10f", x), "0+$", "")
    return F.length(F.substring_index(s, ".", -1)).cast("int")


def rint_places(x: Column, places: int) -> Column:
    """Scale, round half to even, unscale (NumPy's rounding)."""
    f = float(10 ** places)
    return F.rint(x * F.lit(f)) / F.lit(f)


def floor_places(x: Column, places: int) -> Column:
    f = float(10 ** places)
    return F.floor(x * F.lit(f)).cast("double") / F.lit(f)


def ceil_places(x: Column, places: int) -> Column:
    f = float(10 ** places)
    return F.ceil(x * F.lit(f)).cast("double") / F.lit(f)
