"""String-cell expressions (JVM side) and the few Arrow-batched Python helpers.

Python's ``str`` whitespace, ``\\d`` and ``\\w`` are Unicode-wide; the classes
below spell the same sets out so both Java regex (Spark) and RE2 agree.
"""
from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from prepwise.functions import vocab

# Exactly the characters for which Python's str.isspace() is true.
WS = "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
NON_WS = WS.replace("[", "[^", 1)
WORD = "[\\p{L}\\p{N}_]"
DIGITS = "\\p{Nd}+"
URL_RE = "https?://" + NON_WS + "+|www\\." + NON_WS + "+"
EMAIL_RE = NON_WS + "+@" + NON_WS + "+\\." + NON_WS + "+"
# Same matches for the JVM engine: any match spans a whole whitespace-free
# run, so attempts start only at run starts and the lazy parts scan forward
# once — linear instead of backtracking from every position of long tokens.
EMAIL_RE_JVM = "(?<!" + NON_WS + ")" + NON_WS + "+?@" + NON_WS + "+?\\." + NON_WS + "+"
PUNCT_RE = "[^\\p{L}\\p{N}_" + WS[1:-1] + "]"
SPECIAL_RE = "[^\\p{L}\\p{N}_" + WS[1:-1] + "\\x{4e00}-\\x{9fff}]"
NON_ASCII = "[^\\x00-\\x7F]"


def strip_ws(c: Column) -> Column:
    """Strip every Unicode whitespace at both ends."""
    return F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", "")


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one space."""
    return F.regexp_replace(c, WS + "+", " ")


def fullwidth_to_half(c: Column) -> Column:
    """Full-width letters, digits, ideographic space and symbols."""
    src, dst = vocab.fullwidth_pairs()
    return F.translate(c, src, dst)


def smart_punct(c: Column) -> Column:
    """Curly quotes, dashes, ellipsis, no-break space."""
    out = F.translate(c, "".join(vocab.SMART_PUNCT_1TO1), "".join(vocab.SMART_PUNCT_1TO1.values()))
    for k, v in vocab.SMART_PUNCT_MULTI.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def remove_pattern(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


# ---- Arrow-batched Python helpers (only where no built-in exists) ---------

def _normalizer(form: str):
    @F.pandas_udf(T.StringType())
    def _norm(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(form, x) if isinstance(x, str) else x)
    return _norm


def _strip_marks(s: pd.Series) -> pd.Series:
    def one(x):
        if not isinstance(x, str):
            return x
        d = unicodedata.normalize("NFKD", x)
        return "".join(ch for ch in d if not unicodedata.combining(ch))
    return s.map(one)


_accents_udf = F.pandas_udf(_strip_marks, T.StringType())


@F.pandas_udf(T.StringType())
def _title_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x.title() if isinstance(x, str) else x)


def _only_non_ascii(c: Column, fn) -> Column:
    """Ship only cells holding a non-ASCII character to Python; ASCII cells
    are already in every normal form and need no work."""
    needs = c.rlike(NON_ASCII)
    return F.coalesce(fn(F.when(needs, c)), c)


def unicode_normalize(c: Column, form: str = "NFKC") -> Column:
    """Unicode normal form (no JVM built-in exists)."""
    return _only_non_ascii(c, _normalizer(form))


def strip_accents(c: Column) -> Column:
    """NFKD then drop combining marks."""
    return _only_non_ascii(c, _accents_udf)


def title_case(c: Column) -> Column:
    """Python title casing (initcap lowercases after apostrophes)."""
    return _title_udf(c)
