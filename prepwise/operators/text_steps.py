"""Steps over string cells and column names."""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from prepwise.context import Context
from prepwise.functions import text as tx
from prepwise.functions import vocab
from prepwise.operators.base import Step
from prepwise.plans.stats import col
from prepwise.session import bound_batches


class EncodingNormalizer(Step):
    """X1–X6 on every string column: strip, full-width, NFKC, smart
    punctuation, whitespace runs — in this order."""
    name = "encoding_normalizer"
    row_local = True

    @property
    def heavy(self):  # the Unicode normal form runs in Python
        return bool(self.params.unicode_normalize)

    @dataclass
    class Params:
        trim_whitespace: bool = True
        normalize_fullwidth: bool = True
        unicode_normalize: str | None = "NFKC"
        replace_smart_quotes: bool = True
        collapse_whitespace: bool = True

        def validate(self):
            if self.unicode_normalize not in (None, "", "NFC", "NFKC", "NFD", "NFKD"):
                raise ValueError(f"unknown normal form {self.unicode_normalize!r}")

    def expr(self, c: Column) -> Column:
        p = self.params
        if p.trim_whitespace:
            c = tx.strip_ws(c)
        if p.normalize_fullwidth:
            c = tx.fullwidth_to_half(c)
        if p.unicode_normalize:
            c = tx.unicode_normalize(c, p.unicode_normalize)
        if p.replace_smart_quotes:
            c = tx.smart_punct(c)
        if p.collapse_whitespace:
            c = tx.collapse_ws(c)
        return c

    def _exprs(self, df, ctx, state):
        if self.heavy:
            bound_batches(df.sparkSession)
        return {c: self.expr(col(c)) for c in ctx.strings(df)}


class TextStandardizer(Step):
    """X7–X15 on TEXT columns: accents, case, URL/e-mail/digit/punctuation/
    special removal, then collapse and strip."""
    name = "text_standardizer"
    row_local = True

    @property
    def heavy(self):
        return self.params.remove_accents or self.params.case == "title"

    @dataclass
    class Params:
        case: str = "none"
        remove_accents: bool = True
        remove_special_chars: bool = False
        collapse_whitespace: bool = True
        remove_urls: bool = False
        remove_emails: bool = False
        remove_numbers: bool = False
        remove_punctuation: bool = False

        def validate(self):
            if self.case not in ("none", "lower", "upper", "title"):
                raise ValueError(f"unknown case {self.case!r}")

    def expr(self, c: Column) -> Column:
        p = self.params
        if p.remove_accents:
            c = tx.strip_accents(c)
        if p.case == "lower":
            c = F.lower(c)
        elif p.case == "upper":
            c = F.upper(c)
        elif p.case == "title":
            c = tx.title_case(c)
        if p.remove_urls:   # the substring tests keep the regex off cells that cannot match
            c = F.when(c.contains("://") | c.contains("www."), tx.remove_pattern(c, tx.URL_RE)).otherwise(c)
        if p.remove_emails:
            c = F.when(c.contains("@"), tx.remove_pattern(c, tx.EMAIL_RE_JVM)).otherwise(c)
        if p.remove_numbers:
            c = tx.remove_pattern(c, tx.DIGITS)
        if p.remove_punctuation:
            c = tx.remove_pattern(c, tx.PUNCT_RE)
        if p.remove_special_chars:
            c = tx.remove_pattern(c, tx.SPECIAL_RE)
        if p.collapse_whitespace:
            c = tx.strip_ws(tx.collapse_ws(c))
        return c

    def _exprs(self, df, ctx, state):
        if self.heavy:
            bound_batches(df.sparkSession)
        return {c: self.expr(col(c)) for c in ctx.text(df)}


_CASES = {"none": lambda n: n, "lower": str.lower, "upper": str.upper}


def name_rules(p) -> list:
    """The renaming rules that are switched on (C1–C5), as functions of a name, in order."""
    special = re.compile("[" + vocab.NAME_SPECIAL_CHARS + "]")
    rules = [
        (p.strip, str.strip),                                                               # C1
        (p.replace_special, lambda n: special.sub("_", n)),                                 # C2
        (p.collapse_underscores, lambda n: "_".join(part for part in n.split("_") if part)),    # C3
        (True, _CASES[p.case]),                                                             # C4
        (p.prefix_digit_columns, lambda n: "col_" + n if n[:1].isdigit() else n),           # C5
    ]
    return [rule for on, rule in rules if on]


def clean_name(name: str, position: int, rules: list) -> str:
    for rule in rules:
        name = rule(name)
    return name or f"col_{position}"                                                        # C6


class ColumnNameCleaner(Step):
    """Driver-side renaming, unique against all names (case-insensitive)."""
    name = "column_name_cleaner"
    row_local = True

    @dataclass
    class Params:
        strip: bool = True
        case: str = "none"
        replace_special: bool = True
        collapse_underscores: bool = True
        prefix_digit_columns: bool = True

        def validate(self):
            if self.case not in ("none", "lower", "upper"):
                raise ValueError(f"unsupported case {self.case!r}")

    def _fit(self, df, ctx):
        cols, rules = ctx.user_columns(df), name_rules(self.params)
        cand = {c: clean_name(c, i, rules) for i, c in enumerate(cols)}
        taken = {c.lower() for c in df.columns if cand.get(c, c) == c}
        mapping = {}
        for c in cols:
            new = cand[c]
            if new == c:
                continue
            base, k = new, 0
            while new.lower() in taken:
                k += 1
                new = f"{base}_{k}"
            taken.add(new.lower())
            mapping[c] = new
        return {"rename": mapping}

    def _transform(self, df, ctx, state):
        m = state["rename"]
        if not m:
            return df, ctx
        ctx = ctx.renamed(m)
        for old, new in m.items():
            ctx = ctx.note(self.name, new, f"renamed from {old!r}")
        return df.withColumnsRenamed(m), ctx
