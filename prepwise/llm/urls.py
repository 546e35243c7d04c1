"""URL filter: host rules, then a weighted vocabulary matched with an Aho-Corasick automaton.

The lower-cased (A-Z) url is scanned once for all terms; a hit counts where no letter or
digit of ASCII stands directly before or after it.  Every distinct term found adds its
weight: a strict term weighs 1, a soft term ``1 / SOFT_HITS``, and a url is blocked at 1,
that is on one strict or ``SOFT_HITS`` distinct soft terms.  A fitting rule (host or any of
its subdomains, path prefix, longest rule first) decides instead.

Defined results: a null url counts as empty; null or no ``://`` gives empty host and path
and fits no rule; rows are judged one by one, so null ids and repeated rows stay; an empty
table gives an empty result; terms and rules are parameters, sent to the tasks as plain data."""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "milf", "escorts", "viagra", "cialis", "warez", "torrent", "casino")
SOFT = ("adult", "sex", "nude", "naked", "erotic", "dating", "bet", "betting", "poker", "slots", "pills", "crack", "keygen", "loan")
SOFT_HITS = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict, soft):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for term in terms:
                if term:
                    self.automaton.add_word(term.translate(_FOLD), (kind, term.translate(_FOLD)))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, url: str | None) -> tuple[int, int]:
        """Numbers of distinct strict and soft terms of a url."""
        url = (url or "").translate(_FOLD)
        found = set()
        if not self.empty:
            for end, (kind, term) in self.automaton.iter(url):
                start = end - len(term) + 1
                if not (start and _word(url[start - 1])) and not (end + 1 < len(url) and _word(url[end + 1])):
                    found.add((kind, term))
        strict = sum(kind == "strict" for kind, _ in found)
        return strict, len(found) - strict


def _word(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


class Rules:
    """Rules by host; a url's host is looked up label by label."""

    def __init__(self, rules):
        self.by_host: dict[str, list] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host.translate(_FOLD), []).append((len(rule), len(host), slash + path, rule, verdict))

    def fit(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, at = None, host
        while True:
            for r in self.by_host.get(at, ()):
                if path.startswith(r[2]) and (best is None or r[:2] > best[:2]):
                    best = r
            _, dot, at = at.partition(".")
            if not dot:
                return (best[3], best[4]) if best else (None, None)


def judge(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, strict_hits, soft_hits)`` per row of ``pages``."""
    @F.pandas_udf("rule string, verdict string, strict_hits int, soft_hits int")
    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        table, vocabulary = Rules(rules), Vocabulary(strict, soft)
        for urls, hosts, paths in batches:
            rows = []
            for url, host, path in zip(urls, hosts, paths):
                rule, verdict = table.fit(host, path) if host else (None, None)
                hard, weak = vocabulary.hits(url)
                rows.append((rule, verdict or ("block" if hard + weak / soft_hits >= 1 else "allow"), hard, weak))
            yield pd.DataFrame(rows, columns=["rule", "verdict", "strict_hits", "soft_hits"])

    placed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    judged = placed.withColumn("v", verdicts("url", "host", "path"))
    return judged.select("page_id", "host", "path", "v.rule", "v.verdict", "v.strict_hits", "v.soft_hits")
