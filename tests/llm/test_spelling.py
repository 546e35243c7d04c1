"""Spelling variants against all pairs of words."""
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from prepwise.llm import spelling

SCHEMA = "doc_id long, text string"


def brute(rows, times=10):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def result(df, **kw):
    return sorted(tuple(r) for r in spelling.variants(df, **kw).collect())


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "aé"), (3, "aZñ÷")])
def test_all_pairs(spark, seed, letters):
    r = random.Random(seed)
    stems = ["".join(r.choices(letters, k=r.randint(6, 12))) for _ in range(30)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(120):
            w = stems[min(int(r.expovariate(0.25)), 29)]
            if r.random() < 0.3:
                at = r.randrange(len(w) + 1)
                w = w[:at] + r.choice(["", r.choice(letters)]) + w[at + r.randint(0, 1):]
            words.append(w)
        rows.append((i, r.choice([" ", ", ", "\n", "0"]).join(words)))
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = brute(rows)
    assert got == want
    assert any(w[1] for w in want) and any(w[4] > 3 for w in want)


def test_forms_are_followed(spark):
    ladder = {"abcdefgh": 1200, "abcdefghi": 110, "abcdefghij": 9, "xbcdefgh": 120}
    text = " ".join(w for w, n in ladder.items() for _ in range(n))
    df = spark.createDataFrame([(None, text)], SCHEMA)
    got = {r["word"]: r for r in spelling.variants(df, damage=None).collect()}
    assert got["abcdefghij"]["form"] == "abcdefghi" and got["abcdefghij"]["root"] == "abcdefgh"
    assert got["xbcdefgh"]["form"] == "abcdefgh" and got["abcdefgh"]["n_near"] == 2 and got["abcdefgh"]["form_n"] is None


def test_edges(spark):
    """Null ids and texts, empty and long texts, repeated rows, clashing columns, empty tables."""
    long = "wordlike " * 60_000 + "w" * 70_000 + " " + "w" * 70_000
    rows = [(None, None), (1, None), (None, "wordlike wordlik"), (2, ""), (3, long), (3, long), (4, "×÷×÷×÷× ŁŁŁŁŁŁŁŁ ABCDEFG abcdefg É" + "éééééé" * 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit("clash") for c in ("word", "n", "a", "k", "run", "id", "size")})
    want = brute(rows)
    assert result(extra) == want and {len(w[0]) for w in want} >= {7, 8, 70_000}
    assert result(df.limit(0)) == []
    with pytest.raises(ValueError):
        spelling.variants(df, times=1)
