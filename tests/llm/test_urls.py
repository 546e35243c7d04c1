import re

from pyspark.sql import functions as F

from prepwise.llm import urls

CASES = [
    (1, "https://a.example.com/xxx", "a.example.com", "/xxx", None, "block"),
    (2, "https://a.example.com/xxxl", "a.example.com", "/xxxl", None, "allow"),
    (3, "http://Adult-Dating.example.net/?q=1", "adult-dating.example.net", "/", None, "block"),
    (4, "http://adult.example.net/adult/adult", "adult.example.net", "/adult/adult", None, "allow"),
    (5, "http://x.example.org/es/porn", "x.example.org", "/es/porn", "example.org/es/", "block"),
    (6, "http://x.example.org/en/porn", "x.example.org", "/en/porn", "org/", "allow"),
    (7, "http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    (8, "http://notexample.org/en/17", "notexample.org", "/en/17", "org/", "allow"),
    (9, "http://a.com/fr/casino", "a.com", "/fr/casino", "com/fr/", "allow"),
    (10, "http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
    (11, "http://a.org", "a.org", "", None, "allow"),
    (12, None, "", "", None, "allow"),
    (13, "no scheme casino", "", "", None, "block"),
    (14, "http://a.com?x=://b.org/", "a.com", "", None, "allow"),
    (15, "a://b://C.ORG/é?#", "b:", "//C.ORG/é", None, "allow"),
    (None, "", "", "", None, "allow"),
    (16, "http://x.net/" + "a" * 200_000 + "/viagra", "x.net", "/" + "a" * 200_000 + "/viagra", None, "block"),
]


def test_cases(spark):
    rows = [c[:2] for c in CASES] + [CASES[0][:2]]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("v", F.lit(1))
    got = urls.judge(df.repartition(3)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted([c[:1] + c[2:] for c in CASES] + [CASES[0][:1] + CASES[0][2:]], key=repr)
    assert urls.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.judge(df, rules=(), strict=(), soft=()).collect()} == {"allow"}


def test_hits_match_regular_expressions():
    v = urls.Vocabulary(urls.STRICT, urls.SOFT)
    for u in ("xxx", "sexbet.sex-bet", "betting/bet?poker=slots", "porno.porn", "crack_keygen", "ésexé", "LOAN-pills", ""):
        low = u.lower()
        count = lambda terms: sum(bool(re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", low)) for t in terms)
        assert v.hits(u) == (count(urls.STRICT), count(urls.SOFT))


def test_longest_rule_wins():
    rules = urls.Rules([("allow", "b.c/"), ("block", "c/long/path/"), ("allow", "a.b.c/l")])
    assert rules.fit("a.b.c", "/long/path/x") == ("c/long/path/", "block")
    assert rules.fit("x.b.c", "/l") == ("b.c/", "allow")
    assert rules.fit("d", "/") == (None, None)
