import random

import pytest
from pyspark.sql import functions as F

from prepwise.llm import mixing

from .brute import targets, words

SCHEMA = "doc_id long, text string, source string"


def table(n=900, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "B", "é", "small", None, ""])
        if source == "small" and rng.random() < 0.9:
            source = "a"
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))), source))
    return rows


def sums(rows):
    out = {}
    for _, t, s in rows:
        out[s] = out.get(s, 0) + len(words(t))
    return out


def test_targets_match_resharing(spark):
    for sizes in ({"a": 100, "b": 100, "c": 1}, {"x": 5}, {"a": 0, "b": 10}, {None: 7, "a": 1, "b": 1, "c": 1000, "d": 1}, {"a": 0}, {"k%d" % i: 3**i for i in range(12)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(targets(sizes))


@pytest.mark.parametrize("block_rows", [50_000, 7])
def test_mix_meets_targets(spark, block_rows):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df.repartition(4), block_rows=block_rows).collect()
    again = mixing.mix(df.repartition(9).orderBy(F.rand(3)), block_rows=block_rows).collect()
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    size, want = sums(rows), targets(sums(rows))
    by = {i: (len(words(t)), s) for i, t, s in rows}
    taken = {}
    for r in got:
        n, s = by[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == size[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] == r["copies"] * n and r["taken"] <= 3 * n
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 150 + 1e-6           # half of the longest document


def test_expectation_is_kept():
    import pandas as pd
    block = pd.DataFrame({"sid": 1, "doc_id": range(40), "tie": 1, "size": [1 + k % 7 for k in range(40)], "p": 0.3, "copies": 0})
    mean = sum(mixing.pivotal(block, seed, 0, False)["p"] for seed in range(400)) / 400
    assert abs(mean.mean() - 0.3) < 0.02 and (abs(mean - 0.3) < 0.12).all()


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mixed_rows(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "a b c", "t"), (2, None, "s"), (None, "x y", None), (None, "x z", None), (3, "w " * 30_000, "t"), (4, "q", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("own")).withColumn("__copies", F.lit(9))
    got = mixing.mix(df)
    assert got.count() == len(rows)
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    assert out.count() == got.agg(F.sum("copies")).first()[0]
    by_source = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("copies").alias("n")).collect()}
    assert {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()} == {s: n for s, n in by_source.items() if n}
