"""Shared statistics: the distributed exact quantiles equal NumPy's linear
quantiles."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from prepwise.plans import stats


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    a = rng.normal(size=3000).round(3)
    b = rng.integers(0, 7, 3000).astype(float)           # heavy ties
    c = np.concatenate([np.full(1000, 5.0), rng.lognormal(size=2000)])   # one value holds a third
    rows = [(float(x), float(y), float(z) if i % 10 else None) for i, (x, y, z) in enumerate(zip(a, b, c))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = stats.quantiles(df, ["a", "b", "c"], probs)
    cc = np.array([r[2] for r in rows if r[2] is not None])
    for name, arr in (("a", a), ("b", b), ("c", cc)):
        want = [float(np.quantile(arr, p)) for p in probs]
        assert got[name] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_exact_quantiles_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (2.0,)], "x double")
    assert stats.exact_quantiles(df, ["x"], [0.5]) == {"x": [2.0]}
    empty = spark.createDataFrame([], "x double")
    assert stats.exact_quantiles(empty, ["x"], [0.5]) == {"x": None}


@pytest.mark.parametrize("candidates", [4096, 3])
def test_selection_in_several_passes(spark, monkeypatch, candidates):
    """Few candidates force narrowing passes; ties, extremes, infinities and NaN are all right."""
    monkeypatch.setattr(stats, "CANDIDATES", candidates)
    monkeypatch.setattr(stats, "GRID", 50)
    monkeypatch.setattr(stats, "SKETCH", 200)
    monkeypatch.setattr(stats, "SKETCHES", 2)
    rng = np.random.default_rng(3)
    n = 20_000
    data = {"tight": rng.normal(size=n) * 1e-9 + 1, "wide": np.exp(rng.normal(size=n) * 80), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 14),
            "few": rng.integers(0, 3, n).astype(float), "edge": np.where(np.arange(n) < 3, -1e308, rng.random(n))}
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), ", ".join(f"{c} double" for c in data))
    df = df.withColumn("nan", F.when(F.col("few") > 0, F.col("hot")).otherwise(F.lit(float("nan"))))
    data["nan"] = data["hot"][data["few"] > 0]
    probs = [0.0, 0.001, 0.25, 0.5, 0.501, 0.75, 0.9999, 1.0]
    got = stats.exact_quantiles(df.repartition(5), list(data), probs)
    for c, v in data.items():
        assert got[c] == pytest.approx([float(np.quantile(v, p)) for p in probs], rel=1e-12, abs=0)


def test_selection_at_the_default_bounds(spark):
    df = spark.range(200_000).select((F.hash("id") / 7.0).alias("x"))
    want = [float(np.quantile(df.toPandas()["x"], p)) for p in (0.25, 0.75)]
    assert stats.exact_quantiles(df, ["x"], [0.25, 0.75])["x"] == pytest.approx(want, rel=1e-12)
