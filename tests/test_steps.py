"""Properties of the fit/transform steps and edge sizes."""
import math

import pytest
from pyspark.sql import functions as F

from prepwise.context import ROW_ID, Context, Role
from prepwise.operators.analysis import pearson_pairs, profile, spearman_pairs, vif
from prepwise.operators.detect import IdColumnDetector, TypeDetector
from prepwise.operators.features import (Binning, CategoricalEncoder, FeatureScaler, SkewnessCorrector,
                                         search_lambda)
from prepwise.operators.missing import MissingHandler
from prepwise.operators.outliers import OutlierDetector
from prepwise.operators.values import ConstantRemover, DuplicateHandler


def num_ctx(df, cols):
    return Context.from_schema(df).with_(roles={**Context.from_schema(df).roles, **{c: Role.NUMERIC for c in cols}})


def test_dedup_counts_add_up(frame):
    rows = [(i % 5, i % 3, i) for i in range(30)] + [(1, 1, 100), (1, 1, 100)]
    df = frame(rows, "a int, b int, c int")
    n = df.count()
    groups = df.groupBy("a", "b").count()
    singles = groups.where("count = 1").count()
    kinds = groups.count()
    first, _ = DuplicateHandler(action="keep_first", subset=["a", "b"]).fit_transform(df)
    removed, _ = DuplicateHandler(action="remove", subset=["a", "b"]).fit_transform(df)
    marked, _ = DuplicateHandler(action="mark", subset=["a", "b"]).fit_transform(df)
    assert first.count() == kinds and removed.count() == singles
    assert marked.count() == n and marked.where("_is_duplicate").count() == n - singles
    again, _ = DuplicateHandler(action="keep_first", subset=["a", "b"]).fit_transform(first)
    assert again.count() == first.count()                        # idempotent


def test_dedup_nulls_are_equal_and_keep_first_is_lowest(frame):
    df = frame([(None, 1), (None, 2), (3, 4)], "a int, b int")
    out, _ = DuplicateHandler(action="keep_first", subset=["a"]).fit_transform(df)
    assert {(r["a"], r["b"]) for r in out.collect()} == {(None, 1), (3, 4)}
    last, _ = DuplicateHandler(action="keep_last", subset=["a"]).fit_transform(df)
    assert {(r["a"], r["b"]) for r in last.collect()} == {(None, 2), (3, 4)}


def test_constant_columns(frame):
    df = frame([(1, 1, None, i, None if i else 5) for i in range(40)], "k int, s int, z string, v int, rare int")
    f = ConstantRemover().fit(df)
    assert set(f.state["drop"]) == {"k", "s", "z", "rare"}


def test_scaler_standard_mean0_std1(frame):
    df = frame([(float(i * i),) for i in range(50)], "x double")
    out, _ = FeatureScaler().fit_transform(df, num_ctx(df, ["x"]))
    r = out.agg(F.avg("x"), F.stddev_samp("x")).first()
    assert abs(r[0]) < 1e-9 and abs(r[1] - 1) < 1e-9


def test_iqr_flags_planted_extremes_and_always_emits_flags(frame):
    df = frame([(float(i % 10),) for i in range(100)] + [(1000.0,), (-1000.0,)], "x double")
    out, _ = OutlierDetector().fit_transform(df, num_ctx(df, ["x"]))
    assert out.where("x_outlier").count() == 2
    calm = frame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    out, _ = OutlierDetector().fit_transform(calm, num_ctx(calm, ["x"]))
    assert "x_outlier" in out.columns and out.where("x_outlier").count() == 0


def test_zscore_cap_uses_sample_std(frame):
    df = frame([(0.0,)] * 30 + [(100.0,)], "x double")
    out, _ = OutlierDetector(method="zscore", action="cap").fit_transform(df, num_ctx(df, ["x"]))
    mx = out.agg(F.max("x")).first()[0]
    mean = 100 / 31
    sd = math.sqrt(sum((v - mean) ** 2 for v in [0.0] * 30 + [100.0]) / 30)
    assert mx == pytest.approx(mean + 3 * sd)


def test_forest_flags_contamination_share_and_extremes(frame):
    import random
    random.seed(1)
    rows = [(random.gauss(0, 1), random.gauss(0, 1)) for _ in range(600)] + [(30.0, 30.0), (-30.0, 25.0)]
    df = frame(rows, "a double, b double")
    out, _ = OutlierDetector(method="isolation_forest").fit_transform(df, num_ctx(df, ["a", "b"]))
    flagged = out.where("_if_outlier")
    share = flagged.count() / out.count()
    assert 0.03 <= share <= 0.07
    assert flagged.where("abs(a) > 20").count() == 2


def test_lambda_search_beats_neighbours(spark, frame):
    import numpy as np
    rng = np.random.default_rng(3)
    df = frame([(float(v),) for v in rng.lognormal(size=400)], "x double")
    lam = search_lambda(df, ["x"], "box_cox", {})["x"]
    xs = [r[0] for r in df.collect()]

    def llf(l):
        y = [math.log(x) if abs(l) < 1e-12 else (x ** l - 1) / l for x in xs]
        m = sum(y) / len(y)
        var = sum((v - m) ** 2 for v in y) / len(y)
        return (l - 1) * sum(math.log(x) for x in xs) - len(xs) / 2 * math.log(var)
    assert llf(lam) >= llf(lam + 0.05) and llf(lam) >= llf(lam - 0.05)
    assert abs(lam) < 0.2          # log-normal data: λ near 0


def test_skew_gate_skips_symmetric(frame):
    df = frame([(float(i),) for i in range(30)], "x double")
    f = SkewnessCorrector(method="log").fit(df, num_ctx(df, ["x"]))
    assert f.state["columns"] == {}


def test_kmeans_bins_separate_clusters(frame):
    vals = [1.0, 1.1, 0.9] * 5 + [20.0, 20.2] * 5 + [50.0, 51.0] * 5
    df = frame([(v,) for v in vals], "x double")
    out, _ = Binning(method="kmeans", bins=3).fit_transform(df, num_ctx(df, ["x"]))
    codes = {r["x"]: r["x_bin"] for r in
             df.join(out, ROW_ID).select(df["x"], out["x_bin"]).distinct().collect()}
    assert codes[1.0] == 0 and codes[20.0] == 1 and codes[50.0] == 2


def test_label_encoding_large_domain_uses_join(frame):
    df = frame([(f"v{i % 40:03d}",) for i in range(200)], "c string")
    ctx = Context.from_schema(df).with_(roles={"c": Role.CATEGORICAL})
    out, _ = CategoricalEncoder(method="label", small_domain=5).fit_transform(df, ctx)
    got = {r["c"] for r in out.select("c").distinct().collect()}
    assert got == set(range(40))


def test_spearman_equals_pearson_of_ranks_and_vif(frame):
    rows = [(float(i), float(i * i), float((i * 7) % 11)) for i in range(1, 40)]
    df = frame(rows, "a double, b double, c double")
    sp = {(r["col_a"], r["col_b"]): r["r"] for r in spearman_pairs(df, ["a", "b", "c"]).collect()}
    assert sp[("a", "b")] == pytest.approx(1.0)
    pe = {(r["col_a"], r["col_b"]): r["r"] for r in pearson_pairs(df, ["a", "b"]).collect()}
    assert pe[("a", "b")] < 1.0
    v = dict(vif(df, ["a", "b", "c"]))
    assert all(x >= 1.0 for x in v.values())


def test_missing_walk_sees_earlier_row_drops(frame):
    rows = [(None if i % 2 else "x", None if i % 4 == 0 else float(i)) for i in range(20)]
    df = frame(rows, "t string, v double")
    ctx = Context.from_schema(df).with_(roles={"t": Role.TEXT, "v": Role.NUMERIC})
    f = MissingHandler().fit(df, ctx)
    plan = {a["column"]: a for a in f.state["plan"]}
    assert plan["t"]["strategy"] == "drop_rows"
    # after dropping odd rows, v is missing in 5 of the 10 remaining rows → 0.5 → drop rows (> 0.3)
    assert plan["v"]["strategy"] == "drop_rows" and plan["v"]["rows"] == 10


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1.0, "a")]])
def test_edge_sizes(frame, rows):
    df = frame(rows, "x double, s string")
    ctx = Context.from_schema(df)
    for step in [TypeDetector(), IdColumnDetector(), ConstantRemover(), OutlierDetector(),
                 MissingHandler(), FeatureScaler(), Binning(), SkewnessCorrector()]:
        out, ctx2 = step.fit_transform(df, ctx)
        out.collect()
    p = profile(df)
    assert p.count() == 2


def test_long_texts_go_to_python_in_small_batches(spark):
    import pandas as pd
    from pyspark.sql import functions as F

    from prepwise.context import Context, Role
    from prepwise.operators.text_steps import EncodingNormalizer, TextStandardizer
    from prepwise.session import BATCH_BYTES, bound_batches

    @F.pandas_udf("long")
    def batch(s: pd.Series) -> pd.Series:
        return pd.Series([int(s.str.len().sum())] * len(s))

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(3000, numPartitions=1).select("id", F.repeat(F.lit("é b'c "), 1000).alias("text"))
    try:
        for step in (TextStandardizer(remove_accents=False, case="title"), EncodingNormalizer()):
            spark.conf.unset(key)
            out = step.fit_transform(texts, Context.from_schema(texts).with_(roles={"text": Role.TEXT}))[0]
            assert out.select(F.max(batch("text"))).first()[0] < 2 * BATCH_BYTES
            assert out.select("text").distinct().count() == 1
        spark.conf.set(key, "1000")
        bound_batches(spark)
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.unset(key)
