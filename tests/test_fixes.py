"""Faults found in review: each with the smallest table that shows it."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepwise.context import Context, Role
from prepwise.functions import dates, numbers
from prepwise.operators.detect import IdColumnDetector
from prepwise.operators.features import CategoricalEncoder, SkewnessCorrector
from prepwise.operators.missing import MissingHandler
from prepwise.operators.outliers import OutlierDetector
from prepwise.plans import ordered, stats
from prepwise.sources.readers import metadata, read
from prepwise.sources.writers import save


@pytest.mark.parametrize("total", [None, 1, 20_000, 10**12])
def test_buckets_stay_even_whatever_total_is_claimed(spark, total):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    sizes = [r["count"] for r in ordered.bucketize(df, ["k"], 8, total).groupBy(ordered.BUCKET).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes) + 500


def test_quantiles_ignore_nan(spark):
    rows = [(float(i) if i % 10 else float("nan"),) for i in range(100)]
    want = np.quantile([r[0] for r in rows if r[0] == r[0]], [0.5, 0.75]).tolist()
    assert stats.quantiles(spark.createDataFrame(rows, "x double"), ["x"], [0.5, 0.75])["x"] == pytest.approx(want)


@pytest.mark.parametrize("n", [50, 400, 1640, 2000])
def test_sequence_is_found_at_every_size(spark, n):
    # half of the rows are null; 84 % of the steps are 1, the others 5
    vals, at = [], 0
    for i in range(n):
        vals.append(at)
        at += 5 if i % 25 in (3, 9, 15, 21) else 1
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)] * n, "amount int")
    step = IdColumnDetector(check_name_pattern=False, unique_ratio_threshold=2.0)
    assert "amount" in step.fit(df).state["ids"]


def test_uuid_share_counts_all_rows(spark):
    good = "0000000a-0000-4000-8000-00000000000b"
    df = spark.createDataFrame([(i, good if i < 20 else "x") for i in range(100)], "k int, tag string")
    step = IdColumnDetector(check_name_pattern=False, check_sequential=False, unique_ratio_threshold=2.0)
    assert "tag" not in step.fit(df, Context.from_schema(df, ["k"])).state["ids"]


CASES = [("2024-01-05T10:00:00Z", (2024, 1, 5, 10)), ("2024-01-05T10:00:00.123", (2024, 1, 5, 10, 0, 0, 123000)),
         ("2024-01-05 10:00:00+08:00", (2024, 1, 5, 10)), ("2024-01-05 10:00 AM", (2024, 1, 5, 10)), ("2024-01-05 12:30 pm", (2024, 1, 5, 12, 30)),
         ("2024-01-05 12:30 a.m.", (2024, 1, 5, 0, 30)), ("1/5/24", (2024, 1, 5)), ("1/5/99", (1999, 1, 5)), ("Jan 5", (2020, 1, 5)),
         ("5-Jan-2024", (2024, 1, 5)), ("2024.01.05 10:00:00", (2024, 1, 5, 10)), ("2024-01-05T10:00", (2024, 1, 5, 10)),
         ("Fri Jan 5 10:00:00 2024", (2024, 1, 5, 10)), ("January 2024", (2024, 1, 1)), ("2024-01-05 10:00:00.1", (2024, 1, 5, 10, 0, 0, 100000)),
         ("13/2/2024", (2024, 2, 13)), ("2/3/2024", (2024, 2, 3)), ("Friday, January 5th, 2024", (2024, 1, 5)), ("5 September 2024 3:04:05 PM", (2024, 9, 5, 15, 4, 5)),
         ("2024-1", (2024, 1, 1)), ("2024-13-01", None), ("2023-02-29", None), ("hello", None), ("", None), ("2024-01-05 25:00", None), ("14:00 PM x", None)]


def test_general_date_spellings(spark):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", dates.parse_date_text(F.col("s"), 2020).alias("t")).collect()}
    assert got == {s: None if t is None else dt.datetime(*t) for s, t in CASES}


def test_number_with_unicode_blanks(spark):
    df = spark.createDataFrame([("12\u00a0",), ("\u300012",), (" 12 ",), ("1d",)], "s string")
    assert [r[0] for r in df.select(numbers.to_number(F.col("s"))).collect()] == [12.0, 12.0, 12.0, None]


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_json_is_read_whole(spark, tmp_path, layout):
    import json
    rows = [{"k": i, "s": f"é{i}"} for i in range(1000)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps(rows, ensure_ascii=False) if layout == "array" else "\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    back = read(spark, str(path))
    assert back.count() == 1000 and metadata(back, str(path))["rows"] == 1000
    target = str(tmp_path / "out.json")
    save(spark.range(1000).repartition(2), target)
    assert read(spark, target).count() == 1000


def test_csv_line_breaks_are_an_option(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,"x\ny"\n2,z\n', encoding="utf-8")
    assert read(spark, str(path), multi_line=True).count() == 2
    gbk = tmp_path / "t.tsv"
    gbk.write_bytes("a\tb\n1\té\n".encode("latin-1"))
    assert read(spark, str(gbk), encoding="latin-1").first()["b"] == "é"


def test_median_of_an_all_null_column_leaves_it(frame):
    df = frame([(None, 1.0), (None, None), (None, 3.0)], "a double, b double")
    for strategy in ("median", "mean"):
        out, _ = MissingHandler(strategy=strategy).fit_transform(df)
        assert [(r["a"], r["b"]) for r in out.orderBy("_row_id").collect()] == [(None, 1.0), (None, 2.0), (None, 3.0)]


def test_many_categories(frame):
    df = frame([(f"v{i:04d}",) for i in range(1500)], "c string")
    ctx = Context.from_schema(df).with_(roles={"c": Role.CATEGORICAL})
    out, _ = CategoricalEncoder(method="onehot", onehot_max_categories=3000).fit_transform(df, ctx)
    assert len([c for c in out.columns if c.startswith("c_v")]) == 1499
    same, after = CategoricalEncoder(method="onehot", onehot_max_categories=10).fit_transform(df, ctx)
    assert same.columns == df.columns and any("skipped" in e.reason for e in after.events)
    by = [sorted((r["_row_id"], r["c"]) for r in CategoricalEncoder(method="label", small_domain=n).fit_transform(df, ctx)[0].collect()) for n in (10, 5000)]
    assert by[0] == by[1]


def test_lambda_is_the_likelihood_optimum(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(size=2000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    lam = SkewnessCorrector(method="box_cox").fit(df, Context.from_schema(df)).state["columns"]["v"]["lambda"]

    def llf(p):
        y = np.log(x) if abs(p) < 1e-12 else (x ** p - 1) / p
        return (p - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    lo, hi = -1.0, 1.0
    for _ in range(200):
        a, b = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        lo, hi = (lo, b) if llf(a) > llf(b) else (a, hi)
    assert lam == pytest.approx((lo + hi) / 2, abs=1e-6)


def test_forest_flags_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(600, 2)))]
    flags = []
    for parts in (2, 7):
        df = spark.createDataFrame(rows, "k long, a double, b double").repartition(parts)
        ctx = Context.from_schema(df, ["k"]).with_(id_columns=frozenset({"k"}))
        out = OutlierDetector(method="isolation_forest", n_trees=20).fit_transform(df, ctx)[0]
        flags.append({r["k"] for r in out.where("_if_outlier").collect()})
    assert flags[0] == flags[1] and flags[0]


def test_steps_write_events(frame):
    df = frame([(float(i),) for i in range(50)] + [(1000.0,)], "v double")
    _, ctx = OutlierDetector(action="cap").fit_transform(df)
    _, ctx = SkewnessCorrector().fit_transform(df, ctx)
    assert {e.step for e in ctx.events} == {"outlier_detector", "skewness_corrector"} and any("lambda" in e.reason for e in ctx.events)


def test_forest_draws_exact_samples_and_scores_once(spark, tmp_path):
    """Every tree has exactly its rows; the scoring function sees every row once in fit and transform together."""
    from prepwise.operators import forest
    from prepwise.operators.outliers import OutlierDetector
    from prepwise.context import Context
    df = spark.createDataFrame([(i, float(i % 37), float((i * 7919) % 101)) for i in range(3000)], "k long, a double, b double")
    x = F.array("a", "b")
    for parts in (2, 7):
        sample = forest._samples(df.repartition(parts), F.struct("k"), x, 3000, 30, 64, 5)
        counts = {r["tree"]: r["count"] for r in sample.groupBy("tree").count().collect()}
        assert counts == {t: 64 for t in range(30)}
    small = forest._samples(df.limit(70), F.struct("k"), x, 70, 30, 64, 5)
    assert small.count() == 30 * 64
    ctx = Context.from_schema(df, ["k"])
    step = OutlierDetector(method="isolation_forest", n_trees=10)
    fitted = step.fit(df, ctx)
    out, _ = fitted.transform(df, ctx)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    again, _ = fitted.transform(df.select("*"), ctx)                   # other data: scored anew, the same flags
    assert "ArrowEvalPython" in again._jdf.queryExecution().executedPlan().toString()
    flags = lambda d: sorted((r["k"], *[v for c, v in r.asDict().items() if c.endswith("outlier")]) for r in d.collect())     # noqa: E731
    assert flags(out) == flags(again) and out.columns == again.columns


@pytest.mark.parametrize("kind", ["box_cox", "yeo_johnson"])
def test_lambda_matches_a_fine_search(spark, kind):
    """All kinds of columns at once: no neighbour is likelier."""
    from prepwise.operators.features import search_lambda
    rng = np.random.default_rng(8)
    data = {"log": rng.lognormal(size=1500), "half": (rng.normal(5, 1, 1500) ** 2), "tall": 1e6 + rng.gamma(2, 1e5, 1500), "tiny": rng.lognormal(size=1500) * 1e-8,
            "flat": np.full(1500, 3.0)}
    if kind == "yeo_johnson":
        data["both"] = rng.normal(size=1500) ** 3
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), ", ".join(f"`{c}` double" for c in data))
    got = search_lambda(df, list(data), kind, {})

    def llf(x, p):                                      # one-sided values scaled by their mean logarithm: the same optimum without cancellation
        g, l = (np.ones(len(x)), np.log(x)) if kind == "box_cox" else (np.where(x >= 0, 1, -1), np.log1p(np.abs(x)))
        l = l - (l.mean() if (g > 0).all() else 0)
        q = np.where(g > 0, p, 2 - p)
        return (p - 1) * (g * l).sum() - len(x) / 2 * np.log((g * np.expm1(q * l) / q).var())

    for c, x in data.items():
        if c == "flat":
            assert got[c] == 1.0
            continue
        if (kind, c) == ("yeo_johnson", "tiny"):         # 1 + x is 1 to nine places: the optimum lies beyond any useful exponent
            assert got[c] is None
            continue
        assert all(llf(x, got[c]) >= llf(x, got[c] + d) - 1e-9 for d in (-1e-3, 1e-3, -0.1, 0.1)), c


def test_kmeans_by_prefix_sums_equals_plain_iterations(spark, monkeypatch):
    from prepwise.operators import features
    monkeypatch.setattr(features, "CELLS", 7)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, 700), rng.normal(9, 2, 200), np.full(100, 4.25)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(4)
    m = {"min": float(x.min()), "max": float(x.max()), "mean": float(x.mean())}
    edges, settled = features.kmeans_edges(df, "v", 4, m, "mean", 300)
    c = np.linspace(x.min(), x.max(), 5)
    c = (c[1:] + c[:-1]) / 2
    while True:
        code = np.searchsorted((c[1:] + c[:-1]) / 2, x, side="left")
        new = np.array([x[code == k].mean() for k in range(4)])
        done = ((new - c) ** 2).sum() <= 1e-4 * x.var()
        c = new
        if done:
            break
    assert settled and edges == pytest.approx(list((c[1:] + c[:-1]) / 2), rel=1e-9)


def test_long_blank_runs_inside_a_date(spark):
    df = spark.createDataFrame([("March" + " " * 300 + "5,  2021",), ("x" * 400,), ("2021-03-05" + " " * 500,)], "t string")
    got = [r[0] for r in df.select(dates.parse_date_text(F.col("t"), 2024).cast("date").cast("string")).collect()]
    assert got == ["2021-03-05", None, "2021-03-05"]


def test_columns_found_by_content_are_parsed_once_in_the_fit(spark, monkeypatch):
    from prepwise.context import Context
    from prepwise.functions import dates as dt
    from prepwise.operators.dates import DatetimeStandardizer

    asked, parse = [], DatetimeStandardizer._parse
    monkeypatch.setattr(DatetimeStandardizer, "_parse", lambda self, df, c: asked.append(c) or parse(self, df, c))
    df = spark.createDataFrame([("2024年3月5日", "3月 x", "2024/03/05"), ("Mar 5, 2024 7:08 PM", "no", None), (None, "月", "?")], "memo string, note string, day string")
    fitted = DatetimeStandardizer(current_year=2024, detect_by_name=False).fit(df, Context.from_schema(df))
    assert fitted.state == {"columns": ["memo", "day"]} and asked == []
    stamps = df.select(dt.parse_date_text(df.memo, 2024).cast("string")).collect()
    assert [r[0] for r in stamps] == ["2024-03-05 00:00:00", "2024-03-05 19:08:00", None]
    plan = df.select(dt.try_parse(df.memo, 2024))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract(" not in plan                       # groups are not matched one by one


def test_tree_paths_are_walked_as_by_hand():
    import numpy as np

    from prepwise.operators import forest

    rng = np.random.default_rng(3)
    deep = [(0, 0.0, 1, 2, 9), (-1, 0.0, -1, -1, 3), (1, 0.5, 3, 4, 6), (-1, 0.0, -1, -1, 1), (0, 2.0, 5, 6, 5), (-1, 0.0, -1, -1, 2), (-1, 0.0, -1, -1, 3)]
    trees = [deep, [(-1, 0.0, -1, -1, 4)], [(1, 0.0, 1, 2, 5), (-1, 0.0, -1, -1, 1), (-1, 0.0, -1, -1, 4)]]
    X = rng.normal(size=(200, 2)).round(1) * 2
    X[0, 0], X[1, 1], X[2, 0] = np.nan, np.inf, -np.inf

    def path(tree, x):
        j = depth = 0
        while tree[j][0] >= 0:
            j, depth = (tree[j][2] if x[tree[j][0]] < tree[j][1] else tree[j][3]), depth + 1
        return depth + forest._c(tree[j][4])

    arr = forest._stack(trees)
    assert arr["depths"].tolist() == [3, 0, 1]                 # no tree is walked further than it reaches
    want = np.array([[path(t, x) for t in trees] for x in X]).mean(axis=1)
    assert (forest.mean_path_length(X, arr) == want).all()
