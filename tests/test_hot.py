"""Hot keys: even tasks without AQE, digests with a byte check, hash aggregates."""
from statistics import median

import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepwise.context import ROW_ID
from prepwise.operators import features, values
from prepwise.operators.values import DuplicateHandler
from prepwise.plans.hot import lookup


@pytest.fixture
def plain_shuffles(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=80_000):
    """Nine tenths of the rows hold one value."""
    return spark.range(n).select(F.col("id").alias(ROW_ID), F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 4000)).alias("v"))


def tasks(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_lookup_deals_hot_rows_out(spark, plain_shuffles):
    df = hot_rows(spark)
    table = df.groupBy("v").agg(F.count("*").alias("n"), F.min(ROW_ID).alias("first")).where("v <> 'v10'")
    out = lookup(df, table, ["v"], ["first"], "n")
    sizes = tasks(out)
    assert max(sizes) < 2 * median(sizes)
    want = df.join(F.broadcast(table.select("v", "first")), "v", "left").select(ROW_ID, "v", "first")
    assert out.select(ROW_ID, "v", "first").exceptAll(want).isEmpty() and out.count() == df.count()


def test_mark_and_label_tasks_are_even(spark, plain_shuffles):
    df = hot_rows(spark)
    marked = DuplicateHandler(action="mark", subset=["v"]).fit_transform(df)[0]
    assert marked.where("_is_duplicate").count() == df.groupBy("v").count().where("count > 1").agg(F.sum("count")).first()[0]
    coded = features.label_by_join(df, "v")
    for out in (marked, coded):
        sizes = tasks(out)
        assert max(sizes) < 2 * median(sizes)
    codes = {r["v"]: r["code"] for r in df.select("v", ROW_ID).join(coded.select(ROW_ID, F.col("v").alias("code")), ROW_ID).distinct().select("v", "code").distinct().collect()}
    assert [codes[v] for v in sorted(codes)] == list(range(len(codes)))


def test_duplicates_use_hash_aggregates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0), (3, None, 2.0)], f"{ROW_ID} long, a string, b double")
    plan = values.duplicate_digests(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    for action in ("remove", "keep_first", "keep_last", "mark"):
        out = DuplicateHandler(action=action).fit_transform(df)[0]
        assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


ROWS = [(i, a, b, c) for i, (a, b, c) in enumerate([("x", None, 1.0), (None, "x", 1.0), ("x", None, 1.0), ("x", None, -0.0), ("x", None, 0.0), ("y", "", float("nan")),
                                                  ("y", "", float("nan")), ("y", None, 2.0), (None, None, None), (None, None, None), ("z", "z", 3.0)])]


def expected(action):
    keyed = {}
    for r in ROWS:
        keyed.setdefault(tuple("nan" if x != x else x + 0 if isinstance(x, float) else x for x in r[1:]), []).append(r[0])
    if action == "mark":
        return sorted(i for g in keyed.values() if len(g) > 1 for i in g)
    return sorted(g[0] if action == "keep_first" else g[-1] for g in keyed.values() if action != "remove" or len(g) == 1)


@pytest.mark.parametrize("action", ["mark", "remove", "keep_first", "keep_last"])
@pytest.mark.parametrize("collide", [False, True])
def test_duplicates_with_nulls_and_colliding_digests(spark, monkeypatch, action, collide):
    if collide:                                    # every digest alike: the byte check must send the rows the plain way
        monkeypatch.setattr(values, "_digested", lambda df, keys: df.withColumns({d: F.lit(1).cast("long") for d in values._DIGEST}))
    df = spark.createDataFrame(ROWS, f"{ROW_ID} long, a string, b string, c double").repartition(3)
    out = DuplicateHandler(action=action).fit_transform(df)[0]
    got = sorted(r[ROW_ID] for r in (out.where("_is_duplicate") if action == "mark" else out).collect())
    assert got == expected(action)
    assert out.columns[:4] == [ROW_ID, "a", "b", "c"]


def test_other_order_than_the_row_id(spark):
    from prepwise.context import Context
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 1)], f"{ROW_ID} long, k string, t int")
    ctx = Context.from_schema(df, ["t"])
    first = DuplicateHandler(action="keep_first", subset=["k"]).fit_transform(df, ctx)[0]
    assert sorted(r["t"] for r in first.collect()) == [1, 3]


def test_spearman_with_a_hot_value(spark, plain_shuffles):
    from prepwise.operators.analysis import spearman_pairs
    pdf = pd.DataFrame({"a": [0.0] * 900 + list(range(100)), "b": list(range(1000)), "c": [float(i % 7) for i in range(1000)]})
    got = {(r["col_a"], r["col_b"]): r["r"] for r in spearman_pairs(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    want = pdf.rank().corr()                       # Pearson of average ranks
    assert all(got[p] == pytest.approx(want.loc[p], abs=1e-12) for p in got) and len(got) == 3
