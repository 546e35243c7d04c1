"""Cell log of every step, Parquet cuts, typed modes."""
import os
from collections import Counter

from pyspark.sql import functions as F

from prepwise.context import ROW_ID, Context, Role
from prepwise.plans import shared, stats
from prepwise.plans.chain import REGISTRY, CleaningPipeline


def run(df, ctx=None, **steps):
    pipe = CleaningPipeline({c.name: c.name in steps for c in REGISTRY}, steps, log_cells=True)
    fp = pipe.fit(df, ctx or Context.from_schema(df))
    return fp, [tuple(r) for r in fp.cell_log().select("step", "column", "row_id", "original", "new").collect()]


def test_fills_of_all_kinds_are_logged(spark, frame):
    df = frame([(1.0, "a"), (None, "a"), (3.0, None), (None, "b")], "x double, t string").withColumn(ROW_ID, F.monotonically_increasing_id())
    ids = [r[ROW_ID] for r in df.orderBy(ROW_ID).collect()]
    ctx = Context.from_schema(df)
    for strategy, want in (("mean", {ids[1]: "2.0", ids[3]: "2.0"}), ("ffill", {ids[1]: "1.0", ids[3]: "3.0"}), ("interpolate", {ids[1]: "2.0", ids[3]: "3.0"})):
        fp, log = run(df, ctx, missing_handler={"column_overrides": {"x": strategy, "t": "mode"}})
        assert {r[2]: r[4] for r in log if r[1] == "x"} == want
        assert [(r[2], r[3], r[4]) for r in log if r[1] == "t"] == [(ids[2], None, "a")]
        assert "_before" not in fp.result.columns and fp.result.count() == 4


def test_removed_rows_and_binned_cells(spark, frame):
    df = spark.createDataFrame([(i, float(i % 7), "k" if i in (3, 9, 12) else f"r{i}") for i in range(40)], f"{ROW_ID} long, v double, k string")
    ctx = Context.from_schema(df).with_(roles={"v": Role.NUMERIC, "k": Role.TEXT})
    _, log = run(df, ctx, duplicate_handler={"action": "remove", "subset": ["k"]}, binning={"bins": 3, "output_mode": "replace"})
    assert sorted(r[2] for r in log if r[1] is None) == [3, 9, 12]
    binned = [r for r in log if r[0] == "binning"]
    assert len(binned) == 37 and {(r[3], r[4]) for r in binned} == {("0.0", "0"), ("1.0", "0"), ("2.0", "0"), ("3.0", "1"), ("4.0", "1"), ("5.0", "2"), ("6.0", "2")}
    _, log = run(df, ctx, outlier_detector={"action": "remove"}, missing_handler={})
    assert log == []


def test_only_lost_cells_of_conversions_are_logged(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(30)] + [(30, "x7"), (31, None)], f"{ROW_ID} long, n string")
    _, log = run(df, type_detector={})
    assert log == [("type_detector", "n", 30, "x7", None)]


def test_labels_are_logged_and_unchanged_cells_are_not(spark):
    df = spark.createDataFrame([(0, "b", 1), (1, "a", 2), (2, None, 3)], f"{ROW_ID} long, c string, i int")
    ctx = Context.from_schema(df).with_(roles={"c": Role.CATEGORICAL, "i": Role.NUMERIC})
    _, log = run(df, ctx, categorical_encoder={"method": "label"})
    assert sorted(log) == [("categorical_encoder", "c", 0, "b", "1"), ("categorical_encoder", "c", 1, "a", "0")]


def test_cuts_are_tables_and_are_deleted(spark, tmp_path):
    """Awkward names and types survive a cut, later plans read only what they need, nothing is left behind."""
    df = spark.createDataFrame([(1, "a", None, 2.0), (2, "b", None, None)], f"{ROW_ID} long, `a b,;=(x)` string, empty void, `v.w` double")
    before = set(shared._open)
    with shared.scope():
        back = shared.save(df, "test")
        assert back.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
        plan = back.select(ROW_ID)._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<_row_id:bigint>" in plan
        folders = ["/" + p.removeprefix("file:").lstrip("/") for p in set(shared._open) - before]
        assert all(os.path.isdir(p) for p in folders)
    assert set(shared._open) == before and not any(os.path.exists(p) for p in folders)

    rows = [(i, f"t{i % 5}", float(i) if i % 4 else None) for i in range(200)]
    fp = CleaningPipeline().fit(spark.createDataFrame(rows, f"{ROW_ID} long, t string, v double"))
    assert fp.tables and "Scan ExistingRDD" not in fp.result._jdf.queryExecution().executedPlan().toString()
    fp.result.count()
    fp.release()
    assert not fp.tables & set(shared._open)


def test_typed_modes_in_one_job(spark):
    rows = [(9, 10.5, "b", True, "2024-01-02"), (9, 2.5, "a", False, "2023-05-06"), (10, 2.5, "b", False, "2024-01-02"), (10, 10.5, "a", None, "2023-05-06"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string, b boolean, t string").withColumns(
        {"t": F.to_timestamp("t"), "m": F.col("d").cast("decimal(10,2)"), "z": F.when(F.col("i") == 9, -0.0).otherwise(0.0), "nothing": F.lit(None).cast("int")})
    got = stats.typed_modes(df, df.columns)
    assert got == {"i": "9", "d": "2.5", "s": "a", "b": "false", "t": "2023-05-06 00:00:00", "m": "2.50", "z": "0.0", "nothing": None}
    for c in ("i", "d", "s", "b", "m"):
        n = Counter(r[c] for r in df.collect() if r[c] is not None)
        assert n[stats.typed_mode(df, c)] == max(n.values()) and str(stats.typed_mode(df, c)).lower() == got[c]
