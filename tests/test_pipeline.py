"""Pipeline surface (L1–L6), change log (R10–R15), streaming reuse, sources/sinks."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import prepwise
from prepwise.context import ROW_ID, Context, Role
from prepwise.plans import changelog
from prepwise.plans.chain import CleaningPipeline
from prepwise.sources.readers import load, prepare, read
from prepwise.sources.writers import save
from prepwise.streaming.apply import apply_to_stream

ROWS = [(f" Ｉｔｅｍ{i} ", f"{i % 4 + 1}kg", f"{(i % 10) * 5}%", "2024年1月%d日" % (i % 28 + 1),
         None if i % 9 == 0 else float(i % 17)) for i in range(60)]
SCHEMA = "`Name ` string, `Weight` string, `Share` string, `Order Date` string, `Score` double"


def test_catalogue_lists_twenty_steps_in_order():
    cat = prepwise.steps()
    assert [c["name"] for c in cat][:3] == ["encoding_normalizer", "column_name_cleaner", "type_detector"]
    assert len(cat) == 20 and cat[-1]["name"] == "profiler"
    assert {c["name"] for c in cat if not c["default_on"]} == {
        "value_replacer", "feature_scaler", "skewness_corrector", "binning", "categorical_encoder",
        "correlation_analyzer"}


def test_unknown_parameter_and_step_raise():
    with pytest.raises(TypeError):
        CleaningPipeline(step_configs={"binning": {"nope": 1}})
    with pytest.raises(ValueError):
        CleaningPipeline(enabled_steps={"no_such_step": True})


def test_default_run_end_to_end(frame):
    df, ctx = prepare(frame(ROWS, SCHEMA, row_id=False))
    fp = CleaningPipeline(log_cells=True).fit(df, ctx)
    out = fp.result
    assert "Weight(kg)" in out.columns and "Name" in out.columns and "Order_Date" in out.columns
    assert fp.context.roles["Share"] == Role.NUMERIC
    shares = {r[0] for r in out.select("Share").collect()}
    assert shares <= {x / 100 for x in range(0, 50, 5)}
    assert {r[0] for r in out.select("Order_Date").distinct().collect()} <= {f"2024-01-{d:02d}" for d in range(1, 29)}
    assert out.where(F.col("Score").isNull()).count() == 0          # filled
    assert out.select("Name").first()[0].startswith("Item")            # full width + trim
    prof = fp.profile()
    assert prof.count() == len([c for c in out.columns if c != ROW_ID])
    log = fp.cell_log()
    counts = {r["step"]: r["changes"] for r in changelog.changes_per_step(log).collect()}
    assert counts["encoding_normalizer"] == 60


def test_fitted_pipeline_applies_to_new_data_without_refit(frame):
    df, ctx = prepare(frame(ROWS, SCHEMA, row_id=False))
    pipe = CleaningPipeline(enabled_steps={"duplicate_handler": False, "missing_handler": False})
    fp = pipe.fit(df, ctx)
    new, nctx = prepare(frame(ROWS[:5], SCHEMA, row_id=False))
    out, _ = fp.transform(new, nctx)
    assert out.columns == fp.result.columns and out.count() == 5


def test_streaming_reuses_row_local_steps(spark):
    src = "/root/testdata/sf0.001"
    batch = spark.read.parquet(f"{src}/events.parquet")
    ctx = Context.from_schema(batch).with_(id_columns=frozenset({"event_id"}))
    pipe = CleaningPipeline(enabled_steps={"type_detector": False, "id_column_detector": False,
                                           "duplicate_handler": False, "missing_handler": False,
                                           "constant_remover": False, "datetime_standardizer": False,
                                           "encoding_normalizer": False, "text_standardizer": False,
                                           "profiler": False})
    fp = pipe.fit(batch, ctx)
    import shutil
    folder = tempfile.mkdtemp(prefix="prepwise-stream-")
    shutil.copy(f"{src}/events.parquet", os.path.join(folder, "part-0.parquet"))
    stream = spark.readStream.schema(batch.schema).parquet(folder)
    out, _ = apply_to_stream(fp, stream, ctx)
    q = out.writeStream.format("memory").queryName("prep_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM prep_stream")
    assert got.count() == batch.count() and "value_outlier" in got.columns


def test_order_based_step_refuses_streams(spark):
    from prepwise.operators.values import DuplicateHandler
    import shutil
    src = "/root/testdata/sf0.001/events.parquet"
    folder = tempfile.mkdtemp(prefix="prepwise-stream-")
    shutil.copy(src, os.path.join(folder, "part-0.parquet"))
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(folder)
    f = DuplicateHandler().fit(spark.read.parquet(src))
    with pytest.raises(ValueError):
        f.transform(stream)


@pytest.mark.parametrize("ext", ["csv", "tsv", "json", "parquet"])
def test_write_then_read_roundtrip(spark, frame, ext):
    df = frame([(1, "a", 1.5), (2, "N/A", None)], "i int, s string, d double")
    path = os.path.join(tempfile.mkdtemp(prefix="prepwise-io-"), f"out.{ext}")
    meta = save(df, path)
    assert meta["rows"] == 2 and meta["cols"] == 3
    back, ctx, info = load(spark, path)
    assert info["rows"] == 2 and ROW_ID in back.columns
    vals = {r["s"] for r in back.collect()}
    assert "a" in vals and ("N/A" in vals or None in vals)


def test_unknown_extension_reads_as_csv(spark):
    d = tempfile.mkdtemp(prefix="prepwise-io-")
    p = os.path.join(d, "data.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("a,b\n1,x\n2,NULL\n")
    df = read(spark, p)
    assert df.count() == 2 and df.where("b IS NULL").count() == 1


def test_preview_page(frame):
    df = frame([(i,) for i in range(250)], "k int")
    page = df.orderBy("k").offset(100).limit(100)
    assert [r[0] for r in page.collect()] == list(range(100, 200))


def test_clean_one_call_and_report(spark):
    d = tempfile.mkdtemp(prefix="prepwise-clean-")
    path = os.path.join(d, "in.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("id,Weight,Score\n")
        for i in range(40):
            fh.write(f"{i},{i % 5 + 1}kg,{'' if i % 7 == 0 else (i * 17) % 23 + 0.5}\n")
    fp = prepwise.clean(spark, path, enable=["feature_scaler"], skip=["duplicate_handler"],
                        outlier_action="cap", scaler_method="minmax")
    out = fp.result
    assert "Weight(kg)" in out.columns and out.count() == 40
    mx = out.agg(F.max("Score"), F.min("Score")).first()
    assert mx[0] == pytest.approx(1.0) and mx[1] == pytest.approx(0.0)
    rep = changelog.report(fp.profile(), fp.context.events, shape=[out.count(), len(out.columns)], metadata=fp.meta)
    target = os.path.join(d, "report.json")
    changelog.write_report(spark, rep, target, fp.cell_log())
    import json
    loaded = json.loads(spark.read.text(target).first()[0])
    assert loaded["metadata"]["rows"] == 40 and all(0 <= c["missing_ratio"] <= 1 for c in loaded["columns"])
    assert spark.read.schema(changelog.LOG_SCHEMA).json(target + "-cells").count() == fp.cell_log().count()
    assert {c["column"] for c in loaded["columns"]} >= {"id", "Weight(kg)", "Score"}
    assert fp.meta["rows"] == 40 and fp.meta["extension"] == ".csv"


def test_bad_regex_rule_raises_early():
    from prepwise.operators.values import ValueReplacer
    with pytest.raises(ValueError):
        ValueReplacer(custom_rules=[("(", "x", True, None)])


def test_stream_file_sink(spark):
    import shutil
    from prepwise.streaming.apply import write_stream
    src = "/root/testdata/sf0.001/events.parquet"
    folder = tempfile.mkdtemp(prefix="prepwise-stream-")
    shutil.copy(src, os.path.join(folder, "part-0.parquet"))
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(folder).select("event_id", "value")
    out = os.path.join(tempfile.mkdtemp(prefix="prepwise-sink-"), "events")
    q = write_stream(stream, out, "sink_test")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == spark.read.parquet(src).count()
