import random

from pyspark.sql import functions as F

from prepwise.llm import exact

from .brute import exact_groups

ROWS = [(1, "a b c"), (2, "abc"), (3, "a  b\tc\n"), (4, None), (5, ""), (6, "  "), (7, "abd"), (8, "x" * 50_000 + " y"), (9, "x" * 50_000 + "y"),
        (10, "tie a"), (11, "tiea "), (None, "abc"), (12, "é\u00a0é"), (13, "éé"), (12, "é\u00a0é"), (14, "once"), (14, "other")]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_groups_match_brute_force(spark):
    assert found(exact.exact_groups(frame(spark, ROWS))) == exact_groups(ROWS)


def test_collisions_are_chained_and_told_apart_by_bytes(spark):
    weak = found(exact.exact_groups(frame(spark, ROWS), hash_of=lambda n: F.length(n).cast("long")))
    assert weak == exact_groups(ROWS)


def test_exploded_levels_are_not_broadcast(spark):
    # every slot has max_depth + 1 levels, which Spark sizes like the slot itself
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        plan = exact.directory(spark.range(1000).select(F.xxhash64("id").alias("h")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Inner, BuildRight" in plan and "BuildLeft" not in plan


def test_overfull_buckets_split_and_hot_keys_overflow(spark):
    rng = random.Random(1)
    rows = [(i, f"text {rng.randrange(400)}" if i % 3 else "hot copy") for i in range(1500)]
    df = frame(spark, rows, 7)
    assert found(exact.exact_groups(df, bucket_rows=20, max_depth=6)) == exact_groups(rows)
    entries = df.select("doc_id", F.xxhash64("text").alias("h"))
    slots = exact.directory(entries, bucket_rows=20, max_depth=6).collect()
    assert len({r["bucket"] for r in slots}) > 8 and max(r["depth"] for r in slots) == 6
    assert all(r["load"] <= 20 or r["depth"] == 6 for r in slots)
    assert exact.directory(entries, bucket_rows=10**6).select("depth").distinct().collect()[0][0] == 0


def test_empty_table_and_clashing_columns(spark):
    assert exact.exact_groups(frame(spark, [])).count() == 0
    df = frame(spark, ROWS).withColumn("h", F.lit(1)).withColumn("__sha", F.lit("z")).withColumn("norm", F.lit(None).cast("string")).withColumn("kept", F.lit(0))
    assert found(exact.exact_groups(df)) == exact_groups(ROWS)
    stay = exact.drop_exact_duplicates(df)
    assert stay.columns == df.columns
    kept = sorted((r["doc_id"], r["text"]) for r in stay.collect())
    assert [k[0] for k in kept] == sorted(r[0] for r in exact_groups(ROWS) if r[3])
    assert dict(kept)[3] == "a  b\tc\n"
