import random

import numpy as np
from pyspark.sql import functions as F

from prepwise.llm import simhash

from .brute import fingerprint, simhash_components


def test_fingerprint_matches_definition():
    rng = random.Random(0)
    texts = [None, "", " \t", "One", "one TWO", "a b c", "É Ü é", "a b c a b c a b c", " ".join(f"w{rng.randrange(50)}" for _ in range(70_000))]
    for t in texts[:-1]:
        assert simhash.fingerprint(t) == fingerprint(t)
    assert simhash.fingerprint("A  b\nC") == simhash.fingerprint("a b c")
    assert 0 < simhash.fingerprint(texts[-1]) < 2**64


def test_engine_hash_agrees(spark):
    import xxhash
    texts = ["", "a", "abc def ghi", "x" * 31, "y" * 32, "z" * 77, "é漢字"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] % 2**64 for r in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


def test_pairs_match_all_pairs_comparison(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    prints = set(base)
    for b in base:
        for _ in range(8):
            x = b
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    nodes = spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "node long, fp long")
    for bits, segments in ((2, 8), (3, 4), (1, 1)):
        want = {(a, b) for a in range(len(prints)) for b in range(a + 1, len(prints)) if bin(prints[a] ^ prints[b]).count("1") <= bits}
        got = [tuple(sorted(r)) for r in simhash.near_pairs(nodes, bits, segments).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_exploded_probes_are_not_broadcast(spark):
    # every node has 73 probes, which Spark sizes like the node itself
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        nodes = spark.range(1000).select(F.col("id").alias("node"), F.xxhash64("id").alias("fp"))
        plan = simhash.near_pairs(nodes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_and_edge_cases(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(400))) for i in range(20)]
    for i in range(20, 50):                                    # near copies: a word or two changed
        t = rows[rng.randrange(20)][1].split(" ")
        t[rng.randrange(400)] = "changed"
        rows.append((i, " ".join(t)))
    rows += [(60, None), (61, ""), (62, "\n"), (63, "short"), (64, "short"), (65, rows[0][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("component", F.lit("x"))
    prints, want = simhash_components(rows)
    got = simhash.near_duplicates(df.repartition(5)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    stay = simhash.drop_near_duplicates(df)
    assert stay.columns == df.columns and sorted(r["doc_id"] for r in stay.collect()) == sorted(set(want.values()))


def test_nulls_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "alone in here"), (8, "zz")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5
    assert sorted(r["component_id"] for r in got if r["component_id"] is not None) == [7, 7, 7, 8]
    assert sorted(r["text"] for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, schema)).collect()) == ["a b c d", "alone in here", "zz"]
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
