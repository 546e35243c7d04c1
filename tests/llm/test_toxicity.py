import numpy as np
from pyspark.sql import functions as F

from prepwise.llm import toxicity
from prepwise.llm.common import Scratch

SF = "/root/testdata/sf0.1"


def test_slots_follow_the_distinct_ngrams():
    seen = {}
    for text in ("Hello  World", "hello\tworld ", "漢字 é", "a", "x" * 3000):
        clean = " " + " ".join(text.lower().split()) + " "
        grams = {clean[i:i + n] for n in toxicity.ORDERS for i in range(len(clean) - n + 1)}
        found = toxicity.Distinct().of(toxicity.slots(text))
        assert len(found) <= len(grams) and len(found) >= len(grams) - 1
        seen[text] = found.tolist()
    assert seen["Hello  World"] == seen["hello\tworld "]
    assert len(toxicity.slots(None)) == len(toxicity.slots(" \n ")) == 0


def test_long_text_is_hashed_whole(monkeypatch):
    text = " ".join(f"w{i}" for i in range(4000))
    whole = np.unique(toxicity.slots(text))
    monkeypatch.setattr(toxicity, "_CHUNK", 1000)
    assert (np.unique(toxicity.slots(text)) == whole).all()


def test_fit_is_a_minimum():
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(40) < 0.3) for _ in range(120)]
    y = np.array([int((r < 5).sum() > 1) for r in rows])
    ratio = rng.normal(size=40)
    w, b = toxicity.fit_linear(rows, y, ratio, steps=3000)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())

    def loss(v, c):
        z = np.array([(v[r] * ratio[r]).sum() + c for r in rows])
        return (weight * np.logaddexp(0, np.where(y > 0, -z, z))).sum() + 0.5 / len(rows) * (v * v).sum()

    v = w / ratio
    best = loss(v, b)
    for _ in range(50):
        assert loss(v + rng.normal(size=40) * 0.01, b + rng.normal() * 0.01) >= best - 1e-7


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.score_documents(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    right = (got["predicted"] == got["toxic"]).groupby(got["toxic"]).mean()
    # about a third of the toxic labels of this table stand on texts without any sign of it
    assert len(got) > 500 and right[0] > 0.98 and right[1] > 0.6
    assert got["score"].between(0, 1).all()


def test_edges(spark):
    docs = [(i, "you scum trash" if i % 2 else "nice warm day") for i in range(60)] + [(None, "scum trash"), (100, None), (101, ""), (1, "you scum trash"), (102, "day " * 20_000)]
    labels = [(i, i % 2) for i in range(60)] + [(1, 0), (2, None), (None, 1), (500, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("toxic", F.lit(5)).withColumn("__score", F.lit("k")).withColumn("feats", F.lit(0))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.score_documents(d, lab).toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all() and got[got["doc_id"].isna()]["held_out"].all()
    assert got[got["doc_id"] < 60].apply(lambda r: r["predicted"] == r["doc_id"] % 2, axis=1).all()
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns and not any("scum" in (r["text"] or "") for r in kept.collect())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.score_documents(d, none).collect())
    one = lab.where("toxic = 0 and doc_id <> 1")
    assert all(r["predicted"] == 0 for r in toxicity.score_documents(d, one).collect())
    assert toxicity.score_documents(d.limit(0), lab).count() == 0


def test_only_training_folds_are_learned(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    a = toxicity.train(Scratch(spark, "t"), docs, labels)
    from prepwise.llm.common import residue
    flipped = labels.withColumn("toxic", F.when(residue(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    b = toxicity.train(Scratch(spark, "t"), docs, flipped)
    assert (a[0] == b[0]).all() and a[1] == b[1]
