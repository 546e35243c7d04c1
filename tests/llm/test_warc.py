import hashlib

from pyspark.sql import functions as F

from prepwise.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages(spark, n=300):
    rows = [(i, f"http://h/{i}", "<p>" + "x" * (i * 37 % 3000) + "</p>") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_manifest_places(spark):
    df, rows = pages(spark, 50)
    at = 0
    for r, (i, url, html) in zip(warc.manifest(df.repartition(4)).orderBy("ordinal").collect(), rows):
        body = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(html)}\r\n\r\n{html}\r\n\r\n".encode()
        assert (r["page_id"], r["offset"], r["length"], r["digest"]) == (i, at, len(body), hashlib.sha256(body).hexdigest())
        at += len(body)


def test_equal_replicas_have_equal_roots(spark):
    df, _ = pages(spark)
    m = warc.manifest(df)
    assert warc.audit(m, warc.manifest(df.repartition(11))).count() == 0


def test_damage_is_located(spark):
    """Lost, resized, altered and extra records by name; what follows a change of length has moved, what precedes it has not."""
    df, rows = pages(spark, 6000)
    hurt = df.where("page_id not in (17, 4999)").withColumn("html", F.when(F.col("page_id") == 100, F.lit("")).when(
        F.col("page_id").isin(5, 250, 5000), F.concat(F.lit("!"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    hurt = hurt.union(df.limit(1).select(F.lit(5_000_000).cast("long"), "url", "html"))
    got = {r["page_id"]: r["status"] for r in warc.audit_pages(df, hurt).collect()}
    named = {17: "missing", 4999: "missing", 100: "resized", 5: "altered", 250: "altered", 5000: "altered", 5_000_000: "extra"}
    moved = {i: "moved" for i in range(6000) if 17 < i < 4096 or i > 4999}
    assert {i: s for i, s in got.items() if s != "ok"} == moved | named
    assert len(got) == len(rows) + 1


def test_equal_archives_read_no_record(spark):
    """Only ranges of the archive with the damage come down to records, and only from the damage on."""
    from prepwise.llm.common import Scratch
    df, _ = pages(spark, 9000)
    a, b = warc.manifest(df), warc.manifest(df.where("page_id <> 6000"))
    bad = warc.differing_ranges(Scratch(spark, "test"), a, b)
    place = a.where("page_id = 6000").first()
    got = [(r["archive"], r["node"]) for r in bad.collect()]
    assert {x for x, _ in got} == {1} and min(n for _, n in got) == place["offset"] // warc.RANGE_BYTES
    same = warc.differing_ranges(Scratch(spark, "test"), a, warc.manifest(df.repartition(3)))
    assert same.count() == 0


def test_repeated_pages_and_extra_copies(spark):
    rows = [(1, "u", "a"), *[(2, "u", "b")] * 500, (3, "u", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    fewer = spark.createDataFrame(rows[:1] + rows[3:], SCHEMA)
    count = lambda x: {r["status"]: r["count"] for r in x.groupBy("status").count().collect()}      # noqa: E731
    assert count(warc.audit_pages(df, fewer)) == {"ok": 499, "missing": 2, "moved": 1}
    assert count(warc.audit_pages(fewer, df)) == {"ok": 499, "extra": 2, "moved": 1}


def test_extra_records_are_named(spark):
    df, _ = pages(spark, 20)
    a = warc.manifest(df.where("page_id < 15"))
    b = warc.manifest(df)
    assert {(r["ordinal"], r["status"]) for r in warc.audit(a, b).collect()} == {(k, "extra") for k in range(16, 21)}


def test_edges(spark):
    rows = [(None, None, None), (None, "u", "h"), (1, "u", None), (1, "u", None), (2, "u", "é" * 100_000), (3, None, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("archive", F.lit("clash")).withColumn("digest", F.lit(0))
    got = warc.audit_pages(df, df.repartition(5)).collect()
    assert len(got) == len(rows) and {r["status"] for r in got} == {"ok"}
    lost = warc.audit_pages(df, df.where("page_id is null or page_id <> 2")).collect()
    assert [r["page_id"] for r in lost if r["status"] == "missing"] == [2]
    empty = df.limit(0)
    assert warc.audit_pages(empty, empty).count() == 0
    assert {r["status"] for r in warc.audit_pages(df, empty).collect()} == {"missing"}
