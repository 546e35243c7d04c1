"""WARC fixity audit with Merkle trees.

Pages become WARC records in archives; a record's place is its byte range in the archive.
Leaves are ranges of ``RANGE_BYTES`` of offsets: a leaf hashes the ordered ``(ordinal, offset,
page id, length, digest)`` of the records that start in it, an inner node the ordered hashes of
``FAN`` children, up to one root per archive.  Every replica's tree is built of its own places.
Two replicas are compared root by root, and only below nodes that differ are the next level's
nodes, and at last the records, compared.  There records are matched by page id; one with the same
bytes at another place is ``moved``, as all are that follow a lost, longer or extra record.

Defined results: null url or html counts as empty; null page ids go to archives of their own
(dealt by content); repeated rows are records of their own, the k-th of a page matched with the k-th;
a record that only one side has is ``missing`` or ``extra`` (with the replica's place); empty tables give an empty result."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

ARCHIVE_RECORDS = 4096
NULL_ARCHIVES = 1024
RANGE_BYTES = 1 << 16
FAN = 16


def record_text(url: Column, html: Column) -> Column:
    """The bytes of a page's record, as text."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive_of(page_id: Column, record: Column) -> Column:
    by_content = F.lit(-1) - F.pmod(F.xxhash64(record), F.lit(NULL_ARCHIVES))
    return F.coalesce(F.floor(page_id / F.lit(ARCHIVE_RECORDS)), by_content).cast("long")


def manifest(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(archive, ordinal, page_id, tie, offset, length, digest)``: the records of the archives in order; ``tie``
    counts the records of one page.

    Only lengths and digests are ordered, never record bodies; an archive holds
    ``ARCHIVE_RECORDS`` ids."""
    record = record_text(F.col(url_col), F.col(html_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), record.alias("record")).select(
        archive_of(F.col("page_id"), F.col("record")).alias("archive"), "page_id",
        F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("archive").orderBy("page_id", "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("archive", "page_id").orderBy("digest")
    return rows.select("archive", F.row_number().over(order).cast("long").alias("ordinal"), "page_id", F.row_number().over(same).alias("tie"),
                       F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), "length", "digest")


def range_nodes(records: DataFrame) -> DataFrame:
    """Leaves ``(archive, node, hash)`` of records of a manifest."""
    part = F.concat_ws(":", "ordinal", "offset", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "length", "digest")
    rows = records.select("archive", F.floor(F.col("offset") / RANGE_BYTES).alias("node"), F.struct("ordinal", part.alias("part")).alias("row"))
    return _hashed(rows)


def parent_nodes(nodes: DataFrame) -> DataFrame:
    """The level above ``nodes``: at most ``FAN`` children each."""
    part = F.concat_ws(":", "node", "hash")
    rows = nodes.select("archive", F.floor(F.col("node") / FAN).alias("up"), F.struct(F.col("node").alias("ordinal"), part.alias("part")).alias("row"))
    return _hashed(rows.withColumnRenamed("up", "node"))


def _hashed(rows: DataFrame) -> DataFrame:
    ordered = F.transform(F.array_sort(F.collect_list("row")), lambda r: r["part"])
    return rows.groupBy("archive", "node").agg(F.sha2(F.array_join(ordered, "\n"), 256).alias("hash"))


def tree(scratch: Scratch, records: DataFrame, height: int) -> list[DataFrame]:
    """Levels of the trees, leaves first; the last holds one root per archive."""
    levels = [scratch.save(range_nodes(records))]
    for _ in range(height):
        levels.append(scratch.save(parent_nodes(levels[-1])))
    return levels


def differing_ranges(scratch: Scratch, a: DataFrame, b: DataFrame) -> DataFrame:
    """``(archive, node)`` of the leaves that differ, found from the roots down."""
    end = max([0, *(r[0] or 0 for r in (x.agg(F.max("offset")).first() for x in (a, b)))])
    height, ranges = 0, end // RANGE_BYTES + 1
    while ranges > 1:
        height, ranges = height + 1, -(-ranges // FAN)
    left, right = tree(scratch, a, height), tree(scratch, b, height)
    bad = None
    for level in range(height, -1, -1):
        x, y = left[level], right[level]
        if bad is not None:                                # only children of nodes that differ
            up = bad.select("archive", F.col("node").alias("up"))
            x, y = (t.withColumn("up", F.floor(F.col("node") / FAN)).join(up, ["archive", "up"], "left_semi").drop("up") for t in (x, y))
        both = x.join(y.withColumnRenamed("hash", "other"), ["archive", "node"], "full_outer")
        bad = scratch.save(both.where("not (hash <=> other)").select("archive", "node"))
    return bad


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """The records of two manifests that differ: ``(archive, ordinal, page_id, offset, length, digest, status)``
    with the primary's place and digest, of ``extra`` records the replica's."""
    scratch = Scratch(primary.sparkSession, "fixity")
    a, b = scratch.save(primary), scratch.save(replica)
    bad = differing_ranges(scratch, a, b)
    x, y = (t.withColumn("node", F.floor(F.col("offset") / RANGE_BYTES)).join(bad, ["archive", "node"], "left_semi").select(
        "archive", "page_id", "tie", F.struct("ordinal", "offset", "length", "digest").alias(name)) for t, name in ((a, "own"), (b, "other")))
    y = y.select(*[F.col(c).alias(f"y_{c}") for c in ("archive", "page_id", "tie")], "other")
    same = (F.col("archive") == F.col("y_archive")) & F.col("page_id").eqNullSafe(F.col("y_page_id")) & (F.col("tie") == F.col("y_tie"))
    status = F.when(F.col("other").isNull(), "missing").when(F.col("own").isNull(), "extra").when(
        F.col("own.length") != F.col("other.length"), "resized").when(F.col("own.digest") != F.col("other.digest"), "altered").when(
        (F.col("own.offset") != F.col("other.offset")) | (F.col("own.ordinal") != F.col("other.ordinal")), "moved")
    both = x.join(y, same, "full_outer").withColumn("status", status).where("status is not null").withColumn("at", F.coalesce("own", "other"))
    return both.select(F.coalesce("archive", "y_archive").alias("archive"), "at.ordinal", F.when(F.col("own").isNull(), F.col("y_page_id")).otherwise(F.col("page_id")).alias("page_id"),
                       "at.offset", "at.length", "at.digest", "status")


def damaged_copy(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", every: int = 97) -> DataFrame:
    """A second replica with known damage: of each ``every`` ids one record is altered in its first
    letter, one loses its last character and one is lost."""
    r = F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), F.lit(every))
    html = F.coalesce(F.col(html_col), F.lit(""))
    hurt = F.when(r == 3, F.concat(F.lit("~"), F.substring(html, 2, 2**31 - 1))).when(r == 5, F.expr(f"substring({html_col}, 1, length({html_col}) - 1)")).otherwise(html)
    return pages.where(r != 7).withColumn(html_col, hurt)


def audit_pages(pages: DataFrame, replica: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``(page_id, archive, ordinal, start, length, digest, status)`` per record of ``pages`` and per extra record of ``replica``."""
    scratch = Scratch(pages.sparkSession, "archives")
    first = scratch.save(manifest(pages, id_col))
    found = scratch.save(audit(first, manifest(replica, id_col)))
    known = first.join(found.where("status <> 'extra'").select("archive", "ordinal", "status"), ["archive", "ordinal"], "left")
    rows = known.withColumn("status", F.coalesce("status", F.lit("ok"))).unionByName(found.where("status = 'extra'"), allowMissingColumns=True)
    return rows.select("page_id", "archive", "ordinal", F.col("offset").alias("start"), "length", "digest", "status")
