"""Exact duplicates with an extendible-hash index on shared files.

Every row has an index entry ``(h, sha256, code points, id)``; ``h`` is a 64-bit hash of
the text without spaces.  The directory starts with one bucket; a bucket over capacity
splits by the next bit of ``h`` and the directory doubles when a split goes deeper than it
(``directory``).  Entries are stored by bucket, a bucket that cannot split further (one hot
key) continues on overflow pages.  Owner tasks work on key ranges: entries of one ``h``
are chained, and wherever a chain has several entries their texts are compared byte by byte
(grouping by the bytes themselves, combined on the map side first, so a group of copies
that holds a third of all rows arrives as one row per task).

Defined results: null text counts as empty; a null id sorts after every other id; rows that
repeat an id and text form one group of which one row is kept; an empty table gives an
empty result; other columns of the input are ignored."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Scratch, free_name

MAX_DEPTH = 16
BUCKET_ROWS = 100_000
PAGE_ROWS = 400_000


def normal_text(text: Column) -> Column:
    """The text without the characters of the space class; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+", "")


def default_hash(norm: Column) -> Column:
    return F.xxhash64(norm)


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Extendible-hash directory over the column ``h``.

    Returns ``(slot, depth, bucket, load)`` for each occupied slot of the fully doubled
    directory (at most ``2**max_depth`` rows): the bucket is the shortest prefix of ``h`` whose
    load is within capacity, or the slot itself at ``max_depth``."""
    slots = entries.select(_slot(F.col("h"), max_depth).alias("slot")).groupBy("slot").count()
    levels = slots.select("slot", "count", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth"))
    prefix = F.expr(f"shiftright(slot, {max_depth} - depth)")
    loads = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("count").alias("load"))
    fits = loads.where((F.col("load") <= bucket_rows) | (F.col("depth") == max_depth))
    # fewer than 2**(max_depth + 1) prefixes; Spark sizes the exploded levels lower and would broadcast those
    at = levels.select("slot", "depth", prefix.alias("prefix")).join(F.broadcast(fits), ["depth", "prefix"])
    leaf = at.groupBy("slot").agg(F.min("depth").alias("depth"), F.min_by("load", "depth").alias("load"))
    return leaf.select("slot", "depth", "load", F.expr(f"shiftright(slot, {max_depth} - depth) + shiftleft(1, depth)").alias("bucket"))


def _slot(h: Column, max_depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - max_depth).cast("int")


def build_index(scratch: Scratch, entries: DataFrame, bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Store the entries by bucket and overflow page in the shared folder; returns the stored index."""
    slots = F.broadcast(directory(entries, bucket_rows, max_depth))       # at most 2**max_depth rows
    pages = F.greatest(F.lit(1), F.ceil(F.col("load") / PAGE_ROWS)).cast("int")
    placed = entries.withColumn("slot", _slot(F.col("h"), max_depth)).join(slots, "slot").withColumn(
        "page", F.when(pages > 1, F.pmod(F.hash("doc_id"), pages)).otherwise(0))
    dealt = placed.drop("slot", "load", "depth").repartition("bucket", "page").sortWithinPartitions("bucket", "h")
    return scratch.save(dealt)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=default_hash,
                 bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``.

    Of equal texts the row with the most code points, then the smallest id stays.
    ``hash_of`` maps the normalised text to the long that addresses the index; collisions
    are chained and told apart by their bytes."""
    scratch = Scratch(docs.sparkSession, "exact")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    norm = normal_text(F.col("text"))
    entries = scratch.save(
        source.withColumn("norm", norm).select(
            "doc_id", hash_of(F.col("norm")).alias("h"), F.sha2(F.col("norm"), 256).alias("sha"),
            F.length(F.coalesce("text", F.lit(""))).alias("cp")))
    index = build_index(scratch, entries, bucket_rows, max_depth)
    per_key = index.groupBy("bucket", "h").agg(F.count("*").alias("n"))
    shared = per_key.where("n > 1").select("bucket", "h")
    # chains of several entries: fetch their texts and group by the bytes
    slots = F.broadcast(index.select(_slot(F.col("h"), max_depth).alias("slot"), "bucket").distinct())
    texts = source.withColumn("norm", norm).select(
        "doc_id", "norm", hash_of(F.col("norm")).alias("h"), F.length(F.coalesce("text", F.lit(""))).alias("cp"))
    chained = texts.withColumn("slot", _slot(F.col("h"), max_depth)).join(slots, "slot").join(shared, ["bucket", "h"], "left_semi")
    back = F.coalesce(F.bitwise_not("doc_id"), F.expr("cast('-9223372036854775808' as bigint)"))    # smallest id first, null last
    best = F.max(F.struct("cp", back.alias("back"), "doc_id"))
    groups = scratch.save(
        chained.groupBy("bucket", "h", "norm").agg(F.count("*").alias("group_size"), best.alias("best"))
        .withColumn("sha", F.sha2("norm", 256)))
    clear = groups.groupBy("h", "sha").agg(F.count("*").alias("texts"))
    tied = clear.where("texts > 1").select("h", "sha")                    # equal digests, other bytes
    plain = groups.join(tied, ["h", "sha"], "left_anti").select(
        "h", "sha", "group_size", F.col("best.cp").alias("top"), F.col("best.doc_id").alias("keep_id"))
    rows = entries.groupBy("doc_id", "h", "sha", "cp").agg(F.count("*").alias("times"))
    found = rows.join(plain, ["h", "sha"], "left").join(tied.withColumn("tied", F.lit(True)), ["h", "sha"], "left")
    single = F.col("group_size").isNull()
    settled = found.where(F.col("tied").isNull()).select(
        "doc_id", "sha", "cp", "times",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("top", F.col("cp")).alias("top"))
    clashed = texts.withColumn("sha", F.sha2("norm", 256)).join(tied, ["h", "sha"], "left_semi").join(
        groups.select("h", "sha", "norm", "group_size", "best"), ["h", "sha", "norm"]).groupBy(
        "doc_id", "sha", "cp", "norm").agg(F.count("*").alias("times"), F.first("best").alias("best"), F.first("group_size").alias("group_size")).select(
        "doc_id", "sha", "cp", "times", F.col("best.doc_id").alias("keep_id"), "group_size", F.col("best.cp").alias("top"))
    each = settled.unionByName(clashed).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("cp") == F.col("top")) & (F.col("copy") == 1)
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per group of equal texts, all columns kept."""
    groups = exact_groups(docs, id_col, text_col)
    kept = groups.where("kept").select(F.col("doc_id").alias("__k"), F.col("text_sha256").alias("__s"))
    sha, size = free_name(docs.columns, "__sha"), free_name(docs.columns, "__size")
    marked = docs.withColumn(sha, F.sha2(normal_text(F.col(text_col)), 256)).withColumn(size, F.length(F.coalesce(F.col(text_col), F.lit(""))))
    key = [F.col(id_col).cast("long").eqNullSafe(F.col("__k")), F.col(sha) == F.col("__s")]
    stay = marked.join(kept, key, "left_semi")
    # ids that occur more than once: one row for each id and text, the longest
    several = docs.groupBy(F.col(id_col).cast("long").alias("__m")).count().where("count > 1").select("__m")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__m"))
    once = stay.join(several, same, "left_anti")
    rank = free_name(docs.columns, "__rank")
    w = Window.partitionBy(F.col(id_col), F.col(sha)).orderBy(F.col(size).desc())
    rest = stay.join(several, same, "left_semi").withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).drop(rank)
    return once.unionByName(rest).select(*docs.columns)
