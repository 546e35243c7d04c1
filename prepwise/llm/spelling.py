"""Spelling variants: words one edit apart, found by asymmetric chunks, and the frequent form of each.

A word cut into two disjoint chunks keeps one of them under a single edit: the front one in
its place, the back one moved by the difference of the lengths, at most one place.  So one
word of a pair contributes its two chunks, the other one its positional grams at those
places, for a partner of its own length and for one a letter shorter.  The edit then lies in
the rest, so the rest is cut in two by the same argument, which makes a key of about three
quarters of a word: few words share one.  An equi-join on (partner's length, chunk numbers,
letters) meets every pair one edit apart; the edit distance is checked in the join itself.
The shorter word of a pair (of equal lengths the smaller in code-point order) contributes
the chunks.

Only words and their counts are shuffled: occurrences are counted map-side first, so a word
with a third of all occurrences is one row per task.  Forms are followed by pointer jumping;
a form is ten times as frequent as its word, so 64-bit counts allow at most 19 steps, five jumps.

Defined results: a null text has no words; a null id counts as empty in the damage key; empty
texts and an empty table give no rows; repeated rows count as often as they occur; other
columns of the table are not read; long texts are taken whole."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10
DAMAGE = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, damage: int | None = DAMAGE) -> DataFrame:
    """``(word, n)``: lower-cased (A-Z) maximal runs of letters; every ``damage``-th occurrence by the crc32
    of ``id:run`` loses one letter.  Runs below ``min_length`` cannot count and are not extracted."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]{{{min_length},}})"), F.lit(1))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    if damage:
        found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        found = found.withColumn("run", F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")))
    counts = found.where(F.length("run") >= min_length).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _keys(length: Column, shift: int) -> list[Column]:
    """The keys that a word one edit away from a word of ``length`` shares with it, cut out of ``word``, which
    is ``shift`` letters longer than that: a kept chunk and a kept chunk of the rest."""
    half = _half(length)
    keys = []
    for part in (0, 1):
        kept = (F.lit(0), half) if part == 0 else (half + shift, length - half)      # behind the edit, places move by the shift
        rest = (half, length - half) if part == 0 else (F.lit(0), half)
        for sub in (0, 1):
            inner = _half(rest[1])
            again = (rest[0], inner) if sub == 0 else (rest[0] + inner + shift, rest[1] - inner)
            grams = [F.substring("word", start + 1, size) for start, size in (kept, again)]
            keys.append(F.struct(length.alias("size"), F.lit(2 * part + sub).alias("part"), *[g.alias(f"gram{i}") for i, g in enumerate(grams)]))
    return keys


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of distinct words of ``(word, n)`` one edit apart, once."""
    length = F.length("word")
    key = ["size", "part", "gram0", "gram1"]
    a = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(F.array(*_keys(length, 0))).alias("k")).select("a", "a_n", "k.*")
    grams = F.array(*_keys(length, 0), *_keys(length - 1, 1))
    b = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.explode(grams).alias("k")).select("b", "b_n", "k.*")
    ordered = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
    met = a.join(b, key).where(ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)`` by pointer jumping."""
    roots = scratch.save(forms.select("word", F.col("form").alias("root")))
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = scratch.save(roots.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(roots)
        roots = after.select("word", "root")
        if not after.where("moved").limit(1).count():
            return roots


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, **counting) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per word.

    ``form`` is the near word of the largest count (ties: the smallest in code-point order) if it is at least
    ``times`` as frequent, ``root`` the last word along the forms.  ``times`` above 1 keeps the forms free of cycles."""
    if times <= 1:
        raise ValueError("times must be above 1")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(word_counts(docs, id_col, text_col, **counting))
    pairs = near_pairs(words)
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("e")).select("e.*")
    best = ends.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    big = -F.col("best.m") >= F.col("n") * times
    table = scratch.save(words.join(best, "word", "left").select(
        "word", F.when(big, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, -F.col("best.m")).alias("form_n")))
    scratch.drop(words)
    roots = _roots(scratch, table.where("form IS NOT NULL"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
