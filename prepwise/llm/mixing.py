"""Mixing sources to target weights with pivotal dependent rounding.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share the
words of all documents; a target stops at ``CAP`` times its source's words and the excess is
reshared by weight (water-filling).  A source's documents are all wanted ``rate = target /
source words`` times: the whole part is taken outright, the fraction is a copy probability
that pivotal rounding makes 0 or 1.  Two fractions trade *words*: what one document
gains in expected words the other loses, until one of them is integral, with odds that leave
every expectation unchanged.  One fraction is left per block; the leftovers of blocks
meet in a reduction tree of the same step until one is left per source, which goes to the
nearer end.  Long documents trade first, so that what is left is a short one as a rule, and a
source misses its target by at most half of one document.

Defined results: null text has size 0; documents of size 0 are taken as whole copies by
their own probability (0 words); a null source is a source of its own; repeated ids are
documents of their own (told apart by a tie number); an empty table gives an empty
result.  Draws come from a hash of seed, source and id, so reruns agree."""
from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Scratch, free_name

WEIGHTS = (1, 2, 3)
CAP = 3.0
BLOCK_ROWS = 50_000
SEED = 7
_STATE = "sid int, doc_id long, tie int, size long, p double, copies int"


def size_of(text: Column) -> Column:
    """Number of words of a text; null has none."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SPACE_CLASS}]+", "w")
    return F.length(F.regexp_replace(clean, f"[{SPACE_CLASS}]+", "")).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``(sid, source, n, source_size, target)`` per source of ``(source, size)``.

    One row per source meets in a window; documents never do."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") - 1) % len(weights) + 1)
    ranked = per.withColumn("sid", F.row_number().over(order)).withColumn("w", weight)
    # sources reach their cap in the order of cap / weight; the level is set by those below it
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "sid")
    upto, every = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    # levels fall from the first source that stays below its cap on, so that one has the largest
    ranked = ranked.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= cap * F.col("source_size"))
    ranked = ranked.withColumn("line", F.max(F.when(F.col("open"), F.col("level"))).over(every))
    target = F.least(cap * F.col("source_size"), F.coalesce(F.col("line") * F.col("w"), cap * F.col("source_size").cast("double")))
    return ranked.select("sid", "source", "n", "source_size", target.alias("target"))


def _draw(seed: int, sid: int, doc: int, tie: int, step: int) -> float:
    return xxhash.xxh64_intdigest(f"{seed}/{sid}/{doc}/{tie}/{step}", seed) / 2.0 ** 64


def pivotal(block: pd.DataFrame, seed: int, step: int, last: bool) -> pd.DataFrame:
    """Round one block of ``_STATE`` rows; at most one row keeps a fraction (none if ``last``)."""
    block = block.sort_values(["size", "doc_id", "tie"], ascending=[False, True, True], kind="stable", na_position="last").reset_index(drop=True)
    p, size = block["p"].to_numpy(float).copy(), block["size"].to_numpy(np.int64)
    sid = block["sid"].to_numpy()
    doc, tie = block["doc_id"].fillna(-1).astype("int64").to_numpy(), block["tie"].to_numpy()
    held = -1
    for i in np.flatnonzero((p > 0) & (p < 1)).tolist():
        u = _draw(seed, int(sid[i]), int(doc[i]), int(tie[i]), step)
        if size[i] == 0:
            p[i] = float(u < p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        # words that may move from a to b, and from b to a
        ab = min(p[a] * size[a], (1 - p[b]) * size[b])
        ba = min((1 - p[a]) * size[a], p[b] * size[b])
        if u * (ab + ba) < ba:
            words, gives, takes = ab, a, b
        else:
            words, gives, takes = ba, b, a
        left, right = p[gives] - words / size[gives], p[takes] + words / size[takes]
        full = words == (1 - p[takes]) * size[takes]
        empty = words == p[gives] * size[gives]
        p[gives] = 0.0 if empty or left < 1e-12 else left
        p[takes] = 1.0 if full or right > 1 - 1e-12 else right
        free = [x for x in (a, b) if 0 < p[x] < 1]
        held = free[0] if free else -1
    if last and held >= 0:
        p[held] = float(p[held] >= 0.5)
    block["p"] = p
    return block


def _rounder(seed: int, step: int, last: bool):
    columns = [c.split()[0] for c in _STATE.split(", ")]

    def run(block: pd.DataFrame) -> pd.DataFrame:
        return pivotal(block[columns], seed, step, last)

    return run


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, seed: int = SEED, block_rows: int = BLOCK_ROWS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, tie, size, source_size, target, copies, taken)`` per row of ``docs``;
    ``tie`` numbers rows that agree in id, source and size."""
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.save(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                     size_of(F.col(text_col)).alias("size")))
    table = scratch.save(targets(sizes, weights, cap))                    # one row per source
    # repeated ids become documents of their own: same id, source and size, numbered by explode
    grouped = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").cast("int").alias("times"))
    each = grouped.withColumn("tie", F.explode(F.sequence(F.lit(1), F.col("times"))))
    keyed = each.join(table.select("sid", F.col("source").alias("s"), "n", "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate).cast("int")
    keyed = keyed.withColumn("copies", whole).withColumn("p", rate - whole).withColumn("at", F.xxhash64(F.lit(seed), "sid", "doc_id", "tie", "size"))
    # blocks of a source follow its row count, so a hot source is many blocks
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows))
    level = keyed.select("sid", "doc_id", "tie", "size", "p", "copies", F.pmod("at", blocks).alias("block"), "n")
    most = table.agg(F.max("n")).first()[0] or 0
    settled, step = None, 0
    while True:
        width = max(1, -(-most // block_rows))                            # blocks of the largest source at this level
        last = width == 1
        done = scratch.save(level.groupBy("sid", "block").applyInPandas(_rounder(seed, step, last), _STATE))
        fixed = done.where("p <= 0 or p >= 1")
        settled = fixed if settled is None else settled.unionByName(fixed)
        if last:
            break
        # one fraction is left per block at most: the next level has as many rows as this one had blocks
        most, step = width, step + 1
        wide = max(1, -(-most // block_rows))
        level = done.where("p > 0 and p < 1").withColumn("block", F.pmod(F.xxhash64(F.lit(seed + step), "doc_id", "tie", "size"), F.lit(wide))).withColumn("n", F.lit(0))
    info = table.select("sid", "source", "source_size", "target")
    return settled.join(info, "sid").withColumn("copies", F.col("copies") + F.col("p").cast("int")).select(
        "doc_id", "source", "tie", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: every document as many times as the mix takes it, all columns kept."""
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).where("copies > 0")
    names = {b: free_name(docs.columns, f"__{b}") for b in ("tie", "size", "copies", "id", "copy")}
    n = names
    # number the repeats of an id; almost every id occurs once and passes straight through
    numbered = docs.withColumn(n["size"], size_of(F.col(text_col))).withColumn(n["id"], F.col(id_col).cast("long"))
    several = docs.groupBy(F.col(id_col).cast("long").alias("__m")).count().where("count > 1").select("__m")
    same = F.col(n["id"]).eqNullSafe(F.col("__m"))
    once = numbered.join(several, same, "left_anti").withColumn(n["tie"], F.lit(1))
    w = Window.partitionBy(n["id"], source_col, n["size"]).orderBy(F.col(text_col))
    rest = numbered.join(several, same, "left_semi").withColumn(n["tie"], F.row_number().over(w))
    want = taken.select(F.col("doc_id").alias("__d"), F.col("tie").alias("__t"), F.col("size").alias("__z"),
                        F.col("source").alias("__s"), F.col("copies").alias("__c"))
    key = F.col(n["id"]).eqNullSafe(F.col("__d")) & (F.col(n["tie"]) == F.col("__t")) & (F.col(n["size"]) == F.col("__z")) & (
        F.col(source_col).cast("string").eqNullSafe(F.col("__s")))
    out = once.unionByName(rest).join(want, key)
    return out.withColumn(n["copy"], F.explode(F.sequence(F.lit(1), F.col("__c")))).select(*docs.columns)
