"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact check.

A document's fingerprint has a bit set where over half of its shingle hashes have it
set.  Each distinct fingerprint is mapped to its vector of per-segment bit counts.  Two
fingerprints that differ in at most ``d`` bits have vectors at Manhattan distance at
most ``d`` (a lower bound of the bit distance), so a grid whose cells are the vectors
holds every partner in the cells within that distance; candidates of the equi-join on
cells are then compared bit by bit.

Defined results: null text counts as empty; texts without words have fingerprint zero
and link like any other; texts with fewer words than a shingle hash their whole word
sequence; rows with a null id keep their row (component = their fingerprint group's);
repeated rows are returned once each; an empty table gives an empty result."""
from __future__ import annotations

import re
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, components, free_name

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 8
SEED = 42
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    tokens = _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        starts, ends = starts[: len(tokens) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + _BLOCK].tolist(), ends[at:at + _BLOCK].tolist())], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` per row; ``fp`` is the fingerprint as a signed long."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), _fingerprint_column(words)(F.col(text_col)).alias("fp"))


def _fingerprint_column(words: int):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return fp


def neighbour_offsets(segments: int, bits: int) -> list[int]:
    """Offsets between packed count vectors (a byte per segment) within Manhattan distance
    ``bits``, one of each pair of opposite offsets; zero is included."""
    found = set()
    for size in range(1, min(bits, segments) + 1):
        for where in combinations(range(segments), size):
            for steps in product([s for s in range(-bits, bits + 1) if s], repeat=size):
                if sum(map(abs, steps)) <= bits:
                    found.add(sum(s << (8 * w) for w, s in zip(where, steps)))
    return [0, *sorted(x for x in found if x > 0)]


def popcount_vector(fp, segments: int):
    """Per-segment bit counts of a fingerprint column, packed into a long with a byte for each segment."""
    width = 64 // segments
    mask = (1 << width) - 1 if width < 64 else -1
    out = F.lit(0).cast("long")
    for s in range(segments):
        count = F.bit_count(F.shiftrightunsigned(fp, s * width).bitwiseAND(F.lit(mask))).cast("long")
        out = out + F.shiftleft(count, 8 * s)
    return out


def near_pairs(nodes: DataFrame, bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``(a, b)`` of node numbers whose fingerprints differ in at most ``bits`` bits.

    ``nodes`` is ``(node, fp)`` with distinct fingerprints.  Packed counts stay within
    a byte (at most 64, steps of at most ``bits``), and a count that would fall below zero
    borrows to 254 or 255, which no vector has: an offset never meets a wrong cell."""
    if segments not in (1, 2, 4, 8):
        raise ValueError("segments must be 1, 2, 4 or 8")
    placed = nodes.withColumn("cell", popcount_vector(F.col("fp"), segments))
    offsets = F.array(*[F.lit(o).cast("long") for o in neighbour_offsets(segments, bits)])
    probes = placed.select(F.col("node").alias("a"), F.col("fp").alias("fa"), "cell", F.explode(offsets).alias("step"))
    probes = probes.select("a", "fa", (F.col("cell") + F.col("step")).alias("cell"), (F.col("step") == 0).alias("own"))
    held = placed.select(F.col("node").alias("b"), F.col("fp").alias("fb"), "cell")
    close = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= bits
    once = ~F.col("own") | (F.col("fa") < F.col("fb"))
    # Spark sizes the exploded probes like the nodes and would broadcast them: both sides are shuffled
    return probes.join(held.hint("merge"), (probes.cell == held.cell) & close & once).select("a", "b")


def _groups(docs: DataFrame, words: int, bits: int, segments: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row and ``(fp, component, component_id)`` per fingerprint."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.save(fingerprints(docs, words, id_col, text_col))
    nodes = scratch.save(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = components(scratch, near_pairs(nodes.select(F.col("fp").alias("node"), "fp"), bits, segments))
    # components are named by their smallest fingerprint; rename them by their smallest id
    named = nodes.join(linked, nodes.fp == linked.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return prints, scratch.save(named.join(names, "component").select("fp", "component", "component_id"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, segments: int = SEGMENTS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    Copies share a fingerprint and are collapsed before the join, so a group of copies of any
    size is one node; the component is the smallest id reachable over links."""
    prints, groups = _groups(docs, words, bits, segments, id_col, text_col)
    return prints.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS, segments: int = SEGMENTS,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of linked documents (the smallest id), all columns kept.

    Of rows that repeat that id, and of a group without any id, the smallest text stays."""
    prints, groups = _groups(docs, words, bits, segments, id_col, text_col)
    ids = prints.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("fp").alias("fp")).where("doc_id is not null")
    several = ids.where("n > 1").select("doc_id")
    lost = ids.where("n = 1").join(groups, "fp").where("doc_id <> component_id").select("doc_id")
    own, same = F.col(id_col).cast("long"), F.col(id_col).cast("long") == F.col("__d")
    plain = docs.where(own.isNotNull()).join(lost.union(several).select(F.col("doc_id").alias("__d")), same, "left_anti")
    # rows without an id, or whose id others have too, are told apart by their fingerprints
    odd = docs.where(own.isNull()).unionByName(docs.join(several.select(F.col("doc_id").alias("__d")), same, "left_semi"))
    mark, rank = free_name(docs.columns, "__fp"), free_name(docs.columns, "__rank")
    marked = odd.withColumn(mark, _fingerprint_column(words)(F.col(text_col)))
    first = marked.join(groups.select(F.col("fp").alias("__f"), F.col("component").alias("__c"), F.col("component_id").alias("__i")), F.col(mark) == F.col("__f"))
    w = Window.partitionBy("__c").orderBy(text_col)
    first = first.where(own.eqNullSafe(F.col("__i"))).withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1)
    return plain.select(*docs.columns).unionByName(first.select(*docs.columns))
