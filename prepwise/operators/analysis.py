"""Correlation / VIF (R1–R4) and column profiles."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from prepwise.context import ROW_ID, Role
from prepwise.operators.base import Step
from prepwise.plans import ordered, shared, stats
from prepwise.plans.hot import lookup
from prepwise.plans.stats import col

CORR_SCHEMA = "col_a string, col_b string, r double"


def pearson_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long table (col_a, col_b, r) for all pairs a<b; one aggregate.
    ``corr`` skips rows where either side is null (pairwise complete)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], CORR_SCHEMA)
    r = df.agg(*[F.corr(col(a).cast("double"), col(b).cast("double")).alias(f"p{i}")
                 for i, (a, b) in enumerate(pairs)])
    return r.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"p{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])).alias("t")).select("t.*")


def spearman_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spearman = Pearson of average ranks over the rows complete in all
    chosen columns (equal to pairwise ranking when there are no nulls).

    All columns are ranked together in long form: one value-count table
    ``(column, value) → n``, one set of range buckets, running sums inside
    buckets plus per-bucket offsets (a table with one row per bucket and
    column), then one look-up by ``(column, value)`` that deals hot values out
    and one regroup by row."""
    k = len(cols)
    complete = df.dropna(subset=cols).select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    complete = complete.withColumn("__rid", F.monotonically_increasing_id())
    long = complete.select("__rid", F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(f"x{i}").alias("v")) for i in range(k)])).alias("kv")) \
        .select("__rid", "kv.c", "kv.v")
    vc = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    b = ordered.bucketize(vc, ["c", "v"])
    run = Window.partitionBy(ordered.BUCKET, "c").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    local = b.withColumn("cum", F.sum("n").over(run))
    tot = b.groupBy(ordered.BUCKET, "c").agg(F.sum("n").alias("t"))
    off = tot.select(ordered.BUCKET, "c", F.coalesce(F.sum("t").over(
        Window.partitionBy("c").orderBy(ordered.BUCKET).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("off"))
    ranks = local.join(F.broadcast(off), [ordered.BUCKET, "c"]).select(
        "c", "v", "n", (F.col("off") + F.col("cum") - (F.col("n") - 1) / 2.0).alias("rank"))
    ranked = lookup(long, shared.save(ranks, "ranks"), ["c", "v"], ["rank"], "n", spread=F.xxhash64("__rid", "c"))
    wide = ranked.groupBy("__rid").agg(*[
        F.max(F.when(F.col("c") == i, F.col("rank"))).alias(c) for i, c in enumerate(cols)])
    return pearson_pairs(wide, cols)


def vif(df: DataFrame, cols: list[str], intercept: bool = False) -> list[tuple[str, float]]:
    """VIF from the Gram matrix of complete rows (one aggregate); regression
    without intercept by default (the usual library call on raw columns)."""
    complete = df.dropna(subset=cols)
    xs = [col(c).cast("double") for c in cols]
    if intercept:
        xs = [F.lit(1.0)] + xs
    k = len(xs)
    r = complete.agg(*[F.sum(xs[i] * xs[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    G = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            G[i, j] = G[j, i] = r[f"g{i}_{j}"] or 0.0
    inv = np.linalg.pinv(G)
    start = 1 if intercept else 0
    if intercept:
        # centred form: VIF_i = 1 / (1 - R²_i) with intercept
        n = G[0, 0]
        mean = G[0, 1:] / n
        C = G[1:, 1:] / n - np.outer(mean, mean)
        Ci = np.linalg.pinv(C)
        return sorted([(c, float(C[i, i] * Ci[i, i])) for i, c in enumerate(cols)], key=lambda t: -t[1])
    return sorted([(c, float(G[i, i] * inv[i, i])) for i, c in enumerate(cols)], key=lambda t: -t[1])


class CorrelationAnalyzer(Step):
    name = "correlation_analyzer"
    default_on = False
    row_local = True

    @dataclass
    class Params:
        method: str = "pearson"
        correlation_threshold: float = 0.9
        compute_vif: bool = True
        vif_threshold: float = 10.0

    def _fit(self, df, ctx):
        p = self.params
        cols = ctx.numeric(df)
        if len(cols) < 2:
            return {"high": [], "vif": []}
        pairs = (pearson_pairs if p.method == "pearson" else spearman_pairs)(df, cols)
        high = [(r["col_a"], r["col_b"], r["r"]) for r in
                pairs.where(F.abs("r") >= p.correlation_threshold).collect()]                      # R3
        v = [(c, x) for c, x in vif(df, cols) if x > p.vif_threshold] if p.compute_vif and len(cols) > 2 else []
        return {"high": high, "vif": v}

    def _transform(self, df, ctx, state):
        for a, b, r in state["high"]:
            ctx = ctx.note(self.name, f"{a} <-> {b}", f"high correlation r={r:.4f}")
        for c, x in state["vif"]:
            ctx = ctx.note(self.name, c, f"VIF={x:.1f}")
        return df, ctx


PROFILE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("dtype", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("missing", T.LongType()), T.StructField("unique", T.LongType()),
    T.StructField("mean", T.DoubleType()), T.StructField("median", T.DoubleType()),
    T.StructField("std", T.DoubleType()), T.StructField("skewness", T.DoubleType()),
    T.StructField("min", T.StringType()), T.StructField("max", T.StringType()),
    T.StructField("top_values", T.ArrayType(T.StructType([
        T.StructField("value", T.StringType()), T.StructField("n", T.LongType())]))),
])


def profile(df: DataFrame, ctx=None, top_k: int = 5) -> DataFrame:
    """One row per column (R5–R8), from a few passes whatever the width: null counts, moments, exact
    medians, text extremes, and the value-count table that yields distinct counts and top values together."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name != ROW_ID]
    cols = [f.name for f in fields]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    other = [f.name for f in fields if f.name not in numeric]
    orderable = [f.name for f in fields if f.name in other
                 and not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    total, nulls = stats.null_counts(df, cols)
    mom = stats.numeric_moments(df, numeric)
    med = stats.quantiles(df, [c for c in numeric if mom[c]["n"]], [0.5])
    mm = {}
    if orderable:
        r = df.agg(*[F.min(col(c)).cast("string").alias(f"mn{i}") for i, c in enumerate(orderable)],
                   *[F.max(col(c)).cast("string").alias(f"mx{i}") for i, c in enumerate(orderable)]).first()
        mm = {c: (r[f"mn{i}"], r[f"mx{i}"]) for i, c in enumerate(orderable)}
    groupable = [f.name for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    distinct, tops = stats.distinct_and_top(df, groupable, top_k) if groupable else ({}, {})
    roles = (ctx.roles if ctx else {})
    rows = []
    for f in fields:
        c = f.name
        m = mom.get(c)
        role = roles.get(c)
        rows.append((
            c, (role.value if isinstance(role, Role) else role) or "text", f.dataType.simpleString(),
            total, nulls[c], distinct.get(c),
            m["mean"] if m else None, (med.get(c) or [None])[0] if m else None,
            m["std"] if m else None, m["skew"] if m else None,
            (None if m["min"] is None else repr(float(m["min"]))) if m else mm.get(c, (None, None))[0],
            (None if m["max"] is None else repr(float(m["max"]))) if m else mm.get(c, (None, None))[1],
            [(v, n) for v, n in tops.get(c, [])],
        ))
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def table_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, total missing cells and the type of every column, as one row."""
    users = [f for f in df.schema.fields if f.name != ROW_ID]
    missing = sum((F.count_if(col(f.name).isNull()) for f in users), F.lit(0).cast("long"))
    kinds = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype")) for f in users])
    return df.agg(F.count(F.lit(1)).alias("rows"), missing.alias("total_missing")).select(
        "rows", F.lit(len(users)).alias("cols"), "total_missing", kinds.alias("dtypes"))


class Profiler(Step):
    name = "profiler"
    row_local = True

    def _transform(self, df, ctx, state):
        return df, ctx.note(self.name, None, "profile available via FittedPipeline.profile()")
