"""Shared aggregate passes: one job per question, all columns at once.

Quantiles are exact at every size and come from one route: sketches bracket the wanted ranks, and
counting passes select among the values inside the brackets.  NaN is never a value.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window, functions as F, types as T

APPROX_ACCURACY = 1_000_000


def _safe(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def col(c: str):
    return F.col(_safe(c))


def numeric_moments(df: DataFrame, cols: list[str]) -> dict[str, dict]:
    """count, mean, sample/pop std, min, max, population skew per column."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        x = col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.stddev_pop(x).alias(f"sdp{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
                 F.skewness(x).alias(f"sk{i}"), F.approx_count_distinct(x).alias(f"nd{i}")]
    r = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        out[c] = dict(n=r[f"n{i}"], mean=r[f"mean{i}"], std=r[f"sd{i}"], std_pop=r[f"sdp{i}"],
                      min=r[f"min{i}"], max=r[f"max{i}"],
                      skew=r[f"sk{i}"] if (r[f"n{i}"] or 0) > 2 else None,
                      approx_distinct=r[f"nd{i}"])
    return out


def quantiles(df: DataFrame, cols: list[str], probs: list[float], approx: bool = False,
              accuracy: int = APPROX_ACCURACY) -> dict[str, list]:
    """Linear-interpolated quantiles of the non-null values (NumPy/pandas default), exact;
    ``approx=True`` asks for ``percentile_approx`` instead.  None for a column without values."""
    if not cols:
        return {}
    if approx:
        r = df.agg(*[F.percentile_approx(F.nanvl(col(c).cast("double"), F.lit(None)), probs, accuracy).alias(f"q{i}")
                     for i, c in enumerate(cols)]).first()
        return {c: (list(r[f"q{i}"]) if r[f"q{i}"] is not None else None) for i, c in enumerate(cols)}
    return exact_quantiles(df, cols, probs)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) for non-null values of every column, one shuffle.

    Values are compared as text; partial aggregation runs map-side, so a hot
    value costs one row per task, not one row per occurrence."""
    if not cols:
        raise ValueError("no columns")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column", "kv.value")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_and_top(df: DataFrame, cols: list[str], k: int = 5) -> tuple[dict, dict]:
    """Exact distinct counts and top-k (count desc, value asc) per column in one job.

    The top-k uses a row_number filter that Spark turns into a partial
    per-task group limit, so no column's values meet in one task."""
    if not cols:
        return {}, {}
    vc = value_counts(df, cols)
    nd = vc.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
    if k <= 0:
        got = {r["column"]: r["distinct"] for r in nd.collect()}
        return {c: got.get(c, 0) for c in cols}, {c: [] for c in cols}
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    top = vc.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
    rows = (nd.select("column", F.lit(None).cast("int").alias("rk"), F.lit(None).cast("string").alias("value"),
                      F.col("distinct").alias("n"))
            .unionByName(top.select("column", "rk", "value", "n"))).collect()
    distinct = {c: 0 for c in cols}
    tops: dict = {c: [] for c in cols}
    for r in rows:
        if r["rk"] is None:
            distinct[r["column"]] = r["n"]
        else:
            tops[r["column"]].append((r["rk"], r["value"], r["n"]))
    tops = {c: [(v, n) for _, v, n in sorted(t)] for c, t in tops.items()}
    return distinct, tops


def null_counts(df: DataFrame, cols: list[str]) -> tuple[int, dict[str, int]]:
    """Total rows and nulls per column in one pass."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    r = df.agg(*aggs).first()
    return r["__n"], {c: r[f"m{i}"] for i, c in enumerate(cols)}


def typed_mode(df: DataFrame, c: str):
    """Most frequent non-null value, smallest on ties; distributed top-1."""
    r = (df.where(col(c).isNotNull()).groupBy(col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
         .orderBy(F.desc("n"), F.asc("v")).limit(1).collect())
    return r[0]["v"] if r else None


def typed_modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent non-null value of every column as text, the smallest in its type's order on ties;
    one job: values of all columns are counted together, with their order as a number beside the text."""
    if not cols:
        return {}
    cells = []
    for i, c in enumerate(cols):
        x, kind = col(c), df.schema[c].dataType
        whole = decimal = F.lit(None)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            x = x + F.lit(0).cast(kind)                             # one zero
            decimal = x
        elif isinstance(kind, T.DecimalType):
            decimal = x.cast("double")
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            whole = x.cast("long")
        elif isinstance(kind, T.TimestampType):
            whole = F.unix_micros(x)
        cells.append(F.struct(F.lit(i).alias("c"), whole.cast("long").alias("w"), decimal.cast("double").alias("d"), x.cast("string").alias("v")))
    long = df.select(F.explode(F.array(*cells)).alias("t")).select("t.*").where("v IS NOT NULL")
    counts = long.groupBy("c", "w", "d", "v").agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy("c").orderBy(F.desc("n"), "w", "d", "v")         # a partial limit per task precedes the shuffle
    rows = counts.withColumn("rk", F.row_number().over(first)).where("rk = 1").collect()
    found = {cols[r["c"]]: r["v"] for r in rows}
    return {c: found.get(c) for c in cols}


def is_numeric_type(dt) -> bool:
    return isinstance(dt, T.NumericType)


def cell_shares(df: DataFrame, cols: list[str], metrics: dict) -> dict:
    """Per column, averages of ``metrics`` over all its non-null values; one job for all columns
    (long form, partially aggregated: a row per column and task is shuffled)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in cols])).alias("kv"))
    long = long.select("kv.column", "kv.value").where(F.col("value").isNotNull())
    aggs = [F.avg(fn(F.col("value")).cast("double")).alias(name) for name, fn in metrics.items()]
    rows = long.groupBy("column").agg(*aggs).collect()
    return {r["column"]: {name: r[name] for name in metrics} for r in rows}


def distinct_counts(df: DataFrame, cols: list[str], exact: bool = True, extra: list | None = None):
    """``(distinct non-null values per column, row of the extra aggregates)``.

    Exact counts come from the value-count table; ``exact=False`` answers from the sketch."""
    extra = extra or [F.count(F.lit(1)).alias("__n")]
    if exact or not cols:
        got, _ = distinct_and_top(df, cols, k=0)
        return got, df.agg(*extra).first()
    r = df.agg(*[F.approx_count_distinct(col(c)).alias(f"a{i}") for i, c in enumerate(cols)], *extra).first()
    return {c: r[f"a{i}"] for i, c in enumerate(cols)}, r


GRID = 1000                # quantiles asked of a sketch
SKETCH = 10_000            # its accuracy: ranks are right to one part in this many
CANDIDATES = 4096          # values that one rank may leave for the last pass, ties counted once
SKETCHES = 32              # sketches that one pass keeps in a task


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list | None]:
    """Exact linear-interpolated quantiles by multi-pass selection.

    A sketch of fixed size per column brackets every wanted rank: the error of its quantiles is bounded, so
    the value at the rank lies between two of them.  While more than ``CANDIDATES`` values can lie inside a
    bracket, a pass counts what lies below and on its ends and sketches its inside, which leaves a few
    hundredths of it (at 10^12 rows: two such passes).  The last pass counts the distinct values inside
    the brackets and the rows between them, all columns in one aggregate; nothing else is shuffled, kept
    or collected, and the driver gets at most ``CANDIDATES`` values or so per rank."""
    out: dict = {}
    for at in range(0, len(cols), SKETCHES):
        out |= _selected(df, cols[at:at + SKETCHES], probs)
    return out


def _selected(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list | None]:
    xs = [F.nanvl(col(c).cast("double"), F.lit(None)) for c in cols]
    grid = F.array(*[F.lit(j / GRID) for j in range(GRID + 1)])
    r = df.agg(*[a for i, x in enumerate(xs) for a in (F.count(x).alias(f"n{i}"), F.percentile_approx(x, grid, SKETCH).alias(f"q{i}"))]).first()
    wanted: dict[tuple, tuple] = {}            # (column, rank) -> its bracket
    for i in range(len(cols)):
        for rank in _ranks(r[f"n{i}"], probs):
            wanted[i, rank] = _bracket(r[f"q{i}"], rank, r[f"n{i}"])
    values: dict[tuple, float] = {}
    sizes = {i: r[f"n{i}"] for i in range(len(cols))}
    inside = {k: sizes[k[0]] for k in wanted}
    while wide := [k for k in wanted if k not in values and _left(inside[k]) > CANDIDATES]:
        for at in range(0, len(wide), SKETCHES):
            _narrow(df, xs, wide[at:at + SKETCHES], wanted, inside, values, grid)
    values |= _counted(df, xs, {k: b for k, b in wanted.items() if k not in values})
    out: dict = {}
    for i, c in enumerate(cols):
        n = sizes[i]
        res = []
        for p in probs if n else ():
            h = (n - 1) * p
            lo = math.floor(h)
            a, z = values[i, lo], values[i, min(lo + 1, n - 1)]
            res.append(a if h == lo or a == z else a + (z - a) * (h - lo))
        out[c] = res if n else None
    return out


def _ranks(n: int, probs: list[float]) -> set[int]:
    """Ranks (from 0) that the quantiles of ``n`` values need."""
    low = {math.floor((n - 1) * p) for p in probs} if n else set()
    return low | {min(k + 1, n - 1) for k in low}


def _left(n: int) -> float:
    """At most so many of ``n`` sketched values lie strictly inside a bracket."""
    return n * (2 / GRID + 4 / SKETCH) + 2


def _bracket(quantiles: list, rank: int, n: int) -> tuple[float, float]:
    """Two quantiles of a sketch of ``n`` values between which the value at ``rank`` lies."""
    lo = math.floor((rank / n - 2 / SKETCH) * GRID)
    hi = math.ceil(((rank + 1) / n + 2 / SKETCH) * GRID)
    return quantiles[max(0, lo)], quantiles[min(GRID, hi)]


def _narrow(df, xs, keys, wanted, inside, values, grid) -> None:
    """One pass over brackets with too much inside: either the rank lies on an end, or a bracket of the inside takes its place."""
    aggs = []
    for j, k in enumerate(keys):
        x, (lo, hi) = xs[k[0]], wanted[k]
        aggs += [F.count_if(x < lo).alias(f"b{j}"), F.count_if(x == lo).alias(f"l{j}"), F.count_if((x > lo) & (x < hi)).alias(f"m{j}"),
                 F.percentile_approx(F.when((x > lo) & (x < hi), x), grid, SKETCH).alias(f"q{j}")]
    r = df.agg(*aggs).first()
    for j, k in enumerate(keys):
        lo, hi = wanted[k]
        rank = k[1] - r[f"b{j}"]
        if rank < r[f"l{j}"]:
            values[k] = lo
        elif rank - r[f"l{j}"] >= r[f"m{j}"]:
            values[k] = hi
        else:
            inside[k] = r[f"m{j}"]
            wanted[k] = _bracket(r[f"q{j}"], rank - r[f"l{j}"], r[f"m{j}"])


def _counted(df, xs, wanted: dict) -> dict[tuple, float]:
    """The value at every wanted rank, in one scan: distinct values inside the brackets are counted, and rows
    below each bracket observed as they pass; only cells inside a bracket are shuffled."""
    if not wanted:
        return {}
    cells, below, brackets = [], [], {}
    for i in {k[0] for k in wanted}:
        merged: list = []
        for lo, hi in sorted(b for k, b in wanted.items() if k[0] == i):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        brackets[i], x = merged, xs[i]
        inside = reduce(lambda a, b: a | b, [x.between(F.lit(lo), F.lit(hi)) for lo, hi in merged])
        cells.append(F.when(inside, F.struct(F.lit(i).alias("c"), x.alias("v"))))
        below += [F.count_if(x < F.lit(lo)).alias(f"b{i}_{j}") for j, (lo, _) in enumerate(merged)]
    seen = Observation()
    long = df.observe(seen, *below).select(F.explode(F.array_compact(F.array(*cells))).alias("k")).select("k.c", "k.v")
    rows = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {}
    for i, merged in brackets.items():
        mine = sorted((r["v"], r["n"]) for r in rows if r["c"] == i)
        ranks, at, j = sorted(k[1] for k in wanted if k[0] == i), 0, -1
        for v, n in mine:
            while j + 1 < len(merged) and v >= merged[j + 1][0]:
                j, at = j + 1, seen.get[f"b{i}_{j + 1}"]
            while ranks and ranks[0] < at + n:
                found[i, ranks.pop(0)] = v
            at += n
    return found
