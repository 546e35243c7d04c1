"""Isolation forest (Liu, Ting & Zhou 2008) built and scored on Spark.

* sampling: every tree draws its own rows, independently of the others: the ``sample_size`` complete rows
  with the smallest hash(row key, tree).  A row passes on only hashes below a limit that leaves a tree a
  few more rows than it needs (raised until every tree has them), and a limit per tree and task precedes
  the shuffle.  The key is the order columns of the context, so the sample is the same under any
  partitioning exactly if these columns are data (a row id made by the scan is not);
* growing: ``groupBy(tree).applyInPandas`` — one bounded group per tree;
* the forest (≤ trees × (2·sample_size − 1) nodes) is collected once and
  shipped to the scoring UDF as a literal closure — its size is bounded by the
  parameters, not by the data;
* scoring: an Arrow ``pandas_udf`` over the numeric columns;
* threshold: the ``contamination`` quantile of the scores.  The fit writes the rows with their scores once;
  the threshold and the flags of the fitted table are read from there, so Python runs once per row.
"""
from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F, types as T

from prepwise.plans import shared, stats
from prepwise.plans.stats import col

SCORE = "__if_score"
NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size long"


def _complete(cols):
    return reduce(lambda a, b: a & b, [col(c).isNotNull() for c in cols])


def _c(n: int) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow(pdf: pd.DataFrame, n_features: int, sample_size: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.sort_values("h", kind="stable").head(sample_size)
    X = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, n_features))
    rng = np.random.default_rng(seed * 1_000_003 + tree)
    limit = int(math.ceil(math.log2(max(len(X), 2))))
    rows = []

    def build(idx, depth):
        node = len(rows)
        rows.append(None)
        sub = X[idx]
        if depth >= limit or len(idx) <= 1:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx))
            return node
        mins, maxs = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(maxs > mins)
        if len(usable) == 0:
            rows[node] = (tree, node, -1, 0.0, -1, -1, len(idx))
            return node
        f = int(rng.choice(usable))
        split = float(rng.uniform(mins[f], maxs[f]))
        left_idx = idx[sub[:, f] < split]
        right_idx = idx[sub[:, f] >= split]
        left = build(left_idx, depth + 1)
        right = build(right_idx, depth + 1)
        rows[node] = (tree, node, f, split, left, right, len(idx))
        return node

    build(np.arange(len(X)), 0)
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "split", "left", "right", "size"])


def fit_forest(df, cols, ctx, n_trees, sample_size, contamination, seed) -> tuple:
    """The forest with its threshold, and ``df`` with the column ``SCORE`` as a written table."""
    complete = df.where(_complete(cols))
    n = complete.count()
    if n < 10:
        return {"trees": [], "threshold": None, "psi": 0}, None
    psi = min(sample_size, n)
    order = [o for o in ctx.order_by if o in df.columns]
    keycol = F.struct(*[col(o) for o in order]) if order else F.struct(*[col(c) for c in cols])
    picked = _samples(complete, keycol, F.array(*[col(c).cast("double") for c in cols]), n, n_trees, psi, seed)
    nf, ps, sd = len(cols), psi, seed
    nodes = picked.groupBy("tree").applyInPandas(lambda pdf: _grow(pdf, nf, ps, sd), NODE_SCHEMA).collect()
    trees: dict[int, list] = {}
    for r in sorted(nodes, key=lambda r: (r["tree"], r["node"])):
        trees.setdefault(r["tree"], []).append((r["feature"], r["split"], r["left"], r["right"], r["size"]))
    forest = {"trees": [trees[t] for t in sorted(trees)], "psi": psi, "threshold": None}
    scored = shared.save(df.withColumn(SCORE, score_column(forest, cols)), "scores")
    q = stats.quantiles(scored, [SCORE], [contamination])
    forest["threshold"] = q[SCORE][0] if q.get(SCORE) else None
    return forest, scored


def _samples(rows, key, x, n: int, n_trees: int, psi: int, seed: int):
    """``(tree, h, x)``: for every tree the ``psi`` rows of least hash, as a written table."""
    h0 = rows.select(F.xxhash64(key, F.lit(seed)).alias("h0"), x.alias("x"))
    want = psi + 6 * math.sqrt(psi) + 20
    while True:
        limit = F.lit(min(2 ** 63 - 1, -2 ** 63 + int(min(1.0, want / n) * 2 ** 64)))
        hashes = [F.xxhash64("h0", F.lit(t)) for t in range(n_trees)]
        draws = F.array_compact(F.array(*[F.when(h <= limit, F.struct(F.lit(t).alias("tree"), h.alias("h"))) for t, h in enumerate(hashes)]))
        any_tree = F.least(*hashes, hashes[0]) <= limit                # few rows: only they list their trees
        drawn = h0.select("x", F.explode(F.when(any_tree, draws)).alias("d")).select("d.tree", "d.h", "x")
        place = F.row_number().over(Window.partitionBy("tree").orderBy("h", "x"))
        table = shared.save(drawn.withColumn("place", place).where(F.col("place") <= psi).drop("place"), "samples")
        if want >= n or table.count() == n_trees * psi:
            return table
        want *= 4


def _stack(trees: list) -> dict:
    """Pad the trees into (trees × nodes) arrays for vectorised traversal; ``step`` holds the left and
    right child of node ``i`` at ``2 i`` and ``2 i + 1``, a leaf being its own left child on any value."""
    width = max(len(t) for t in trees)
    T = len(trees)
    feat = np.zeros((T, width), dtype=np.intp)
    split = np.full((T, width), np.nan)                  # no value is below or above: a leaf stays
    step = np.zeros((T, 2 * width), dtype=np.intp)
    length = np.zeros((T, width))                        # of the path that ends in a leaf
    depths = np.zeros(T, dtype=np.int64)
    for i, t in enumerate(trees):
        todo = [(0, 0)]
        while todo:
            j, depth = todo.pop()
            f, sp, left, right, size = t[j]
            if f < 0:
                step[i, 2 * j], step[i, 2 * j + 1], length[i, j] = j, j, depth + _c(int(size))
                depths[i] = max(depths[i], depth)
                continue
            feat[i, j], split[i, j], step[i, 2 * j], step[i, 2 * j + 1] = f, sp, left, right
            todo += [(left, depth + 1), (right, depth + 1)]
    return {"feat": feat, "split": split, "step": step, "length": length, "depths": depths}


def mean_path_length(X: np.ndarray, arr: dict) -> np.ndarray:
    """Average path length of every row over all trees, a tree at a time: its nodes and the rows stay in the cache."""
    n, T = len(X), arr["feat"].shape[0]
    total = np.empty((T, n))
    cells, first = np.ascontiguousarray(X, dtype=np.float64).ravel(), np.arange(n) * X.shape[1]
    for i in range(T):
        feat, split, step = arr["feat"][i], arr["split"][i], arr["step"][i]
        node = np.zeros(n, dtype=np.intp)
        for _ in range(arr["depths"][i]):
            goes_right = ~(cells.take(first + feat.take(node)) < split.take(node))
            node = step.take(2 * node + goes_right)
        total[i] = arr["length"][i].take(node)
    return np.ascontiguousarray(total.T).mean(axis=1)


def score_column(forest: dict, cols):
    arr, psi = _stack(forest["trees"]), forest["psi"]
    norm = _c(psi)

    @F.pandas_udf(T.DoubleType())
    def score(x: pd.DataFrame) -> pd.Series:
        # sklearn's score_samples sign: higher = more normal
        return pd.Series(-(2.0 ** (-mean_path_length(x.to_numpy(dtype=np.float64), arr) / norm)))

    cells = F.struct(*[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(cols)])
    return F.when(_complete(cols), score(cells))


def forest_flag(forest: dict, cols, score=None):
    """Rows below the threshold; ``score`` is a column that holds the scores already."""
    if not forest["trees"] or forest["threshold"] is None:
        return F.lit(False)
    return F.coalesce((score_column(forest, cols) if score is None else score) < F.lit(forest["threshold"]), F.lit(False))
