"""Feature steps: scaling (F1–F3), skew correction (F4–F7), binning
(F8–F11), categorical encoding (F12–F16)."""
from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import functions as F, types as T

from prepwise.context import ROW_ID, Role
from prepwise.operators.base import Step
from prepwise.plans import ordered, shared, stats
from prepwise.plans.hot import lookup
from prepwise.plans.stats import col


class FeatureScaler(Step):
    name = "feature_scaler"
    default_on = False
    row_local = True

    @dataclass
    class Params:
        method: str = "standard"
        feature_range: tuple = (0, 1)

        def validate(self):
            if self.method not in ("standard", "minmax", "robust"):
                raise ValueError(f"unknown method {self.method!r}")

    def _fit(self, df, ctx):
        cols = ctx.numeric(df)
        if not cols:
            return {"params": {}}
        mom = stats.numeric_moments(df, cols)
        out = {}
        qs = {}
        if self.params.method == "robust":
            qs = stats.quantiles(df, cols, [0.25, 0.5, 0.75])
        for c in cols:
            m = mom[c]
            if (m["n"] or 0) < 2:
                continue
            if self.params.method == "standard":
                if not m["std"]:
                    continue
                out[c] = {"shift": m["mean"], "scale": m["std"]}                        # F1
            elif self.params.method == "minmax":
                if m["max"] == m["min"]:
                    continue
                out[c] = {"min": m["min"], "max": m["max"]}                             # F2
            else:
                if not qs[c]:
                    continue
                q1, med, q3 = qs[c]
                if q3 - q1 == 0:
                    continue
                out[c] = {"shift": med, "scale": q3 - q1}                               # F3
        return {"params": out}

    def _exprs(self, df, ctx, state):
        out = {}
        lo, hi = self.params.feature_range
        for c, p in state["params"].items():
            x = col(c).cast("double")
            if "min" in p:
                out[c] = F.lit(float(lo)) + (x - F.lit(p["min"])) * F.lit(float(hi - lo)) / F.lit(p["max"] - p["min"])
            else:
                out[c] = (x - F.lit(p["shift"])) / F.lit(p["scale"])
        return out

    def _notes(self, state):
        for c, p in state["params"].items():
            yield c, f"{self.params.method}: " + ", ".join(f"{k} {v:.6g}" for k, v in p.items())


def boxcox_expr(x, lam):
    return F.log(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1.0) / F.lit(lam)


def yeojohnson_expr(x, lam):
    pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    neg = (-F.log1p(-x)) if abs(lam - 2) < 1e-12 else -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


MAX_LAMBDA = 1000.0
_SMALL = 0.02


def _moment(z, k: int):
    """The integral of ``t**k * exp(z t)`` over 0..1, for k of 0, 1 or 2; a series where the closed form cancels."""
    e = F.exp(z)
    closed = (F.expm1(z) / z, (e * (z - 1) + 1) / (z * z), (e * (z * z - 2 * z + 2) - 2) / (z * z * z))[k]
    series = F.lit(0.0)
    for j in range(6, -1, -1):
        series = series * z + F.lit(1.0 / (math.factorial(j) * (j + k + 1)))
    return F.when(F.abs(z) < _SMALL, series).otherwise(closed)


def _derivatives(x, kind, lam: float, centre: float):
    """The transformed value and its first and second derivative by λ.  Where all values lie on one side, they
    are scaled by their mean logarithm ``centre``, which moves no optimum and keeps the variance free of cancellation."""
    if kind == "box_cox":
        length = F.log(x) - F.lit(centre)
        z = length * F.lit(lam)
        return [length * _moment(z, 0), length * length * _moment(z, 1), length * length * length * _moment(z, 2)]
    length, up = F.log1p(F.abs(x)) - F.lit(centre), x >= 0
    z = F.when(up, length * F.lit(lam)).otherwise(length * F.lit(2.0 - lam))
    sign = F.when(up, 1.0).otherwise(-1.0)
    return [sign * length * _moment(z, 0), length * length * _moment(z, 1), sign * length * length * length * _moment(z, 2)]


def search_lambda(df, cols, kind, offsets, tolerance=1e-9, max_passes=60) -> dict:
    """Maximum-likelihood λ by Newton's method on the likelihood's derivative, kept inside the bracket that its
    signs give; a pass is one aggregate for all columns.  A column without variance gets 1, one whose
    likelihood still rises at ``MAX_LAMBDA`` gets None."""
    if not cols:
        return {}
    df = df.select(*[col(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)   # scanned every pass
    try:
        xs = {c: col(c).cast("double") + F.lit(offsets.get(c, 0.0)) for c in cols}
        base = df.agg(*[F.count(xs[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                      *[F.sum(F.log(xs[c]) if kind == "box_cox" else F.signum(xs[c]) * F.log1p(F.abs(xs[c])))
                        .alias(f"sl{i}") for i, c in enumerate(cols)],
                      *[F.count_if(xs[c] >= 0).alias(f"up{i}") for i, c in enumerate(cols)]).first()
        # one side only: centred, so the sum of the (signed) logarithms is zero
        sums, centre = {}, {}
        for i, c in enumerate(cols):
            n, one_side = base[f"n{i}"], kind == "box_cox" or base[f"up{i}"] in (0, base[f"n{i}"])
            centre[c] = abs(base[f"sl{i}"] / n) * (-1 if kind == "box_cox" and base[f"sl{i}"] < 0 else 1) if n and one_side else 0.0
            sums[c] = 0.0 if one_side else base[f"sl{i}"]
        at = {c: 0.5 for c in cols}
        good = dict(at)                                        # the last λ with finite moments
        low, high = {c: -math.inf for c in cols}, {c: math.inf for c in cols}
        best: dict = {}
        for _ in range(max_passes):
            live = [c for c in cols if c not in best]
            if not live:
                break
            aggs = []
            for i, c in enumerate(live):
                y, y1, y2 = _derivatives(xs[c], kind, at[c], centre[c])
                aggs += [F.var_pop(y).alias(f"v{i}"), F.covar_pop(y, y1).alias(f"a{i}"), F.var_pop(y1).alias(f"b{i}"), F.covar_pop(y, y2).alias(f"c{i}")]
            r = df.agg(*aggs).first()
            for i, c in enumerate(live):
                k = cols.index(c)
                v, a, b_, c_ = (r[f"{x}{i}"] for x in "vabc")
                if v == 0 or v is None:
                    best[c] = 1.0                              # no variance: nothing to correct
                    continue
                if not all(map(math.isfinite, (v, a, b_, c_))):
                    at[c] = (at[c] + good[c]) / 2 if at[c] != good[c] else at[c] / 2
                    continue
                good[c] = at[c]
                n = base[f"n{k}"]
                slope = sums[c] - n * a / v
                bend = -n * ((b_ + c_) / v - 2 * (a / v) ** 2)
                low[c], high[c] = (max(low[c], at[c]), high[c]) if slope > 0 else (low[c], min(high[c], at[c]))
                step = -slope / bend if bend < 0 else math.copysign(1.0, slope)
                new = at[c] + max(-2.0 - abs(at[c]), min(2.0 + abs(at[c]), step))
                if not low[c] <= new <= high[c]:
                    new = (low[c] + high[c]) / 2
                if abs(new - at[c]) <= tolerance * (1 + abs(at[c])):
                    best[c] = float(new)
                elif abs(new) > MAX_LAMBDA:
                    best[c] = None
                at[c] = new
        return {c: best.get(c) for c in cols}
    finally:
        df.unpersist()


class SkewnessCorrector(Step):
    name = "skewness_corrector"
    default_on = False
    row_local = True

    @dataclass
    class Params:
        method: str = "yeo_johnson"      # log | box_cox | yeo_johnson
        skew_threshold: float = 1.0
        only_if_skewed: bool = True

        def validate(self):
            if self.method not in ("log", "box_cox", "yeo_johnson"):
                raise ValueError(f"unknown method {self.method!r}")

    def _fit(self, df, ctx):
        p = self.params
        cols = ctx.numeric(df)
        if not cols:
            return {"columns": {}}
        mom = stats.numeric_moments(df, cols)
        chosen = [c for c in cols if (mom[c]["n"] or 0) >= 10 and not (
            p.only_if_skewed and (mom[c]["skew"] is None or abs(mom[c]["skew"]) < p.skew_threshold))]  # F4
        offsets = {c: (abs(mom[c]["min"]) + 1.0 if mom[c]["min"] <= 0 else 0.0) for c in chosen}
        out = {}
        if p.method == "log":
            out = {c: {"offset": offsets[c]} for c in chosen}                             # F5
        elif p.method == "box_cox":
            lam = search_lambda(df, chosen, "box_cox", offsets)                            # F6
            out = {c: {"offset": offsets[c], "lambda": lam[c]} for c in chosen if lam[c] is not None}
        else:
            lam = search_lambda(df, chosen, "yeo_johnson", {})                             # F7
            out = {c: {"offset": 0.0, "lambda": lam[c]} for c in chosen if lam[c] is not None}
        return {"columns": out, "unbounded": [c for c in chosen if c not in out], "skew": {c: mom[c]["skew"] for c in chosen}}

    def _exprs(self, df, ctx, state):
        out = {}
        for c, p in state["columns"].items():
            x = col(c).cast("double") + F.lit(p["offset"])
            if self.params.method == "log":
                out[c] = F.log(x)
            elif self.params.method == "box_cox":
                out[c] = boxcox_expr(x, p["lambda"])
            else:
                out[c] = yeojohnson_expr(col(c).cast("double"), p["lambda"])
        return out

    def _notes(self, state):
        for c, p in state["columns"].items():
            yield c, f"{self.params.method}: " + ", ".join(f"{k} {v:.6g}" for k, v in p.items())
        for c in state.get("unbounded", ()):
            yield c, f"{self.params.method}: left as it is, the likelihood has no optimum up to {MAX_LAMBDA:g}"


def _edges_code(x, inner_edges, right_closed=True):
    """Bin code = number of inner edges below x (right-closed bins)."""
    code = F.lit(0)
    for e in inner_edges:
        code = code + (x > F.lit(float(e)) if right_closed else x >= F.lit(float(e))).cast("int")
    return F.when(x.isNotNull(), code)


class Binning(Step):
    name = "binning"
    heavy = True
    default_on = False

    logs_cells = True

    @dataclass
    class Params:
        method: str = "equal_width"       # equal_width | equal_freq | kmeans
        bins: int = 5
        output_mode: str = "replace"      # replace | new_column
        kmeans_fill_strategy: str = "median"
        max_iter: int = 300

        def validate(self):
            if self.method not in ("equal_width", "equal_freq", "kmeans"):
                raise ValueError(f"unknown method {self.method!r}")

    @property
    def row_local(self):
        return self.params.method != "equal_freq"

    def _fit(self, df, ctx):
        p = self.params
        cols = ctx.numeric(df)
        if not cols:
            return {"columns": {}}
        mom = stats.numeric_moments(df, cols)
        long_ = [c for c in cols if (mom[c]["n"] or 0) >= 3 * p.bins]
        kinds, _ = stats.distinct_and_top(df, long_, k=0)
        chosen = [c for c in long_ if kinds[c] >= p.bins]
        out, stopped = {}, []
        for c in chosen:
            m = mom[c]
            if p.method == "equal_width":                                                  # F8
                edges = np.linspace(m["min"], m["max"], p.bins + 1)
                out[c] = {"inner": [float(e) for e in edges[1:-1]]}
            elif p.method == "equal_freq":                                                 # F9
                out[c] = {"n": m["n"]}
            else:                                                                          # F10
                edges, settled = kmeans_edges(df, c, p.bins, m, p.kmeans_fill_strategy, p.max_iter)
                out[c] = {"inner": edges}
                if not settled:
                    stopped.append(c)
        return {"columns": out, "stopped": stopped}

    def _logged(self, after, before, state):
        return {c: col(f"{c}_bin") for c in state["columns"] if c in before}

    def _recodes(self):
        return True

    def _transform(self, df, ctx, state):
        p = self.params
        for c, st in state["columns"].items():
            new = f"{c}_bin"
            if p.method == "equal_freq":
                df = equal_freq_codes(df, c, new, p.bins, st["n"], ctx.order_by)
            else:
                x = col(c).cast("double")
                df = df.withColumn(new, _edges_code(x, st["inner"], right_closed=p.method == "equal_width"))
            if p.output_mode == "replace":
                df = df.drop(c)
                ctx = ctx.dropped([c])
            late = f", not settled after {p.max_iter} passes" if c in state.get("stopped", ()) else ""
            ctx = ctx.note(self.name, c, f"{p.method} into {p.bins} bins{late}")
        return df, ctx


def equal_freq_codes(df, c, new, q, n, order_by):
    """Rank by (value, row order), then ``ceil((r-1)·q/(n-1)) − 1`` in exact
    integer arithmetic; ranks come from range buckets, not one task."""
    order = [c] + [o for o in order_by if o in df.columns and o != c]
    nonnull = df.where(col(c).isNotNull())
    nulls = df.where(col(c).isNull())
    ranked = ordered.with_row_number(nonnull, order, "__r", total=n)
    r = F.col("__r").cast("long")
    if n > 1:
        code = F.greatest(F.lit(0), F.floor(((r - 1) * q + (n - 2)) / F.lit(n - 1)).cast("long") - 1)
    else:
        code = F.lit(0)
    ranked = ranked.withColumn(new, code.cast("int")).drop("__r")
    return ranked.unionByName(nulls.withColumn(new, F.lit(None).cast("int")))


CELLS = 4096          # cells of the sorted value counts that a k-means pass knows the sums of


def kmeans_edges(df, c, k, m, fill, max_iter) -> tuple[list, bool]:
    """1-D Lloyd iterations from uniform start centres.  Nulls count as the fill value (median or mean).
    Returns the inner edges and whether the centres settled."""
    x = col(c).cast("double")
    fv = stats.quantiles(df, [c], [0.5])[c][0] if fill == "median" else m["mean"]
    uniform = np.linspace(m["min"], m["max"], k + 1)
    counts = df.groupBy(F.coalesce(x, F.lit(fv)).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    centers, settled = _lloyd(_SortedCounts(counts), list((uniform[1:] + uniform[:-1]) * 0.5), k, max_iter)
    return [(centers[i] + centers[i + 1]) / 2 for i in range(k - 1)], settled


class _SortedCounts:
    """Value counts written in value order, and the sums of ``CELLS`` runs of about as many values.

    The sums up to any value are those of the whole cells below it, known on the driver, and of the one
    cell that holds it, read from the written table by its value range, so a pass reads a few thousandths
    of the table, however large."""

    def __init__(self, counts):
        self.table = ordered.bucketize(counts, ["__v"])
        self.rows = self.table.count()
        places = self.table.join(ordered.offsets(self.table), ordered.BUCKET)
        cell = F.floor((F.col("_off") + F.col(ordered.PLACE)) * F.lit(CELLS) / F.lit(max(1, self.rows))).cast("long")
        v, n = F.col("__v"), F.col("__n")
        cells = places.groupBy(cell.alias("cell")).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum(n).alias("n"), F.sum(v * n).alias("s"), F.sum(v * v * n).alias("q"))
        got = sorted(cells.collect(), key=lambda r: r["lo"])                 # at most CELLS rows
        self.lo, self.hi = np.array([r["lo"] for r in got]), np.array([r["hi"] for r in got])
        self.n = np.concatenate([[0], np.cumsum([r["n"] for r in got])])
        self.s = np.concatenate([[0.0], np.cumsum([r["s"] for r in got])])
        self.var = max(0.0, sum(r["q"] for r in got) / self.n[-1] - (self.s[-1] / self.n[-1]) ** 2)

    def up_to(self, edges: list) -> tuple[np.ndarray, np.ndarray]:
        """Rows and sums of the values up to every edge."""
        whole = np.searchsorted(self.hi, edges, side="right")               # cells that end at or below the edge
        n, s = self.n[whole].astype(float), self.s[whole].copy()
        cut = [j for j, w in enumerate(whole) if w < len(self.lo) and self.lo[w] <= edges[j]]
        if cut:
            v = F.col("__v")
            inside = [v.between(F.lit(float(self.lo[whole[j]])), F.lit(float(edges[j]))) for j in cut]
            part = self.table.where(reduce(lambda a, b: a | b, inside))
            r = part.agg(*[a for i, near in enumerate(inside) for a in (
                F.sum(F.when(near, F.col("__n"))).alias(f"n{i}"), F.sum(F.when(near, v * F.col("__n"))).alias(f"s{i}"))]).first()
            for i, j in enumerate(cut):
                n[j] += r[f"n{i}"]
                s[j] += r[f"s{i}"]
        return n, s


def _lloyd(counts, centers, k, max_iter):
    for _ in range(max_iter):
        mids = [(centers[i] + centers[i + 1]) / 2 for i in range(k - 1)]
        n, s = counts.up_to(mids)
        n, s = np.diff([0, *n, counts.n[-1]]), np.diff([0.0, *s, counts.s[-1]])
        empty = [i for i in range(k) if not n[i]]
        new = [s[i] / n[i] if n[i] else centers[i] for i in range(k)]
        if empty:
            # like scikit-learn: an empty cluster moves to the point farthest
            # from its own centre (a bounded top-k, not a collect)
            v = F.col("__v")
            cen = F.element_at(F.array(*[F.lit(float(c)) for c in centers]), _edges_code(v, mids) + 1)
            far = counts.table.select(v.alias("v"), F.abs(v - cen).alias("d")).orderBy(F.desc("d")).limit(len(empty)).collect()
            for i, r in zip(empty, far):
                new[i] = r["v"]
        new.sort()
        shift = sum((a - b) ** 2 for a, b in zip(new, centers))
        centers = [float(x) for x in new]
        if shift <= 1e-4 * counts.var and not empty:       # scikit-learn's tolerance rule
            return centers, True
    return centers, False


class CategoricalEncoder(Step):
    name = "categorical_encoder"
    heavy = True
    default_on = False

    logs_cells = True

    @dataclass
    class Params:
        method: str = "auto"              # auto | onehot | label | ordinal
        onehot_max_categories: int = 10
        ordinal_order: dict = field(default_factory=dict)
        drop_first: bool = True
        small_domain: int = 1000          # literal map up to this many values, join beyond

        def validate(self):
            if self.method not in ("auto", "onehot", "label", "ordinal"):
                raise ValueError(f"unknown method {self.method!r}")

    def _fit(self, df, ctx):
        p = self.params
        types = {f.name: f.dataType for f in df.schema.fields}
        cats = ctx.categorical(df)
        cand = [c for c in ctx.strings(df) if c not in ctx.id_columns and c not in cats]
        allc = cats + cand
        if not allc:
            return {"columns": {}}
        kinds, _ = stats.distinct_and_top(df, allc, k=0)
        bound = max(p.small_domain, p.onehot_max_categories)          # the sets below are at most this large
        small = [c for c in allc if kinds[c] <= bound]
        domains = {}
        if small:
            r2 = df.agg(*[F.array_sort(F.collect_set(col(c).cast("string") if not isinstance(types[c], T.StringType)
                                                      else col(c))).alias(f"d{i}")
                          for i, c in enumerate(small)]).first()
            domains = {c: list(r2[f"d{i}"]) for i, c in enumerate(small)}
        out, skipped = {}, {}
        for c in allc:
            n = kinds[c]
            if c in cand and n > p.onehot_max_categories:
                continue
            method = p.method
            if method == "auto":
                method = "onehot" if n <= p.onehot_max_categories else "label"            # F12
            if method == "onehot" and n > p.onehot_max_categories:
                skipped[c] = n
                continue
            out[c] = {"method": method, "domain": domains.get(c)}
        return {"columns": out, "skipped": skipped}

    def _logged(self, after, before, state):
        out = {}
        for c, st in state["columns"].items():
            if st["method"] == "onehot":                          # the column that is set; none for the dropped first value
                set_ = [F.when(col(f"{c}_{v}"), F.lit(f"{c}_{v}")) for v in st["domain"] if f"{c}_{v}" in after.columns]
                out[c] = F.coalesce(*set_) if set_ else F.lit(None).cast("string")
            else:
                out[c] = col(c)
        return out

    def _recodes(self):
        return True

    def _transform(self, df, ctx, state):
        p = self.params
        for c, n in state.get("skipped", {}).items():
            ctx = ctx.note(self.name, c, f"one-hot skipped: {n} categories, limit {p.onehot_max_categories}")
        for c, st in state["columns"].items():
            m, dom = st["method"], st["domain"]
            ctx = ctx.note(self.name, c, f"{m} encoding")
            x = col(c).cast("string")
            if m == "onehot":                                                             # F13
                vals = dom[1:] if p.drop_first else dom
                new = {f"{c}_{v}": F.coalesce(x == F.lit(v), F.lit(False)) for v in vals}
                pos = df.columns.index(c)
                df = df.withColumns(new)
                names = [n for n in df.columns if n not in new and n != c]
                df = df.select(*[col(n) for n in names[:pos]], *[col(n) for n in new], *[col(n) for n in names[pos:]])
                ctx = ctx.dropped([c]).with_(roles={**ctx.dropped([c]).roles, **{n: Role.BOOLEAN for n in new}})
            elif m == "label" or (m == "ordinal" and not p.ordinal_order.get(c)):
                if dom is not None:                                                       # F14 / F16
                    code = F.element_at(F.create_map(*sum([[F.lit(v), F.lit(i)] for i, v in enumerate(dom)], [])), x) \
                        if dom else F.lit(None).cast("int")
                    code = F.when(x.isNotNull(), code)
                    df = df.withColumn(c, code if m == "label" else F.coalesce(code, F.lit(-1)))
                else:
                    df = label_by_join(df, c, fill=None if m == "label" else -1)
                ctx = ctx.with_(roles={**ctx.roles, c: Role.NUMERIC})
            else:                                                                         # F15
                order = p.ordinal_order[c]
                mp = F.create_map(*sum([[F.lit(str(v)), F.lit(i)] for i, v in enumerate(order)], []))
                df = df.withColumn(c, F.when(x.isNotNull(), F.element_at(mp, x)))
                ctx = ctx.with_(roles={**ctx.roles, c: Role.NUMERIC})
        return df, ctx


def label_by_join(df, c, fill=None):
    """Large domains: codes = global row number of the sorted distinct values
    (range buckets), looked up by the digest of the value; hot values are dealt out."""
    codes = df.select(col(c).cast("string").alias("__v")).where(F.col("__v").isNotNull()).groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    codes = ordered.with_row_number(codes, ["__v"], "__code")
    codes = shared.save(codes.select(_text_digest(F.col("__v")).alias("__d"), "__n", (F.col("__code") - 1).alias("__code")), "codes")
    out = lookup(df.withColumn("__d", _text_digest(col(c).cast("string"))), codes, ["__d"], ["__code"], "__n")
    code = F.col("__code").cast("int")
    if fill is not None:
        code = F.coalesce(code, F.lit(fill))
    return out.withColumn(c, code).drop("__d", "__code")


def _text_digest(x):
    """SHA-256 of a text: a key of fixed size that stands for it."""
    return F.unhex(F.sha2(x.cast("binary"), 256))
