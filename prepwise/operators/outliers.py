"""Outliers: IQR / z-score / isolation forest; flag, cap or remove."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import functions as F

from prepwise.context import Role
from prepwise.operators.base import Step
from prepwise.plans import stats
from prepwise.plans.stats import col


class OutlierDetector(Step):
    name = "outlier_detector"

    logs_cells = True

    @dataclass
    class Params:
        method: str = "iqr"          # iqr | zscore | isolation_forest
        action: str = "flag"         # flag | cap | remove
        iqr_multiplier: float = 1.5
        zscore_threshold: float = 3.0
        if_contamination: float = 0.05
        n_trees: int = 100
        sample_size: int = 256
        seed: int = 42

        def validate(self):
            if self.method not in ("iqr", "zscore", "isolation_forest"):
                raise ValueError(f"unknown method {self.method!r}")
            if self.action not in ("flag", "cap", "remove"):
                raise ValueError(f"unknown action {self.action!r}")

    @property
    def heavy(self):  # forest scoring runs in Python
        return self.params.method == "isolation_forest"

    @property
    def row_local(self):  # the fitted fences make every action a projection/filter
        return True

    def _fit(self, df, ctx):
        p = self.params
        cols = ctx.numeric(df)
        if not cols:
            return {"columns": [], "fences": {}}
        mom = stats.numeric_moments(df, cols)
        fences = {}
        need_q = p.method == "iqr" or p.action == "cap" and p.method == "isolation_forest"
        if need_q:
            qs = stats.quantiles(df, cols, [0.25, 0.75])
        for c in cols:
            m = mom[c]
            f = {"n": m["n"]}
            if need_q and qs.get(c):
                q1, q3 = qs[c]
                iqr = q3 - q1
                f.update(lo=q1 - p.iqr_multiplier * iqr, hi=q3 + p.iqr_multiplier * iqr)
            if p.method == "zscore" and m["n"] and m["std_pop"]:
                f.update(mean=m["mean"], sd_pop=m["std_pop"], sd=m["std"])
            fences[c] = f
        state = {"columns": cols, "fences": fences}
        if p.method == "isolation_forest":
            from prepwise.operators.forest import fit_forest
            state["forest"], scored = fit_forest(df, cols, ctx, p.n_trees, p.sample_size, p.if_contamination, p.seed)
            self._scored = (df, scored)
        return state

    def _with_flag(self, df, state):
        """``df`` and its forest flag: from the scores that the fit wrote where ``df`` is the fitted table."""
        from prepwise.operators.forest import SCORE, forest_flag
        fitted, scored = getattr(self, "_scored", (None, None))
        if df is fitted and scored is not None:
            return scored, forest_flag(state["forest"], state["columns"], col(SCORE))
        return df, forest_flag(state["forest"], state["columns"])

    def flags(self, state):
        p = self.params
        out = {}
        for c in state["columns"]:
            f = state["fences"][c]
            x = col(c).cast("double")
            if p.method == "iqr":
                if f["n"] < 4 or "lo" not in f:
                    out[c] = F.lit(False)
                else:                                                            # O1
                    out[c] = F.coalesce((x < F.lit(f["lo"])) | (x > F.lit(f["hi"])), F.lit(False))
            elif p.method == "zscore":
                if f["n"] < 4 or "sd_pop" not in f:
                    out[c] = F.lit(False)
                else:                                                            # O2
                    z = F.abs((x - F.lit(f["mean"])) / F.lit(f["sd_pop"]))
                    out[c] = F.coalesce(z > F.lit(p.zscore_threshold), F.lit(False))
        return out

    def _limits(self, f):
        """Capping limits of a column's fences, or None."""
        p = self.params
        if p.method == "zscore":
            if f.get("sd") is None:
                return None
            return f["mean"] - p.zscore_threshold * f["sd"], f["mean"] + p.zscore_threshold * f["sd"]    # O7 (sample std)
        return (f["lo"], f["hi"]) if "lo" in f else None                                                # O6

    def _exprs(self, df, ctx, state, row_flag=None):
        """Capped cells (the only cells this step changes), also for the cell log."""
        p = self.params
        if p.action != "cap" or not state["columns"]:
            return {}
        if p.method == "isolation_forest":
            if row_flag is None:
                row_flag = self._with_flag(df, state)[1]
            flags = {c: row_flag for c in state["columns"]}
        else:
            flags = self.flags(state)
        out = {}
        for c in state["columns"]:
            limits = self._limits(state["fences"][c])
            if limits:
                x = col(c).cast("double")
                out[c] = F.when(flags[c], F.least(F.greatest(x, F.lit(limits[0])), F.lit(limits[1]))).otherwise(x)
        return out

    def _logged(self, after, before, state):
        capped = state["columns"] if self.params.action == "cap" else ()
        return {c: e for c, e in super()._logged(after, before, state).items() if c in capped}

    def _removes_rows(self, state):
        return self.params.action == "remove"

    def _transform(self, df, ctx, state):
        p = self.params
        cols = state["columns"]
        if not cols:
            return df, ctx
        for c in cols:
            f = state["fences"][c]
            told = f" outside [{f['lo']:.6g}, {f['hi']:.6g}]" if "lo" in f else (
                f" beyond {p.zscore_threshold:g} deviations of {f['sd_pop']:.6g} around {f['mean']:.6g}" if "sd_pop" in f else "")
            ctx = ctx.note(self.name, c, f"{p.method}: {p.action}{told}")
        names, row_flag = [col(c) for c in df.columns], None
        if p.method == "isolation_forest":
            df, row_flag = self._with_flag(df, state)
        if p.action == "cap":
            return df.withColumns(self._exprs(df, ctx, state, row_flag)).select(*names), ctx
        if p.method == "isolation_forest":
            if p.action == "flag":                                               # O5
                roles = {**ctx.roles, "_if_outlier": Role.BOOLEAN}
                return df.select(*names, row_flag.alias("_if_outlier")), ctx.with_(roles=roles)
            flags = {c: row_flag for c in cols}
        else:
            flags = self.flags(state)
        if p.action == "flag":                                                   # O4 (always emitted)
            out = df.withColumns({f"{c}_outlier": flags[c] for c in cols})
            roles = {**ctx.roles, **{f"{c}_outlier": Role.BOOLEAN for c in cols}}
            return out, ctx.with_(roles=roles)
        any_flag = reduce(lambda a, b: a | b, flags.values())                        # O8
        return df.where(~any_flag).select(*names), ctx
