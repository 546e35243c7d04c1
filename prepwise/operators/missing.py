"""Missing values (M1–M10): columns are visited in order and each sees the
row drops of the columns before it."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F, types as T

from prepwise.context import ROW_ID, Role
from prepwise.operators.base import Step
from prepwise.plans import ordered, stats
from prepwise.plans.stats import col

MISSING_TEXT = "缺失"   # FIXED VALUE: mode fill of an all-null text column
STRATEGIES = ("auto", "mean", "median", "mode", "drop_rows", "drop_cols", "ffill", "bfill", "interpolate")


class MissingHandler(Step):
    name = "missing_handler"
    heavy = True
    logs_cells = True

    @dataclass
    class Params:
        strategy: str = "auto"
        drop_col_threshold: float = 0.5
        drop_row_threshold: float = 0.3
        skew_threshold: float = 1.0
        column_overrides: dict = field(default_factory=dict)

        def validate(self):
            bad = [s for s in [self.strategy, *self.column_overrides.values()] if s not in STRATEGIES]
            if bad:
                raise ValueError(f"unknown strategies {bad}")

    def _auto(self, ctx, c, ratio):
        p = self.params
        if ratio > p.drop_col_threshold:
            return "drop_cols"
        if ratio > p.drop_row_threshold:
            return "drop_rows"
        role = ctx.roles.get(c)
        if role == Role.NUMERIC:
            sk = ctx.skewness.get(c)
            return "median" if sk is not None and abs(sk) > p.skew_threshold else "mean"
        if role == Role.DATETIME:
            return "ffill"
        return "mode"

    def _fit(self, df, ctx):
        p = self.params
        cur = df
        cols = [c for c in df.columns if c != ROW_ID]
        total, nulls = stats.null_counts(cur, cols)
        plan, means, medians, modes = [], {}, {}, {}

        def strategy(x):
            return p.column_overrides.get(x) or (self._auto(ctx, x, nulls[x] / total) if p.strategy == "auto" else p.strategy)

        for i, c in enumerate(cols):
            if nulls[c] == 0 or total == 0:
                continue
            strat = strategy(c)
            dtype = cur.schema[c].dataType
            numeric = isinstance(dtype, T.NumericType)
            action = {"column": c, "strategy": strat, "missing": nulls[c], "rows": total}
            if strat in ("mean", "median"):
                if not numeric:
                    continue
                if strat == "median" and c not in medians:
                    # all numeric columns with nulls that this table can still ask for, in one pass
                    ask = [x for x in cols[i:] if nulls[x] and x in cur.columns and isinstance(cur.schema[x].dataType, T.NumericType)]
                    medians = {x: q and q[0] for x, q in stats.quantiles(cur, ask, [0.5]).items()}
                if strat == "mean" and c not in means:
                    ask = [x for x in cols[i:] if nulls[x] and x in cur.columns and isinstance(cur.schema[x].dataType, T.NumericType)]
                    r = cur.agg(*[F.avg(col(x).cast("double")).alias(f"a{k}") for k, x in enumerate(ask)]).first()
                    means = {x: r[f"a{k}"] for k, x in enumerate(ask)}
                action["value"] = (means if strat == "mean" else medians)[c]
                if action["value"] is None:                       # no value to fill with: the column stays as it is
                    continue
            elif strat == "mode":
                if c not in modes:                                # all columns that this table can still ask for, in one job
                    modes = stats.typed_modes(cur, [x for x in cols[i:] if nulls[x] and x in cur.columns and strategy(x) == "mode"])
                v = modes[c]
                if v is None:
                    if not isinstance(dtype, T.StringType):
                        continue
                    v = MISSING_TEXT
                action["value"] = v                               # as text, cast to the column's type when it is filled in
            elif strat == "interpolate" and not numeric:
                continue
            plan.append(action)
            if strat == "drop_rows":
                cur = cur.where(col(c).isNotNull())
                means, medians, modes = {}, {}, {}
                rest = cols[i + 1:]
                if rest:
                    total, nulls2 = stats.null_counts(cur, rest)
                    nulls.update(nulls2)
            elif strat == "drop_cols":
                cur = cur.drop(c)
        return {"plan": plan}

    def _logged(self, after, before, state):
        filled = {a["column"] for a in state["plan"]}
        return {c: e for c, e in super()._logged(after, before, state).items() if c in filled}

    def _removes_rows(self, state):
        return any(a["strategy"] == "drop_rows" for a in state["plan"])

    def _transform(self, df, ctx, state):
        order = [o for o in ctx.order_by if o in df.columns] or [ROW_ID]
        pending: list = []          # consecutive ordered fills of one kind run as one job

        def flush(d):
            if not pending:
                return d
            kind = pending[0]["strategy"]
            cs = [a["column"] for a in pending]
            pending.clear()
            if kind == "interpolate":
                return ordered.interpolate(d, cs, order)
            return ordered.fill(d, cs, order, "forward" if kind == "ffill" else "backward")

        for a in state["plan"]:
            c, s = a["column"], a["strategy"]
            ctx = ctx.note(self.name, c, f"missing {a['missing']}/{a['rows']}, strategy {s}")
            if pending and pending[0]["strategy"] != s:
                df = flush(df)
            if s in ("ffill", "bfill", "interpolate"):
                pending.append(a)
                continue
            df = flush(df)
            if s == "drop_cols":
                df = df.drop(c)
                ctx = ctx.dropped([c])
            elif s == "drop_rows":
                df = df.where(col(c).isNotNull())
            elif s in ("mean", "median", "mode"):
                v = a["value"]
                t = df.schema[c].dataType
                lit = F.lit(v).cast(t) if s == "mode" else F.lit(v)
                df = df.withColumn(c, F.coalesce(col(c), lit))
        df = flush(df)
        return df, ctx
