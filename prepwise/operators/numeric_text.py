"""Numbers written as text: units (N1–N6), percent (N7–N9), decimals."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F, types as T

from prepwise.context import ROW_ID, Role
from prepwise.functions import numbers as nb
from prepwise.functions import vocab
from prepwise.operators.base import Step
from prepwise.plans.stats import col


class UnitDetector(Step):
    name = "unit_detector"
    row_local = True

    @dataclass
    class Params:
        match_ratio: float = 0.6
        handle_ranges: bool = True
        unit_categories: list | None = None
        update_roles: bool = True

    def units(self):
        return vocab.units_for(self.params.unit_categories)

    def _fit(self, df, ctx):
        p = self.params
        strings = ctx.strings(df)
        if not strings:
            return {"columns": {}}
        rx = nb.unit_regex(self.units())
        aggs = []
        for i, c in enumerate(strings):
            x = col(c)
            trimmed = F.trim(x)
            aggs += [F.count(x).alias(f"nn{i}"),
                     F.count_if(nb.is_number(trimmed)).alias(f"num{i}"),
                     F.count_if(x.rlike(rx)).alias(f"m{i}")]
        r = df.agg(*aggs).first()
        chosen = [c for i, c in enumerate(strings)
                  if r[f"nn{i}"] > 0 and r[f"num{i}"] / r[f"nn{i}"] <= 0.9                   # N2
                  and r[f"m{i}"] / r[f"nn{i}"] >= p.match_ratio]                              # N3
        if not chosen:
            return {"columns": {}}
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.regexp_extract(col(c), rx, 2).alias("unit"))
            for c in chosen])).alias("kv")).select("kv.*").where(F.col("unit") != "")
        counts = long.groupBy("column", "unit").agg(F.count(F.lit(1)).alias("n")).collect()
        best = {}
        for row in sorted(counts, key=lambda r: (-r["n"], r["unit"])):
            best.setdefault(row["column"], row["unit"])
        return {"columns": {c: best[c] for c in chosen if c in best}}

    def _exprs(self, df, ctx, state):
        units = self.units()
        rx, rr = nb.unit_regex(units), nb.range_regex(units)
        out = {}
        for c in state["columns"]:
            x = col(c)
            e = F.when(x.rlike(rx), nb.strip_commas_to_double(F.regexp_extract(x, rx, 1)))         # N1
            if self.params.handle_ranges:
                mid = (nb.strip_commas_to_double(F.regexp_extract(x, rr, 1))
                       + nb.strip_commas_to_double(F.regexp_extract(x, rr, 2))) / 2.0
                e = e.when(x.rlike(rr), mid)                                                       # N4
            plain = F.regexp_replace(x, ",", "")
            out[c] = e.otherwise(nb.to_number(plain))                                              # N5
        return out

    def _transform(self, df, ctx, state):
        out = df.withColumns(self._exprs(df, ctx, state)) if state["columns"] else df
        rename = {c: f"{c}({u})" for c, u in state["columns"].items() if not c.endswith(f"({u})")}
        if self.params.update_roles:
            ctx = ctx.with_(roles={**ctx.roles, **{c: Role.NUMERIC for c in state["columns"]}})
        for c, u in state["columns"].items():
            ctx = ctx.note(self.name, c, f"unit {u!r} stripped")
        if rename:
            out = out.withColumnsRenamed(rename)
            ctx = ctx.renamed(rename)
        return out, ctx


class PercentageUnifier(Step):
    name = "percentage_unifier"
    row_local = True

    @dataclass
    class Params:
        mode: str = "ratio"            # ratio: 50% → 0.5 ; percent: 50% → 50.0
        handle_percent: bool = True
        handle_permille: bool = True
        min_match_ratio: float = 0.0   # 0 = one matching cell flips the column
        update_roles: bool = True

        def validate(self):
            if self.mode not in ("ratio", "percent"):
                raise ValueError(f"unknown mode {self.mode!r}")

    def _match(self, x):
        p = self.params
        m = F.lit(False)
        if p.handle_percent:
            m = m | x.rlike(nb.PERCENT_RE)
        if p.handle_permille:
            m = m | x.rlike(nb.PERMILLE_RE)
        return m

    def _fit(self, df, ctx):
        strings = ctx.strings(df)
        if not strings:
            return {"columns": []}
        r = df.agg(*[F.count_if(self._match(col(c))).alias(f"m{i}") for i, c in enumerate(strings)],
                   *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(strings)]).first()
        keep = [c for i, c in enumerate(strings)
                if r[f"m{i}"] > 0 and r[f"m{i}"] / r[f"n{i}"] >= self.params.min_match_ratio]     # N9
        return {"columns": keep}

    def _exprs(self, df, ctx, state):
        p = self.params
        pct_div = 100.0 if p.mode == "ratio" else 1.0
        pml_div = 1000.0 if p.mode == "ratio" else 10.0
        out = {}
        for c in state["columns"]:
            x = col(c)
            e = F.when(F.lit(False), F.lit(None).cast("double"))
            if p.handle_percent:
                e = e.when(x.rlike(nb.PERCENT_RE),
                           F.regexp_extract(x, nb.PERCENT_RE, 1).try_cast("double") / pct_div)     # N7
            if p.handle_permille:
                e = e.when(x.rlike(nb.PERMILLE_RE),
                           F.regexp_extract(x, nb.PERMILLE_RE, 1).try_cast("double") / pml_div)    # N8
            out[c] = e.otherwise(nb.to_number(x))
        return out

    def _transform(self, df, ctx, state):
        out = df.withColumns(self._exprs(df, ctx, state)) if state["columns"] else df
        if self.params.update_roles:
            ctx = ctx.with_(roles={**ctx.roles, **{c: Role.NUMERIC for c in state["columns"]}})
        for c in state["columns"]:
            ctx = ctx.note(self.name, c, f"percentages written as {self.params.mode}")
        return out, ctx


class DecimalUnifier(Step):
    name = "decimal_unifier"
    row_local = True

    @dataclass
    class Params:
        mode: str = "auto"
        fixed_places: int = 2
        method: str = "round"
        auto_percentile: float = 90
        decimal_min: int = 0
        decimal_max: int = 6

        def validate(self):
            if self.mode not in ("auto", "fixed") or self.method not in ("round", "floor", "ceil"):
                raise ValueError("mode must be auto|fixed and method round|floor|ceil")

    def _fit(self, df, ctx):
        p = self.params
        cols = ctx.numeric(df)
        if not cols:
            return {"places": {}}
        aggs = []
        for i, c in enumerate(cols):
            x = col(c).cast("double")
            aggs += [F.count(x).alias(f"n{i}"), F.max(F.abs(F.pmod(x, F.lit(1.0)))).alias(f"frac{i}")]
            if p.mode == "auto":
                aggs.append(F.percentile(nb.decimal_places(x), p.auto_percentile / 100.0).alias(f"q{i}"))
        r = df.agg(*aggs).first()
        places = {}
        for i, c in enumerate(cols):
            if r[f"n{i}"] == 0 or r[f"frac{i}"] <= 1e-12:                                     # N10
                continue
            if p.mode == "auto":
                k = max(p.decimal_min, min(int(r[f"q{i}"]), p.decimal_max))                   # N11
                if k == 0:
                    continue
            else:
                k = p.fixed_places
            places[c] = k
        return {"places": places}

    def _exprs(self, df, ctx, state):
        fn = {"round": nb.rint_places, "floor": nb.floor_places, "ceil": nb.ceil_places}[self.params.method]
        return {c: fn(col(c).cast("double"), k) for c, k in state["places"].items()}

    def _notes(self, state):
        for c, k in state["places"].items():
            yield c, f"{self.params.method} to {k} places"
