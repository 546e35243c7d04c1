"""Role detection and conversion (D1–D13) and ID columns."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from prepwise.context import ROW_ID, Context, Role, role_from_type
from prepwise.functions import dates as dt
from prepwise.functions import numbers as nb
from prepwise.functions import vocab
from prepwise.functions.text import WS
from prepwise.operators.base import Step
from prepwise.plans import ordered
from prepwise.plans.stats import cell_shares, col, distinct_counts

INT_RE = "^" + WS + "*[+-]?[0-9]+(\\.0*)?" + WS + "*$"
UUID_RE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
BOOL_WORDS = vocab.TRUE_WORDS + vocab.FALSE_WORDS


def _has_word(name: str, words) -> bool:
    low = name.lower()
    return any(w.lower() in low for w in words)


def type_stats(df: DataFrame, cols: list[str], formats=dt.DETECT_FORMATS) -> dict:
    """Parse hit counts and boolean words present, for all string columns in
    one job.  The table is read in long form (column, value) and grouped by
    column, so every test is compiled once however wide the table is, and the
    partial aggregation ships one row per column per task."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("v")) for c in cols])).alias("kv"))
    x = F.col("kv.v")
    lc = F.lower(F.trim(x))
    num = nb.to_number(x)          # shape-guarded: the cast never sees non-numbers
    aggs = [F.count(F.lit(1)).alias("n"), F.count(x).alias("nn"), F.count(num).alias("num"),
            F.count_if(x.rlike(INT_RE)).alias("int"), F.skewness(num).alias("sk"),
            F.count_if(x.isNotNull() & ~lc.isin(BOOL_WORDS)).alias("nb")]
    aggs += [F.count(dt.try_format(x, f)).alias(f"d{j}") for j, f in enumerate(formats)]
    aggs += [F.max((lc == w).cast("int")).alias(f"w{j}") for j, w in enumerate(BOOL_WORDS)]
    rows = {r["column"]: r for r in long.groupBy(F.col("kv.column").alias("column")).agg(*aggs).collect()}
    out = {"__n": next(iter(rows.values()))["n"] if rows else 0}
    empty = {"nn": 0, "num": 0, "int": 0, "sk": None, "nb": 0,
             **{f"d{j}": 0 for j in range(len(formats))}, **{f"w{j}": 0 for j in range(len(BOOL_WORDS))}}
    for c in cols:
        r = rows.get(c, empty)
        out[c] = dict(
            nonnull=r["nn"], num=r["num"], int=r["int"],
            skew=r["sk"] if (r["num"] or 0) > 2 else None,
            non_bool=r["nb"],
            dates={f: r[f"d{j}"] for j, f in enumerate(formats)},
            words={w for j, w in enumerate(BOOL_WORDS) if r[f"w{j}"] == 1},
        )
    return out


class TypeDetector(Step):
    name = "type_detector"

    logs_cells = True

    @dataclass
    class Params:
        auto_convert: bool = True
        numeric_threshold: float = 0.9
        datetime_threshold: float = 0.8
        categorical_max_ratio: float = 0.1
        exact: bool = True            # False: distinct ratios from the sketch alone

    def _fit(self, df, ctx):
        p = self.params
        fields = {f.name: f.dataType for f in df.schema.fields if f.name != ROW_ID}
        strings = [c for c, t in fields.items() if isinstance(t, T.StringType)]
        numerics = [c for c, t in fields.items() if isinstance(t, T.NumericType)]
        st = type_stats(df, strings) if strings else {"__n": df.count()}
        n_all = st["__n"]
        extra = [F.skewness(col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(numerics)] + \
                [F.count(col(c)).alias(f"n{i}") for i, c in enumerate(numerics)]
        distinct, r = distinct_counts(df, strings, exact=p.exact, extra=extra)
        skew = {c: (r[f"s{i}"] if r[f"n{i}"] > 2 else None) for i, c in enumerate(numerics)}
        roles, convert = {}, {}
        for c, t in fields.items():
            if c not in strings:
                roles[c] = role_from_type(t).value
                continue
            s = st[c]
            nonnull = s["nonnull"]
            if nonnull == 0:                                  # D1
                roles[c] = Role.TEXT.value
                continue
            num_ratio = s["num"] / n_all
            best_fmt, best_hits = None, -1
            for f in dt.DETECT_FORMATS:                        # D4, order-free best
                if s["dates"][f] > best_hits:
                    best_fmt, best_hits = f, s["dates"][f]
            dt_ratio = best_hits / n_all
            num_ok = num_ratio >= p.numeric_threshold
            dt_ok = dt_ratio >= p.datetime_threshold
            if num_ok and dt_ok:                               # D5
                role = Role.DATETIME if _has_word(c, vocab.DATE_NAME_WORDS) else Role.NUMERIC
            elif s["num"] == nonnull:
                # every non-null value is a number: a typed reader would already
                # have made this a numeric column (D2), whatever the null share
                role = Role.NUMERIC
            elif dt_ok:
                role = Role.DATETIME
            elif num_ok:
                role = Role.NUMERIC
            elif s["non_bool"] == 0 and any(s["words"] <= set(pair) for pair in vocab.BOOL_PAIRS):
                role = Role.BOOLEAN                            # D6
            elif distinct.get(c, 0) / nonnull < p.categorical_max_ratio:
                role = Role.CATEGORICAL                        # D7
            else:
                role = Role.TEXT                               # D8
            roles[c] = role.value
            if role == Role.NUMERIC:
                skew[c] = s["skew"]
                whole = s["int"] == nonnull and nonnull == n_all and s["num"] == nonnull
                convert[c] = {"to": "long" if whole else "double"}
            elif role == Role.DATETIME:
                convert[c] = {"to": "timestamp", "format": best_fmt}
            elif role == Role.BOOLEAN:
                convert[c] = {"to": "boolean"}
        return {"roles": roles, "convert": convert if p.auto_convert else {}, "skew": skew}

    def _logged(self, after, before, state):
        return {c: e for c, e in super()._logged(after, before, state).items() if c in state["convert"]}

    def _failed_only(self):
        return True                                              # D9–D11: cells that the conversion loses

    def _transform(self, df, ctx, state):
        exprs = {}
        for c, conv in state["convert"].items():
            x = col(c)
            if conv["to"] == "double":
                exprs[c] = nb.to_number(x)
            elif conv["to"] == "long":
                exprs[c] = nb.to_number(x).cast("long")
            elif conv["to"] == "timestamp":
                exprs[c] = dt.try_format(x, conv["format"])
            elif conv["to"] == "boolean":
                lc = F.lower(F.trim(x))
                exprs[c] = F.when(lc.isin(vocab.TRUE_WORDS), True).when(lc.isin(vocab.FALSE_WORDS), False)
        out = df.withColumns(exprs) if exprs else df
        roles = {c: Role(r) for c, r in state["roles"].items()}
        ctx = ctx.with_(roles={**ctx.roles, **roles}, skewness={**ctx.skewness, **state["skew"]})
        for c, conv in state["convert"].items():
            ctx = ctx.note(self.name, c, f"read as {conv['to']}")
        return out, ctx


class IdColumnDetector(Step):
    name = "id_column_detector"

    @dataclass
    class Params:
        unique_ratio_threshold: float = 0.9
        check_name_pattern: bool = True
        check_sequential: bool = True
        check_uuid: bool = True
        match: str = "substring"
        exact: bool = True

    def _fit(self, df, ctx):
        p = self.params
        fields = {f.name: f.dataType for f in df.schema.fields if f.name != ROW_ID}
        cols = list(fields)
        if not cols:
            return {"ids": {}}
        extra = [F.count(F.lit(1)).alias("__n"), *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(cols)]]
        distinct, r = distinct_counts(df, cols, exact=p.exact, extra=extra)
        n_all = r["__n"]
        nonnull = {c: r[f"n{i}"] for i, c in enumerate(cols)}
        reasons: dict[str, list[str]] = {c: [] for c in cols}
        for c in cols:
            if p.check_name_pattern:                                       # I1
                low = c.lower().strip()
                if p.match == "token":
                    import re
                    toks = set(re.split(r"[^0-9a-z一-鿿]+", low))
                    hit = next((w for w in vocab.ID_NAME_WORDS if w in toks), None)
                else:
                    hit = next((w for w in vocab.ID_NAME_WORDS if w in low), None)
                if hit:
                    reasons[c].append(f"name contains {hit!r}")
            if nonnull[c] > 0 and n_all and distinct[c] / n_all >= p.unique_ratio_threshold:  # I2
                reasons[c].append(f"unique ratio {distinct[c] / n_all:.3f}")
        if p.check_sequential:                                             # I3
            # more than 80 % positive equal steps take that many distinct values: exact counts
            # rule columns out for certain, sketched ones rule out none
            cand = [c for c, t in fields.items() if isinstance(t, T.NumericType) and nonnull[c] > 2 and not reasons[c]
                    and (not p.exact or distinct[c] >= 0.8 * (nonnull[c] - 1) + 1)]
            for c, step in sequential_steps(df, cand, nonnull).items():
                reasons[c].append(f"arithmetic sequence, step {step}")
        if p.check_uuid:                                                   # I4
            strings = [c for c, t in fields.items() if isinstance(t, T.StringType)]
            if strings:
                share = cell_shares(df, strings, {"s": lambda v: v.rlike(UUID_RE)})
                for c in strings:
                    if c in share and share[c]["s"] > 0.5:
                        reasons[c].append("values look like UUIDs")
        return {"ids": {c: "; ".join(r) for c, r in reasons.items() if r}}

    def _transform(self, df, ctx, state):
        ids = frozenset(state["ids"])
        for c, r in state["ids"].items():
            ctx = ctx.note(self.name, c, r)
        return df, ctx.with_(id_columns=ids)


def sequential_steps(df: DataFrame, cols: list[str], nonnull: dict) -> dict:
    """Columns whose sorted values mostly rise by one step: the smallest modal difference, if it is
    positive and holds more than 80 % of the n-1 differences.

    All columns are read together in long form: value counts, one set of range buckets; equal
    values are differences of zero, neighbours within a bucket come from ``lag``, those across
    buckets from a table with one row per bucket and column."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), col(c).cast("double").alias("v")) for i, c in enumerate(cols)])).alias("kv"))
    vc = long.select("kv.c", "kv.v").where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    b = ordered.bucketize(vc, ["c", "v"])
    w = Window.partitionBy(ordered.BUCKET, "c").orderBy("v")
    inner = b.select("c", (F.col("v") - F.lag("v").over(w)).alias("d"), F.lit(1).cast("long").alias("k")).where(F.col("d").isNotNull())
    edges = b.groupBy("c", ordered.BUCKET).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    cross = edges.select("c", (F.col("lo") - F.lag("hi").over(Window.partitionBy("c").orderBy(ordered.BUCKET))).alias("d"),
                         F.lit(1).cast("long").alias("k")).where(F.col("d").isNotNull())
    ties = vc.groupBy("c").agg(F.sum(F.col("n") - 1).alias("k")).where("k > 0").select("c", F.lit(0.0).alias("d"), "k")
    per = inner.unionByName(cross).unionByName(ties).groupBy("c", "d").agg(F.sum("k").alias("k"))
    top = Window.partitionBy("c").orderBy(F.desc("k"), F.asc("d"))
    rows = per.withColumn("rk", F.row_number().over(top)).where("rk = 1").collect()        # one row per column
    return {cols[r["c"]]: r["d"] for r in rows if r["d"] > 0 and r["k"] / (nonnull[cols[r["c"]]] - 1) > 0.8}
