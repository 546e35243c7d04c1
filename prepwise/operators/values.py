"""Value replacement (V1–V3), duplicate rows (U1–U5), constant columns."""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from prepwise.context import BEFORE, ROW_ID, Role
from prepwise.functions import text as tx
from prepwise.functions import vocab
from prepwise.operators.base import Step
from prepwise.plans import shared
from prepwise.plans.hot import lookup
from prepwise.plans.stats import col, distinct_and_top


class ValueReplacer(Step):
    name = "value_replacer"
    default_on = False
    row_local = True

    @dataclass
    class Params:
        replace_na: bool = True
        na_values: list = field(default_factory=lambda: list(vocab.NA_TOKENS))
        custom_rules: list = field(default_factory=list)   # (find, replace, is_regex, columns)

        def validate(self):
            import re
            for rule in self.custom_rules:
                if len(rule) < 3:
                    raise ValueError(f"rule needs (find, replace, is_regex[, columns]): {rule!r}")
                if rule[2]:
                    try:
                        re.compile(rule[0])
                    except re.error as e:
                        raise ValueError(f"bad pattern {rule[0]!r}: {e}") from e

    def _exprs(self, df, ctx, state):
        p = self.params
        types = {f.name: f.dataType for f in df.schema.fields}
        cur = {c: col(c) for c in df.columns if c != ROW_ID}
        if p.replace_na and p.na_values:
            tokens = [t for t in p.na_values]
            for c in ctx.strings(df):
                trimmed = tx.strip_ws(cur[c])
                hit = trimmed.isin(tokens) if "" not in tokens else (trimmed.isin(tokens) | (trimmed == ""))
                cur[c] = F.when(~hit | cur[c].isNull(), cur[c])                    # V1
        for rule in p.custom_rules:
            find, repl, is_regex, cols = rule[0], rule[1], rule[2], (rule[3] if len(rule) > 3 else None)
            for c in (cols or list(cur)):
                if c not in cur:
                    continue
                t = types[c]
                value = F.lit(repl).cast(t) if not isinstance(t, T.StringType) else F.lit(repl)
                if is_regex:                                                      # V3
                    hit = F.coalesce(cur[c].cast("string"), F.lit("")).rlike("^(?:" + find + ")")
                else:                                                             # V2
                    hit = F.coalesce(tx.strip_ws(cur[c].cast("string")) == F.lit(find), F.lit(False))
                cur[c] = F.when(hit, value).otherwise(cur[c])
        return {c: e for c, e in cur.items()}


def _keys(df: DataFrame, subset) -> list[str]:
    users = [c for c in df.columns if c not in (ROW_ID, BEFORE)]
    if subset:
        s = [c for c in subset if c in users]
        if s:
            return s
    return users


_DIGEST = ["__d0", "__d1"]


def _digested(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with two 64-bit hashes of its key; equal keys have equal ones, nulls included."""
    cells = [*[col(k) for k in keys], F.array(*[col(k).isNull() for k in keys])]
    return df.withColumns({d: F.xxhash64(F.lit(i), *cells) for i, d in enumerate(_DIGEST)})


def duplicate_digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """``(digest, n, lo, hi)`` of the digests that several rows share: their number, least and largest row id.
    Primitive buffers, so a hash aggregate; 16 bytes of a key are shuffled."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    if ROW_ID in df.columns:
        aggs += [F.min(ROW_ID).alias("__lo"), F.max(ROW_ID).alias("__hi")]
    return _digested(df, keys).groupBy(*_DIGEST).agg(*aggs).where(F.col("__n") > 1)


def _suspects(df: DataFrame, keys: list[str], digests: DataFrame, total: int) -> DataFrame:
    """The rows whose digest others share."""
    return lookup(_digested(df, keys), digests, _DIGEST, ["__n"], "__n", total=total).where(F.col("__n").isNotNull())


def _per_digest(rows: DataFrame, keys: list[str], end: Column | None = None, pick=F.min) -> DataFrame:
    """``(digest, kinds, n, end)``: how many different keys a digest stands for (the byte check), its rows and
    the least (or greatest) ``end``; partial aggregation leaves one row per key and task."""
    ends = [pick(end).alias("__end")] if end is not None else []
    per_key = rows.groupBy(*_DIGEST, *[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__m"), *ends)
    again = [pick("__end").alias("__end")] if end is not None else []
    return per_key.groupBy(*_DIGEST).agg(F.count(F.lit(1)).alias("__kinds"), F.sum("__m").alias("__n"), *again)


def _hashable(df: DataFrame, keys: list[str]) -> bool:
    return not any(w in df.schema[k].dataType.simpleString() for k in keys for w in ("map<", "variant"))


class DuplicateHandler(Step):
    """mark / remove (every copy) / keep_first / keep_last.

    Key digests are counted first, with the least and largest row id of each (a hash aggregate of a few
    longs per key).  Only digests that several rows share matter further: they are checked byte by byte,
    looked up per row (hot ones through a broadcast of bounded size, so a key holding a third of the
    table is no task's burden), and the row id decides.  Rows are not shuffled where few digests are
    shared.  Another order than the row id is compared on those rows only.  Colliding digests or keys that cannot
    be hashed take the plain aggregation on the key."""
    name = "duplicate_handler"
    heavy = True
    logs_cells = True

    @dataclass
    class Params:
        action: str = "remove"
        subset: list | None = None

        def validate(self):
            if self.action not in ("mark", "remove", "keep_first", "keep_last"):
                raise ValueError(f"unknown action {self.action!r}")

    def _transform(self, df, ctx, state):
        keys = _keys(df, self.params.subset)
        action = self.params.action
        order = [o for o in ctx.order_by if o in df.columns] or [ROW_ID]
        by_id = action in ("mark", "remove") or ROW_ID in df.columns
        out = self._by_digest(df, keys, action, order) if by_id and keys and _hashable(df, keys) else None
        if out is None:
            out = self._by_key(df, keys, action, order)
        if action == "mark":
            return out, ctx.with_(roles={**ctx.roles, "_is_duplicate": Role.BOOLEAN})
        return out, ctx.note(self.name, None, f"duplicates: {action}")

    def _logged(self, after, before, state):
        return {}

    def _removes_rows(self, state):
        return self.params.action != "mark"

    @staticmethod
    def _by_digest(df, keys, action, order):
        names = [col(c) for c in df.columns]
        digests = shared.save(duplicate_digests(df, keys), "digests")
        total = digests.agg(F.sum("__n")).first()[0]
        if total is None:                                        # no two rows share a digest
            return df.select(*names, F.lit(False).alias("_is_duplicate")) if action == "mark" else df
        rows = _suspects(df, keys, digests, total)
        value = {"mark": "__n", "remove": "__n", "keep_first": "__lo", "keep_last": "__hi"}[action]
        if value != "__n" and order != [ROW_ID]:
            # the first (last) row along another order: the end of its order columns, with the row id
            ends = F.struct(*[col(o) for o in dict.fromkeys([*order, ROW_ID])])
            ranked = _per_digest(rows, keys, ends, F.max if action == "keep_last" else F.min)
            digests = shared.save(ranked.select(*_DIGEST, "__kinds", "__n", F.col("__end").getField(ROW_ID).alias(value)), "digests")
            kinds = digests.agg(F.max("__kinds")).first()[0]
        else:
            kinds = _per_digest(rows, keys).agg(F.max("__kinds")).first()[0]
        if kinds > 1:
            return None
        rows = lookup(_digested(df, keys), digests, _DIGEST, [value], "__n", total=total)
        if action == "mark":
            return rows.select(*names, F.col(value).isNotNull().alias("_is_duplicate"))
        kept = F.col(value).isNull()
        return rows.where(kept if action == "remove" else kept | (F.col(value) == F.col(ROW_ID))).select(*names)

    @staticmethod
    def _by_key(df, keys, action, order):
        if action == "mark":
            dups = (df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
                    .where(F.col("__n") > 1).select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]))
            cond = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
            out = df.join(dups.withColumn("__dup", F.lit(True)), cond, "left")
            return out.select(*[col(c) for c in df.columns], F.coalesce(F.col("__dup"), F.lit(False)).alias("_is_duplicate"))
        others = [c for c in df.columns if c not in keys]
        rest = F.struct(*[col(c).alias(c) for c in others]) if others else F.struct(F.lit(0).alias("__z"))
        if action == "remove":
            g = df.groupBy(*[col(k).alias(k) for k in keys]).agg(
                F.count(F.lit(1)).alias("__n"), F.any_value(rest).alias("__r")).where(F.col("__n") == 1)
        else:
            pick = F.min_by if action == "keep_first" else F.max_by
            g = df.groupBy(*[col(k).alias(k) for k in keys]).agg(pick(rest, F.struct(*[col(o) for o in order])).alias("__r"))
        return g.select(*[col(k) for k in keys], *[F.col("__r")[c].alias(c) for c in others]).select(*[col(c) for c in df.columns])


class ConstantRemover(Step):
    name = "constant_remover"

    @dataclass
    class Params:
        max_unique_values: int = 1
        remove_zero_variance: bool = True
        low_variance_threshold: float = 0.0
        missing_dominant_ratio: float = 0.95

    def _fit(self, df, ctx):
        p = self.params
        fields = [f for f in df.schema.fields if f.name != ROW_ID]
        if not fields:
            return {"drop": {}}
        orderable = [f.name for f in fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        aggs = [F.count(F.lit(1)).alias("__n")]
        for i, f in enumerate(fields):
            x = col(f.name)
            aggs.append(F.count(x).alias(f"nn{i}"))
            if f.name in orderable and p.max_unique_values <= 1:
                aggs.append(F.min(x).eqNullSafe(F.max(x)).alias(f"same{i}"))
            if isinstance(f.dataType, T.NumericType):
                aggs.append(F.stddev_samp(x.cast("double")).alias(f"sd{i}"))
        r = df.agg(*aggs).first()
        n = r["__n"]
        distinct = {}
        if p.max_unique_values > 1:
            distinct, _ = distinct_and_top(df, orderable, k=0)
        drop = {}
        for i, f in enumerate(fields):
            why = []
            nn = r[f"nn{i}"]
            if p.max_unique_values <= 1:
                if f.name in orderable and (nn == 0 or r[f"same{i}"]):
                    why.append(f"{min(nn, 1)} distinct value(s)")                 # Z1
            elif f.name in distinct and distinct[f.name] <= p.max_unique_values:
                why.append(f"{distinct[f.name]} distinct values")
            if isinstance(f.dataType, T.NumericType) and p.remove_zero_variance:
                sd = r[f"sd{i}"]
                if sd is None or sd != sd or sd == 0:                              # Z2
                    why.append("zero variance")
                elif sd < p.low_variance_threshold:                                # Z3
                    why.append(f"low variance {sd:.6g}")
            if n and (n - nn) / n >= p.missing_dominant_ratio:                    # Z4
                why.append(f"missing share {(n - nn) / n:.3f}")
            if why:
                drop[f.name] = "; ".join(why)
        return {"drop": drop}

    def _transform(self, df, ctx, state):
        cols = list(state["drop"])
        for c, why in state["drop"].items():
            ctx = ctx.note(self.name, c, why)
        return (df.drop(*cols) if cols else df), ctx.dropped(cols)                  # Z5
