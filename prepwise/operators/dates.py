"""Date standardisation."""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import functions as F, types as T

from prepwise.context import ROW_ID, Role
from prepwise.functions import dates as dt
from prepwise.functions import vocab
from prepwise.operators.base import Step
from prepwise.plans.stats import cell_shares, col


class DatetimeStandardizer(Step):
    name = "datetime_standardizer"
    row_local = True

    @dataclass
    class Params:
        output_format: str = "date"           # date | datetime | auto
        date_format: str = "%Y-%m-%d"
        datetime_format: str = "%Y-%m-%d %H:%M:%S"
        detect_by_name: bool = True
        detect_by_content: bool = True
        use_dateutil: bool = True
        current_year: int = field(default_factory=lambda: _dt.date.today().year)
        as_type: str = "string"               # string | date | timestamp
        name_min_ratio: float = 0.3

    def _parse(self, df, c):
        t = df.schema[c].dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return col(c).cast("timestamp")
        return dt.parse_date_text(col(c).cast("string"), self.params.current_year, self.params.use_dateutil)

    def _fit(self, df, ctx):
        p = self.params
        fields = {f.name: f.dataType for f in df.schema.fields if f.name != ROW_ID}
        typed = (T.StringType, T.TimestampType, T.TimestampNTZType, T.DateType)
        by_name = [c for c, t in fields.items() if p.detect_by_name and isinstance(t, typed)
                   and any(w in c.lower() for w in vocab.DATE_NAME_WORDS)]
        by_role = [c for c in fields if ctx.roles.get(c) == Role.DATETIME and c not in by_name]
        rest = [c for c, t in fields.items() if isinstance(t, T.StringType) and c not in by_name + by_role]
        by_content = []
        if p.detect_by_content and rest:
            yr = p.current_year
            got = cell_shares(df, rest, {
                "cn": lambda v: dt.looks_like_date(v, yr)[0],
                "ok": lambda v: dt.looks_like_date(v, yr)[1]})
            by_content = [c for c in rest if c in got and ((got[c]["cn"] or 0) > 0.5 or (got[c]["ok"] or 0) > 0.3)]
        targets = by_name + by_role + by_content
        if not targets:
            return {"columns": []}
        # the search by content has parsed its columns, if in the same way
        known = {c: (got[c]["ok"], 1) for c in by_content} if p.use_dateutil else {}
        ask = [c for c in targets if c not in known]
        if ask:
            r = df.agg(*[F.count(self._parse(df, c)).alias(f"p{i}") for i, c in enumerate(ask)],
                       *[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(ask)]).first()
            known |= {c: (r[f"p{i}"], r[f"n{i}"]) for i, c in enumerate(ask)}
        keep = []
        for c in targets:
            parsed, nonnull = known[c]
            if parsed == 0:                                               # T10
                continue
            if c in by_name and c not in by_role and nonnull and parsed / nonnull < p.name_min_ratio \
                    and isinstance(fields[c], T.StringType):
                continue                                                  # Q4 guard
            keep.append(c)
        return {"columns": keep}

    def _exprs(self, df, ctx, state):
        p = self.params
        fmt = p.date_format if p.output_format == "date" else p.datetime_format
        out = {}
        for c in state["columns"]:
            parsed = self._parse(df, c)
            if p.as_type == "timestamp":
                out[c] = parsed
            elif p.as_type == "date":
                out[c] = parsed.cast("date")
            else:
                out[c] = F.date_format(parsed, dt.py_to_java_format(fmt))
        return out

    def _transform(self, df, ctx, state):
        p = self.params
        exprs = self._exprs(df, ctx, state)
        roles = dict(ctx.roles)
        for c in exprs:
            roles[c] = Role.DATETIME
            ctx = ctx.note(self.name, c, f"written as {'timestamp' if p.as_type == 'timestamp' else p.output_format}")
        return (df.withColumns(exprs) if exprs else df), ctx.with_(roles=roles)
