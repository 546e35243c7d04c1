"""Step protocol: ``fit(df, ctx) -> Fitted``; ``Fitted.transform(df, ctx) -> (df, ctx)``.

``fit`` may run Spark aggregates and returns a small JSON-serialisable state.
``transform`` only builds a lazy plan.  Row-local steps also expose their
per-column expressions so the cell log can diff old and new in one select.
"""
from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields
from typing import Any, ClassVar

from pyspark.sql import Column, DataFrame

from prepwise.context import Context


class Step:
    name: ClassVar[str] = "base"
    default_on: ClassVar[bool] = True
    row_local: ClassVar[bool] = False   # only projections/filters → works on streams
    Params: ClassVar[type] = None

    def __init__(self, **params: Any):
        if self.Params is None:
            if params:
                raise TypeError(f"{self.name} takes no parameters: {sorted(params)}")
            self.params = None
        else:
            known = {f.name for f in fields(self.Params)}
            unknown = set(params) - known
            if unknown:
                raise TypeError(f"unknown parameters for {self.name}: {sorted(unknown)}")
            self.params = self.Params(**params)
            check = getattr(self.params, "validate", None)
            if check:
                check()

    # --- to implement -------------------------------------------------
    def _fit(self, df: DataFrame, ctx: Context) -> dict:
        return {}

    def _exprs(self, df: DataFrame, ctx: Context, state: dict) -> dict[str, Column]:
        """New expression per existing column (row-local steps)."""
        return {}

    def _transform(self, df: DataFrame, ctx: Context, state: dict) -> tuple[DataFrame, Context]:
        exprs = self._exprs(df, ctx, state)
        for column, reason in self._notes(state):
            ctx = ctx.note(self.name, column, reason)
        return (df.withColumns(exprs) if exprs else df), ctx

    # --- cell log of steps that are not row-local -----------------------
    logs_cells: ClassVar[bool] = False      # changes cells or rows in ways that only its result shows

    def _logged(self, after: DataFrame, before: list[str], state: dict) -> dict[str, Column]:
        """What stands in the result for each column of the input that the log follows."""
        from prepwise.plans.stats import col
        return {c: col(c) for c in before if c in after.columns}

    def _failed_only(self) -> bool:
        """Log only cells that were lost."""
        return False

    def _recodes(self) -> bool:
        """Every cell gets another meaning, also where a code happens to equal the old number."""
        return False

    def _removes_rows(self, state: dict) -> bool:
        return False

    def _notes(self, state: dict):
        """``(column, reason)`` of the events that the step writes."""
        return ()

    # --- public ---------------------------------------------------------
    def fit(self, df: DataFrame, ctx: Context | None = None) -> "Fitted":
        ctx = ctx or Context.from_schema(df)
        return Fitted(self, self._fit(df, ctx))

    def fit_transform(self, df: DataFrame, ctx: Context | None = None) -> tuple[DataFrame, Context]:
        ctx = ctx or Context.from_schema(df)
        return self.fit(df, ctx).transform(df, ctx)

    def describe(self) -> dict:
        return {"name": self.name, "default_on": self.default_on,
                "params": asdict(self.params) if self.params is not None else {}}


@dataclass
class Fitted:
    step: Step
    state: dict

    def transform(self, df: DataFrame, ctx: Context | None = None) -> tuple[DataFrame, Context]:
        ctx = ctx or Context.from_schema(df)
        if df.isStreaming and not self.step.row_local:
            raise ValueError(f"step {self.step.name} needs the whole table and cannot run on a stream")
        return self.step._transform(df, ctx, self.state)

    def exprs(self, df: DataFrame, ctx: Context) -> dict[str, Column]:
        return self.step._exprs(df, ctx, self.state) if self.step.row_local else {}

    def to_json(self) -> str:
        return json.dumps({"step": self.step.name, "state": self.state}, default=str, ensure_ascii=False)
