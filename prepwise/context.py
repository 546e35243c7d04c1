"""Driver-side state that travels with a DataFrame through the steps.

Only small metadata lives here (roles, ID columns, fitted numbers, notes);
row data always stays in the DataFrame.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace
from enum import Enum
from typing import Any, Mapping

from pyspark.sql import DataFrame, types as T

ROW_ID = "_row_id"
BEFORE = "_before"          # the cells of a row before a step, carried along while the step is logged


class Role(str, Enum):
    NUMERIC = "numeric"
    CATEGORICAL = "categorical"
    DATETIME = "datetime"
    TEXT = "text"
    BOOLEAN = "boolean"
    OTHER = "other"


def role_from_type(dt: T.DataType) -> Role:
    """Role implied by the physical type alone (used before content detection)."""
    if isinstance(dt, T.BooleanType):
        return Role.BOOLEAN
    if isinstance(dt, T.NumericType):
        return Role.NUMERIC
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return Role.DATETIME
    if isinstance(dt, T.StringType):
        return Role.TEXT
    return Role.OTHER


@dataclass(frozen=True)
class Event:
    """A step- or column-level note (the row-level cell log is a DataFrame)."""
    step: str
    column: str | None
    reason: str


@dataclass(frozen=True)
class Context:
    roles: Mapping[str, Role] = field(default_factory=dict)
    id_columns: frozenset = frozenset()
    order_by: tuple = (ROW_ID,)
    skewness: Mapping[str, float | None] = field(default_factory=dict)
    events: tuple = ()

    @staticmethod
    def from_schema(df: DataFrame, order_by: tuple | list | None = None) -> "Context":
        roles = {f.name: role_from_type(f.dataType) for f in df.schema.fields if f.name != ROW_ID}
        order = tuple(order_by) if order_by else ()
        if ROW_ID in df.columns and ROW_ID not in order:
            order = order + (ROW_ID,)
        return Context(roles=roles, order_by=order or (ROW_ID,))

    def with_(self, **kw: Any) -> "Context":
        return replace(self, **kw)

    def note(self, step: str, column: str | None, reason: str) -> "Context":
        return replace(self, events=self.events + (Event(step, column, reason),))

    def user_columns(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c != ROW_ID]

    # Column selectors shared by the steps -------------------------------
    def numeric(self, df: DataFrame) -> list[str]:
        """Role NUMERIC, not an ID, physically numeric."""
        kinds = dict((f.name, f.dataType) for f in df.schema.fields)
        return [c for c in df.columns
                if self.roles.get(c) == Role.NUMERIC and c not in self.id_columns
                and isinstance(kinds.get(c), T.NumericType)]

    def text(self, df: DataFrame) -> list[str]:
        """Role TEXT (IDs included), physically string."""
        kinds = dict((f.name, f.dataType) for f in df.schema.fields)
        return [c for c in df.columns
                if self.roles.get(c) == Role.TEXT and isinstance(kinds.get(c), T.StringType)]

    def categorical(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if self.roles.get(c) == Role.CATEGORICAL]

    def strings(self, df: DataFrame) -> list[str]:
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and f.name != ROW_ID]

    # Schema bookkeeping ------------------------------------------------
    def renamed(self, mapping: Mapping[str, str]) -> "Context":
        return replace(
            self,
            roles={mapping.get(k, k): v for k, v in self.roles.items()},
            id_columns=frozenset(mapping.get(c, c) for c in self.id_columns),
            skewness={mapping.get(k, k): v for k, v in self.skewness.items()},
            order_by=tuple(mapping.get(c, c) for c in self.order_by),
        )

    def dropped(self, cols) -> "Context":
        cols = set(cols)
        return replace(
            self,
            roles={k: v for k, v in self.roles.items() if k not in cols},
            id_columns=frozenset(c for c in self.id_columns if c not in cols),
            skewness={k: v for k, v in self.skewness.items() if k not in cols},
        )
