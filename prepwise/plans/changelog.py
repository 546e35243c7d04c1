"""Change log (R10–R14): cell diffs of every step, removed rows, per-step counts,
column state and a machine-readable report."""
from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, functions as F, types as T

from prepwise.context import BEFORE, ROW_ID
from prepwise.plans.stats import col

LOG_SCHEMA = "step string, column string, row_id long, original string, new string, reason string"


def cell_diff(before: DataFrame, step_name: str, exprs: dict, reason: str = "") -> DataFrame:
    """Old and new value of every changed cell, from one projection of the
    input (no join): stack (column, old, new), keep null-safe differences."""
    spark = before.sparkSession
    if not exprs:
        return spark.createDataFrame([], LOG_SCHEMA)
    items = list(exprs.items())
    cells = before.select(F.col(ROW_ID).alias("row_id"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("original"),
                 e.cast("string").alias("new")) for c, e in items])).alias("t"))
    cells = cells.select("row_id", "t.*").where(~F.col("original").eqNullSafe(F.col("new")))
    return cells.select(F.lit(step_name).alias("step"), "column", "row_id", "original", "new",
                        F.lit(reason or step_name).alias("reason"))


def logged_transform(fitted, df: DataFrame, ctx):
    """``(result, context, log)`` of a step whose changes only its result shows.

    Every row carries its old cells as one struct through the step's windows, joins and aggregations, and the
    log is exploded from the result: no join for changed cells.  Rows that the step removes are events
    without a column, found by an anti-join of row ids."""
    step, users = fitted.step, [c for c in df.columns if c != ROW_ID]
    carried = df.withColumn(BEFORE, F.struct(*[col(c).alias(c) for c in users]))
    after, ctx = fitted.transform(carried, ctx)
    cells = []
    for c, new in step._logged(after, users, fitted.state).items():
        old = F.col(BEFORE).getField(c)
        new_kind = after.select(new.alias("x")).schema["x"].dataType
        if step._failed_only():
            differs = old.isNotNull() & new.isNull()
        elif step._recodes():
            differs = old.isNotNull() | new.isNotNull()
        else:
            differs = _differs(old, df.schema[c].dataType, new, new_kind)
        cells.append(F.struct(F.lit(c).alias("column"), old.cast("string").alias("original"), new.cast("string").alias("new"), differs.alias("differs")))
    log = df.sparkSession.createDataFrame([], LOG_SCHEMA)
    if cells:
        long = after.select(F.col(ROW_ID).alias("row_id"), F.explode(F.array(*cells)).alias("t")).select("row_id", "t.*").where("differs")
        log = log.unionByName(long.select(F.lit(step.name).alias("step"), "column", "row_id", "original", "new", F.lit(step.name).alias("reason")))
    if step._removes_rows(fitted.state):
        gone = df.select(F.col(ROW_ID).alias("row_id")).join(after.select(F.col(ROW_ID).alias("row_id")), "row_id", "left_anti")
        log = log.unionByName(gone.select(F.lit(step.name).alias("step"), F.lit(None).cast("string").alias("column"), "row_id",
                                          F.lit(None).cast("string").alias("original"), F.lit(None).cast("string").alias("new"),
                                          F.lit("row removed").alias("reason")))
    return after.drop(BEFORE), ctx, log


def _differs(old, old_kind, new, new_kind):
    """Whether a cell changed: numbers compare as numbers, and a cell that became another kind of value has changed."""
    if old_kind == new_kind:
        return ~old.eqNullSafe(new)
    if isinstance(old_kind, T.NumericType) and isinstance(new_kind, T.NumericType):
        return ~old.cast(new_kind).eqNullSafe(new)
    return old.isNotNull() | new.isNotNull()


def changes_per_step(log: DataFrame) -> DataFrame:
    return log.groupBy("step").agg(F.count(F.lit(1)).alias("changes"))                # R11


def change_detail(log: DataFrame, step_order: list[str]) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(s) for s in step_order]), F.col("step"))
    return log.orderBy(rank, "row_id", "column")                                        # R12


def column_state(profile: DataFrame) -> DataFrame:
    return profile.select("column", "role", (F.col("count") - F.col("missing")).alias("non_null"),
                          "count", (F.col("missing") / F.col("count")).alias("missing_rate"))   # R13


def report(profile: DataFrame, events, step_counts: DataFrame | None = None, shape=None, metadata: dict | None = None) -> dict:
    """The machine-readable report; the cell log stays a table of its own (``cell_log``)."""
    prof = [r.asDict(recursive=True) for r in profile.collect()]      # one row per column: bounded
    counts = {r["step"]: r["changes"] for r in step_counts.collect()} if step_counts is not None else {}
    return {
        "timestamp": _dt.datetime.now().isoformat(),
        "metadata": metadata or {},
        "shape": shape,
        "total_missing": sum(p["missing"] for p in prof),
        "summary": {"events": len(events), "cell_changes": counts},
        "events": [{"step": e.step, "column": e.column, "reason": e.reason} for e in events],
        "columns": [{**p, "missing_ratio": p["missing"] / p["count"] if p["count"] else 1.0} for p in prof],
    }                                                                                    # R14


def write_report(spark, rep: dict, path: str, cell_log: DataFrame | None = None) -> None:
    """Write the report as one JSON line, and the cell changes beside it, to any folder Spark can write to."""
    text = json.dumps(rep, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    if cell_log is not None:
        cell_log.write.mode("overwrite").json(path.rstrip("/") + "-cells")
