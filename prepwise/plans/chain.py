"""The ordered cleaning pipeline."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from prepwise.context import ROW_ID, Context
from prepwise.operators.analysis import CorrelationAnalyzer, Profiler, profile
from prepwise.operators.dates import DatetimeStandardizer
from prepwise.operators.detect import IdColumnDetector, TypeDetector
from prepwise.operators.features import Binning, CategoricalEncoder, FeatureScaler, SkewnessCorrector
from prepwise.operators.missing import MissingHandler
from prepwise.operators.numeric_text import DecimalUnifier, PercentageUnifier, UnitDetector
from prepwise.operators.outliers import OutlierDetector
from prepwise.operators.text_steps import ColumnNameCleaner, EncodingNormalizer, TextStandardizer
from prepwise.operators.values import ConstantRemover, DuplicateHandler, ValueReplacer
from prepwise.operators.base import Step
from prepwise.plans import changelog, shared

REGISTRY = [
    EncodingNormalizer, ColumnNameCleaner, TypeDetector, IdColumnDetector, TextStandardizer,
    DatetimeStandardizer, ValueReplacer, DuplicateHandler, ConstantRemover, UnitDetector,
    PercentageUnifier, DecimalUnifier, OutlierDetector, MissingHandler, FeatureScaler,
    SkewnessCorrector, Binning, CategoricalEncoder, CorrelationAnalyzer, Profiler,
]
BY_NAME = {cls.name: cls for cls in REGISTRY}


def steps() -> list[dict]:
    """The step catalogue in run order."""
    out = []
    for cls in REGISTRY:
        inst = cls()
        out.append({"name": cls.name, "default_on": cls.default_on,
                    "has_config": cls.Params is not None, "default_config": inst.describe()["params"],
                    "description": (cls.__doc__ or "").strip().splitlines()[0] if cls.__doc__ else ""})
    return out


class CleaningPipeline:
    """L1/L2: steps in the fixed order; ``enabled_steps`` switches by name win
    over class defaults; unknown config keys raise."""

    def __init__(self, enabled_steps: dict | None = None, step_configs: dict | None = None,
                 checkpoint_after="auto", log_cells: bool = False):
        enabled_steps = enabled_steps or {}
        step_configs = step_configs or {}
        unknown = (set(enabled_steps) | set(step_configs)) - set(BY_NAME)
        if unknown:
            raise ValueError(f"unknown steps: {sorted(unknown)}")
        for name, cfg in step_configs.items():      # L2: validate every config, on or off
            BY_NAME[name](**cfg)
        self.steps = []
        for cls in REGISTRY:
            on = enabled_steps.get(cls.name, cls.default_on)
            if on:
                self.steps.append(cls(**step_configs.get(cls.name, {})))
        self.checkpoint_after = checkpoint_after
        self.log_cells = log_cells

    def _cut_after(self, i: int) -> bool:
        """Write a table after step i?  "auto": after a step whose transform runs
        Python (Arrow UDFs) or shuffles, when a later step still has to fit —
        later fits then read the materialised rows instead of recomputing them."""
        step = self.steps[i]
        if self.checkpoint_after != "auto":
            return step.name in set(self.checkpoint_after or ())
        later_fits = any(type(s)._fit is not Step._fit for s in self.steps[i + 1:])
        return later_fits and bool(getattr(step, "heavy", False))

    def fit(self, df: DataFrame, ctx: Context | None = None) -> "FittedPipeline":
        ctx = ctx or Context.from_schema(df)
        written = shared.written()
        fitted, logs = [], []
        for i, step in enumerate(self.steps):
            f = step.fit(df, ctx)
            log = self.log_cells and ROW_ID in df.columns and not df.isStreaming
            if log and step.logs_cells:
                df, ctx, changes = changelog.logged_transform(f, df, ctx)
                logs.append(changes)
            else:
                if log and step.row_local:
                    logs.append(changelog.cell_diff(df, step.name, f.exprs(df, ctx)))
                df, ctx = f.transform(df, ctx)
            if self._cut_after(i) and not df.isStreaming:
                df = shared.save(df, "cut")        # Parquet in spark.checkpoint.dir: later fits read only the columns they need
            fitted.append(f)
        return FittedPipeline(fitted, df, ctx, logs, tables=shared.written() - written)

    def run(self, df: DataFrame, ctx: Context | None = None) -> tuple[DataFrame, Context]:
        fp = self.fit(df, ctx)
        return fp.result, fp.context

    def run_step_by_step(self, df: DataFrame, ctx: Context | None = None) -> list[DataFrame]:
        """L3: one lazy DataFrame per step (immutability gives real snapshots)."""
        ctx = ctx or Context.from_schema(df)
        snaps = [df]
        for step in self.steps:
            df, ctx = step.fit(df, ctx).transform(df, ctx)
            snaps.append(df)
        return snaps


@dataclass
class FittedPipeline:
    fitted: list
    result: DataFrame
    context: Context
    logs: list = field(default_factory=list)
    meta: dict = field(default_factory=dict)
    tables: set = field(default_factory=set)

    def release(self) -> None:
        """Delete the tables that the run wrote to the shared folder.  ``result`` and the logs read them, so write or
        collect those first; the fitted steps stay usable.  What is not released goes when the process ends."""
        shared.release(self.tables)

    def transform(self, df: DataFrame, ctx: Context | None = None) -> tuple[DataFrame, Context]:
        """Apply the fitted parameters to new data (no refit)."""
        ctx = ctx or Context.from_schema(df)
        for f in self.fitted:
            df, ctx = f.transform(df, ctx)
        return df, ctx

    def profile(self) -> DataFrame:
        return profile(self.result, self.context)

    def cell_log(self) -> DataFrame:
        spark = self.result.sparkSession
        out = spark.createDataFrame([], changelog.LOG_SCHEMA)
        for l in self.logs:
            out = out.unionByName(l)
        return out

    def state(self) -> list[dict]:
        return [{"step": f.step.name, "state": f.state} for f in self.fitted]


def clean(spark, path: str, enabled_steps: dict | None = None, step_configs: dict | None = None,
          encoding: str | None = None, order_by: list | None = None, skip=(), enable=(),
          outlier_method=None, outlier_action=None, missing_strategy=None, decimal_places=None,
          percentage_mode=None, scaler_method=None) -> FittedPipeline:
    """Load, then run the pipeline; switches mirror the command line
    (enable wins over skip)."""
    from prepwise.sources.readers import load
    enabled = dict(enabled_steps or {})
    for s in skip:
        enabled[s] = False
    for s in enable:
        enabled[s] = True
    cfg = {k: dict(v) for k, v in (step_configs or {}).items()}
    if outlier_method:
        cfg.setdefault("outlier_detector", {})["method"] = outlier_method
    if outlier_action:
        cfg.setdefault("outlier_detector", {})["action"] = outlier_action
    if missing_strategy:
        cfg.setdefault("missing_handler", {})["strategy"] = missing_strategy
    if decimal_places is not None:
        cfg.setdefault("decimal_unifier", {}).update(mode="fixed", fixed_places=decimal_places)
    if percentage_mode:
        cfg.setdefault("percentage_unifier", {})["mode"] = percentage_mode
    if scaler_method:
        cfg.setdefault("feature_scaler", {})["method"] = scaler_method
        enabled.setdefault("feature_scaler", True)
    df, ctx, meta = load(spark, path, encoding=encoding, order_by=order_by)
    fp = CleaningPipeline(enabled, cfg).fit(df, ctx)
    fp.meta = meta
    return fp
