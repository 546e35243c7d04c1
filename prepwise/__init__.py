"""prepwise — Spark-native cleaning, profiling and preparation of tables.

Every step is a fit/transform pair over DataFrames: ``fit`` runs distributed
aggregates that return a handful of parameters, ``transform`` adds native
column expressions (or a distributed join/window).  No row data passes
through the driver, and a fitted pipeline can be applied again to new data.
"""
import sys as _sys

# Functions of this package used inside Arrow UDFs are shipped by value, so
# executors need no installed copy of the package (only pandas/numpy/pyarrow).
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 — older cloudpickle: fall back to --py-files
    pass

from prepwise.context import Context, Role
from prepwise.plans.chain import CleaningPipeline, FittedPipeline, clean, steps
from prepwise.sources.readers import load, prepare
from prepwise.sources.writers import save

__all__ = [
    "CleaningPipeline", "FittedPipeline", "Context", "Role",
    "clean", "load", "prepare", "save", "steps",
]
