"""Applying a fitted pipeline to a streaming DataFrame.

Steps whose transform is a projection or filter (text cleaning, value
replacement, units, percent, decimals, outlier flags/caps with fitted fences,
constant fills, scaling, skew transforms, width/k-means bins, encodings) run
unchanged on ``readStream`` input.  Steps that need the whole table (duplicate
removal, ordered fills, equal-frequency bins) raise, as a stream has no end.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from prepwise.context import Context


def apply_to_stream(fitted_pipeline, stream: DataFrame, ctx: Context | None = None) -> tuple[DataFrame, Context]:
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    ctx = ctx or Context.from_schema(stream)
    for f in fitted_pipeline.fitted:
        stream, ctx = f.transform(stream, ctx)
    return stream, ctx


def streamable(fitted_pipeline) -> list[str]:
    return [f.step.name for f in fitted_pipeline.fitted if f.step.row_local]


def write_stream(stream: DataFrame, path: str, name: str, fmt: str = "parquet", trigger_seconds: int | None = None):
    """Start a file sink for a prepared stream.  Its progress checkpoint lives
    under the session's shared ``spark.checkpoint.dir`` so a restarted query
    (or one that lost executors) resumes exactly once."""
    import os

    from prepwise.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(stream.sparkSession)
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", os.path.join(base, "streams", name)).option("path", path))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
