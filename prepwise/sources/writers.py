"""Writers (K1–K5): extension dispatch; row count observed during the write."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, functions as F

from prepwise.context import ROW_ID


def save(df: DataFrame, path: str, fmt: str | None = None, encoding: str = "utf-8",
         mode: str = "overwrite", keep_row_id: bool = False) -> dict:
    ext = (fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".")).lower()
    if not keep_row_id and ROW_ID in df.columns:
        df = df.drop(ROW_ID)
    obs = Observation("save")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode)
    if ext == "parquet":
        w.parquet(path)                                                                  # K4 (fixed)
    elif ext == "json":
        w.json(path, encoding=encoding)                                                  # K3
    elif ext == "tsv":
        w.option("header", True).option("sep", "\t").csv(path, encoding=encoding)        # K2
    else:
        w.option("header", True).csv(path, encoding=encoding)                           # K1 / K4
    return {"file_path": path, "rows": obs.get["rows"], "cols": len(df.columns)}         # K5
