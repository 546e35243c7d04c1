"""Tables written to the shared folder of ``spark.checkpoint.dir``: they cut lineage, survive lost
executors, keep column pruning, and are deleted when their scope or the process ends."""
from __future__ import annotations

import atexit
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prepwise.session import ensure_checkpoint_dir

_open: dict[str, SparkSession] = {}           # folders written by this process and not yet deleted


def save(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and return the reader of the written table."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepwise-{what}-{uuid.uuid4().hex}"
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    stored = df.withColumns({c: F.lit(None).cast("boolean") for c in void}) if void else df
    _open[path] = spark
    stored.write.parquet(path)
    table = spark.read.schema(stored.schema).parquet(path)
    return table.withColumns({c: F.lit(None) for c in void}) if void else table


def _delete(path: str) -> None:
    spark = _open.pop(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def written() -> set[str]:
    """Folders of the tables that exist."""
    return set(_open)


def release(paths: set[str]) -> None:
    """Delete tables; frames that read them cannot be used any more."""
    for path in paths & set(_open):
        _delete(path)


@contextmanager
def scope():
    """Tables written inside are deleted at the end; write or collect every result before."""
    before = written()
    try:
        yield
    finally:
        release(written() - before)


@atexit.register
def _at_exit() -> None:
    for path in list(_open):
        try:
            if _open[path].sparkContext._jsc is not None:
                _delete(path)
        except Exception:  # noqa: BLE001 — the session ended first
            _open.pop(path, None)
