"""Helpers shared by the operators: scratch tables, shared files, connected components."""
from __future__ import annotations

import gc
import os
import uuid
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepwise.session import ensure_checkpoint_dir

#: Deleted / separating characters of the contracts: space and U+0009 to U+000D.
SPACE_CLASS = r"\x20\x09-\x0D"


def free_name(columns, base: str) -> str:
    """``base``, or ``base`` with underscores appended until no column has it (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def residue(column: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def give_back() -> None:
    """Return to the system what earlier stages left unused in this (reused) Python worker."""
    import ctypes

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)            # glibc only
    if trim:
        trim(0)


class Scratch:
    """Tables and files of one operator run in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage, survives lost executors and keeps column pruning."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepwise-{what}-{uuid.uuid4().hex}"
        self.tables = 0

    def save(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and return the reader of the written table."""
        self.tables += 1
        path = f"{self.root}/table-{self.tables:04d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame | None) -> None:
        """Delete a table of ``save`` that no later plan reads."""
        for path in {os.path.dirname(f) for f in df.inputFiles()} if df is not None else ():
            self.drop_folder(path)

    def drop_folder(self, path: str) -> None:
        """Delete a folder of this run that no later task reads."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def release(self) -> None:
        """Let Spark delete shuffle files that no plan refers to any more: its cleaner follows the driver's garbage collector."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def folder(self, name: str) -> str:
        """A folder for files that tasks write themselves (see ``put_array`` and ``get_array``)."""
        return f"{self.root}/{name}"


def _local(path: str) -> str | None:
    u = urlparse(path)
    return u.path if u.scheme in ("", "file") else None


def put_array(path: str, array: np.ndarray) -> None:
    """Write an array into the shared folder; a re-run task replaces it with the same bytes at once."""
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            np.save(out, array, allow_pickle=False)
        os.replace(part, local)
        return
    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path)
    store.create_dir(os.path.dirname(inner), recursive=True)
    part = f"{inner}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        np.save(out, array, allow_pickle=False)
    store.move(part, inner)


def get_array(path: str) -> np.ndarray:
    """An array of ``put_array``: memory-mapped from a mounted folder, else read through the store."""
    local = _local(path)
    if local is not None:
        return np.load(local, mmap_mode="r", allow_pickle=False)
    import io

    from pyarrow import fs
    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_stream(inner) as src:
        return np.load(io.BytesIO(src.read()), allow_pickle=False)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list.

    ``edges`` has long columns ``a`` and ``b``; loops and repeats are allowed.  Returns
    ``(node, component)`` for every node with at least one edge to another node, the
    component being the smallest node reachable.  Alternates large-star and small-star
    steps (each a min-aggregate and a join on the node); every step is written to the
    shared folder, only a row count and a checksum come to the driver."""
    links = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _checksum(links)
    while state[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.save(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = _checksum(after)
        scratch.drop(links)
        links, state, before = after, now, state
        if now == before:
            break
    # at the fixed point every component is a star around its smallest node
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _checksum(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(r)
