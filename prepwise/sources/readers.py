"""Readers (S1–S8): extension dispatch, NaN → NULL, row identity, metadata."""
from __future__ import annotations

import codecs
import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from prepwise.context import ROW_ID, Context

# FIXED VALUES: tokens the usual CSV reader treats as missing ("-" is kept)
READER_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


# Python's name of a charset -> the reader's
_CHARSETS = {"iso8859-1": "ISO-8859-1", "ascii": "US-ASCII", "utf-8": "UTF-8", "utf-16": "UTF-16", "utf-16-le": "UTF-16LE",
             "utf-16-be": "UTF-16BE", "utf-32": "UTF-32"}


def charset(encoding: str) -> str:
    """The reader's name of an encoding given in Python's or the reader's spelling."""
    try:
        return _CHARSETS.get(codecs.lookup(encoding).name, encoding)
    except LookupError:
        return encoding


def _csv(spark, path, sep, encoding, infer, multi_line):
    r = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
         .option("sep", sep).option("inferSchema", infer).option("mode", "PERMISSIVE"))
    if encoding:
        r = r.option("encoding", charset(encoding))
    return r.csv(path)


def read(spark: SparkSession, path: str, fmt: str | None = None, encoding: str | None = None,
         infer_schema: bool = False, multi_line: bool = False, json_layout: str = "auto") -> DataFrame:
    """Read by extension.  ``multi_line`` lets quoted CSV cells hold line breaks, at the price of one task
    per file.  ``json_layout``: ``lines``, ``document`` (one array or object per file) or ``auto``, which looks
    at every file (see ``json_layouts``) and may mix both."""
    ext = (fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".")).lower()
    try:
        if ext == "parquet":
            return spark.read.parquet(path)                                             # S4
        if ext == "json":
            return _json(spark, path, encoding, json_layout)                             # S3
        if ext == "tsv":
            df = _csv(spark, path, "\t", encoding, infer_schema, multi_line)                         # S2
        else:
            df = _csv(spark, path, ",", encoding, infer_schema, multi_line)                          # S1 / S5
    except Exception as e:  # noqa: BLE001 — surface as a plain format error
        raise ValueError(f"cannot read {path!r} as {ext or 'csv'}: {e}") from e
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(READER_NA_TOKENS), F.col(f"`{c}`"))
                           for c in strings})                                            # S7


JSON_LAYOUTS = ("auto", "lines", "document", "array")        # "array" is the older name of "document"


def json_layouts(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """``(file, layout)``: ``lines`` if the first line that is not blank is a whole value and no array, else
    ``document``.  One text scan; a row per file leaves each task."""
    text = spark.read.option("encoding", charset(encoding or "UTF-8")).text(path)
    line = F.trim(F.regexp_replace("value", "^\\x{feff}", ""))
    line = F.regexp_replace(line, "^\\s+", "")
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), line.alias("line")).where("line <> ''")
    first = rows.groupBy("file").agg(F.min_by("line", F.struct("block", "at")).alias("line"))
    whole = F.get_json_object("line", "$").isNotNull() & ~F.col("line").startswith("[")
    return first.select("file", F.when(whole, "lines").otherwise("document").alias("layout"))


def _json(spark, path, encoding, layout) -> DataFrame:
    """Records of JSON files; files of both layouts are read each their way, with one schema for all."""
    if layout not in JSON_LAYOUTS:
        raise ValueError(f"unknown JSON layout {layout!r}")

    def reader(lines: bool, schema=None):
        r = spark.read.option("multiLine", not lines)
        r = r.option("encoding", charset(encoding)) if encoding else r
        return r.schema(schema) if schema else r

    if layout != "auto":
        return reader(layout == "lines").json(path)
    found = json_layouts(spark, path, encoding)
    counts = {r["layout"]: r["n"] for r in found.groupBy("layout").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return reader("document" not in counts).json(path)
    # paths only: Spark's own listing holds as many on the driver
    files = {kind: [r["file"] for r in found.where(F.col("layout") == kind).select("file").collect()] for kind in counts}
    schemas = {kind: reader(kind == "lines").json(files[kind]).schema for kind in counts}
    schema = _merged(*schemas.values())
    return reader(True, schema).json(files["lines"]).unionByName(reader(False, schema).json(files["document"]))


def _merged(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both: fields of either, wider numbers, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            fields[f.name] = _merged(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return T.StructType([T.StructField(n, fields[n]) for n in sorted(fields)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_merged(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy row work every core when a scan yields fewer splits than
    the cluster has task slots (small or single-row-group files).  Large
    inputs already have more splits than slots and are returned untouched, so
    this never adds a shuffle at scale."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def prepare(df: DataFrame, order_by: list[str] | None = None) -> tuple[DataFrame, Context]:
    """NaN → NULL on float columns, and a row id right after the scan.

    The row id is ``monotonically_increasing_id`` (file order: partition index in
    the high bits), stable for a given set of files and split size."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if floats:
        df = df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
    if ROW_ID not in df.columns:
        df = df.withColumn(ROW_ID, F.monotonically_increasing_id())   # file order, before spreading
    return spread(df), Context.from_schema(df, order_by)


def load(spark: SparkSession, path: str, fmt: str | None = None, encoding: str | None = None,
         order_by: list[str] | None = None, infer_schema: bool = False, **options) -> tuple[DataFrame, Context, dict]:
    df = read(spark, path, fmt, encoding, infer_schema, **options)
    meta = metadata(df, path, encoding)
    df, ctx = prepare(df, order_by)
    return df, ctx, meta


def metadata(df: DataFrame, path: str, encoding: str | None = None) -> dict:
    """Path, name, size (sum over files), extension, encoding, rows, cols."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path") \
        .agg(F.max("file_size").alias("s"), F.count(F.lit(1)).alias("rows"))
    r = files.agg(F.sum("s").alias("size"), F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")).first()
    return {"file_path": path, "file_name": os.path.basename(path.rstrip("/")), "file_size": r["size"],
            "files": r["files"], "extension": os.path.splitext(path.rstrip("/"))[1].lower(),
            "encoding": encoding or "utf-8", "rows": r["rows"] or 0, "cols": len(df.columns),
            "columns": list(df.columns)}
