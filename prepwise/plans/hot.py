"""Look-up joins on keys of which a few may hold a large share of the rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prepwise.context import ROW_ID

PARTS = 8          # a key counts as hot from an eighth of an even partition on


def _spread(df: DataFrame) -> Column:
    """A number that differs between rows (between different rows, where there is no row id)."""
    names = [ROW_ID] if ROW_ID in df.columns else [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.xxhash64(*[F.col(f"`{c}`") for c in names])


def lookup(df: DataFrame, table: DataFrame, keys: list[str], values: list[str], rows: str, spread: Column | None = None,
           total: int | None = None) -> DataFrame:
    """``df`` with the ``values`` of ``table`` for its ``keys`` (null where there is none).

    ``table`` has one row per key (fixed-size columns) and counts in ``rows`` how many rows of ``df``
    hold it (``total`` together).  Keys above a fixed part of an even partition are fewer than ``PARTS`` per partition,
    whatever the data, and are broadcast; their rows take no part in the shuffle join that finds the
    others, where they are dealt out evenly.  So no task gets more of a key than that part."""
    parts = PARTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if total is None:
        total = table.agg(F.sum(rows)).first()[0] or 0
    limit = max(1, total // parts)
    named = lambda tag: [F.col(f"`{v}`").alias(f"__{tag}{i}") for i, v in enumerate(values)]     # noqa: E731
    zero = F.least(F.col(rows), F.lit(0)).cast("long").alias("__none")                  # not a constant to the optimizer, so a key of the join
    right = lambda tag, t: t.select(zero, *[F.col(f"`{k}`").alias(f"__{tag}k{i}") for i, k in enumerate(keys)], *named(tag))     # noqa: E731
    on = lambda tag: [F.col(f"`{k}`") == F.col(f"__{tag}k{i}") for i, k in enumerate(keys)]     # noqa: E731
    hot = right("h", table.where(F.col(rows) > limit)).withColumn("__hot", F.lit(True)).drop("__none")
    cold = right("c", table.where(F.col(rows) <= limit))
    dealt = spread if spread is not None else _spread(df)
    left = df.join(F.broadcast(hot), on("h"), "left").withColumn("__deal", F.when(F.col("__hot"), dealt.bitwiseOR(1)).otherwise(F.lit(0).cast("long")))
    out = left.join(cold, [*on("c"), F.col("__deal") == F.col("__none")], "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.coalesce(f"__h{i}", f"__c{i}").alias(v) for i, v in enumerate(values)])
