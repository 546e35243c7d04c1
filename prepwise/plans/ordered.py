"""Order-dependent operators without a single-task window.

``bucketize`` writes the table range-partitioned and sorted along a total order key (order
columns + the row id, so a hot value is split across buckets) to the shared folder, each row
with its partition number and its place inside the partition.  The boundaries are thus data:
nothing of them is in a plan or on the driver, whatever the number of buckets, and a task that
runs again reads the same bucket.  Positions need no window at all; fills run in a window
``partitionBy(bucket)``, to which what crosses bucket edges (the last value before, the first
after) comes as an extra row of the bucket.  Row offsets are a table of one long per bucket.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from prepwise.plans import shared

BUCKET, PLACE = "_bucket", "_bucket_place"
ROWS_PER_BUCKET = 5_000_000
_LOW = (1 << 33) - 1                          # monotonically_increasing_id: partition above, place below this mask


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def ranged(df: DataFrame, order: list[str], n_buckets: int) -> DataFrame:
    """The plan of ``bucketize``: rows sorted in ``n_buckets`` range partitions, with partition and place in one long."""
    keys = [_c(o).asc_nulls_first() for o in order]
    return df.repartitionByRange(n_buckets, *keys).sortWithinPartitions(*keys).withColumn(PLACE, F.monotonically_increasing_id())


def bucketize(df: DataFrame, order: list[str], n_buckets: int | None = None, total: int | None = None) -> DataFrame:
    """``df`` with its range bucket along ``order`` and its place (from 0) inside the bucket.

    The bucket count follows the row count; ``total`` saves counting the rows."""
    if n_buckets is None:
        total = df.count() if total is None else total
        n_buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_BUCKET))
    table = shared.save(ranged(df, order, n_buckets), "range")
    return table.withColumn(BUCKET, F.shiftright(PLACE, 33).cast("int")).withColumn(PLACE, F.col(PLACE).bitwiseAND(_LOW))


def offsets(b: DataFrame) -> DataFrame:
    """Rows before every bucket: one int and one long per bucket, so broadcast."""
    counts = b.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(counts.select(BUCKET, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")))


def _frame(forward: bool) -> Window:
    """From the start of the bucket to this row, or from its end: reversed order, since a frame that
    reaches to the end is aggregated anew for every row."""
    w = Window.partitionBy(BUCKET).orderBy(PLACE if forward else F.desc(PLACE))
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _carried(summary: DataFrame, values: dict[str, str], forward: bool) -> DataFrame:
    """An extra row per bucket, before its first (after its last) place, with the last known values of the
    buckets before (after) it."""
    w = Window.orderBy(BUCKET if forward else F.desc(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(BUCKET, F.lit(-1 if forward else _LOW + 1).cast("long").alias(PLACE), *[
        F.last(v, ignorenulls=True).over(w).alias(name) for name, v in values.items()])


def fill(df: DataFrame, cols: list[str], order: list[str], direction: str = "forward",
         n_buckets: int | None = None) -> DataFrame:
    """Forward (or backward) fill of several columns along ``order``."""
    b = bucketize(df, order, n_buckets)
    forward = direction == "forward"
    pick = F.max_by if forward else F.min_by
    summary = b.groupBy(BUCKET).agg(*[pick(_c(c), F.when(_c(c).isNotNull(), F.col(PLACE))).alias(f"_e{i}") for i, c in enumerate(cols)])
    rows = b.unionByName(_carried(summary, {c: f"_e{i}" for i, c in enumerate(cols)}, forward), allowMissingColumns=True)
    rows = rows.withColumns({c: F.last(_c(c), ignorenulls=True).over(_frame(forward)) for c in cols})
    return rows.where(F.col(PLACE).between(0, _LOW)).select(*[_c(c) for c in df.columns])


def with_row_number(df: DataFrame, order: list[str], name: str = "_rn", n_buckets: int | None = None,
                    total: int | None = None) -> DataFrame:
    """Global 1-based row number along ``order``: offset of the bucket + place inside it."""
    b = bucketize(df, order, n_buckets, total)
    out = b.join(offsets(b), BUCKET).withColumn(name, F.col("_off") + F.col(PLACE) + 1)
    return out.select(*[_c(c) for c in df.columns], name)


def interpolate(df: DataFrame, cols: list[str], order: list[str], n_buckets: int | None = None) -> DataFrame:
    """Linear interpolation by row position; leading nulls stay, trailing
    nulls take the last value."""
    b = bucketize(df, order, n_buckets)
    b = b.join(offsets(b), BUCKET).withColumn("_pos", F.col("_off") + F.col(PLACE)).drop("_off")
    b = b.withColumns({f"_o{i}": F.when(_c(c).isNotNull(), F.struct(F.col("_pos").alias("p"), _c(c).cast("double").alias("v")))
                       for i, c in enumerate(cols)})
    seen = {i: F.when(F.col(f"_o{i}").isNotNull(), F.col(PLACE)) for i in range(len(cols))}
    summary = b.groupBy(BUCKET).agg(*[f(f"_o{i}", seen[i]).alias(f"{n}{i}") for i in seen for n, f in (("_l", F.max_by), ("_f", F.min_by))])
    rows = b
    for forward, n in ((True, "_l"), (False, "_f")):
        rows = rows.unionByName(_carried(summary, {f"_o{i}": f"{n}{i}" for i in seen}, forward), allowMissingColumns=True)
    for forward, n in ((True, "_l"), (False, "_f")):
        rows = rows.withColumns({f"{n}{i}": F.last(f"_o{i}", ignorenulls=True).over(_frame(forward)) for i in seen})
    out = rows.where(F.col(PLACE).between(0, _LOW))
    new = {}
    for i, c in enumerate(cols):
        p, n = F.col(f"_l{i}"), F.col(f"_f{i}")
        line = p["v"] + (n["v"] - p["v"]) * (F.col("_pos") - p["p"]) / (n["p"] - p["p"])
        new[c] = (F.when(_c(c).isNotNull(), _c(c).cast("double")).when(p.isNull(), F.lit(None))
                  .when(n.isNull(), p["v"]).otherwise(line))
    return out.withColumns(new).select(*[_c(c) for c in df.columns])
