"""Deterministic dirty views of the driver tables, written twice: as Spark
DataFrames and as DuckDB SQL with the same arithmetic on keys."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prepwise.context import ROW_ID, Context


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from prepwise.sources.readers import spread
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def with_id(df: DataFrame, key: str) -> DataFrame:
    """Row identity from a key column (so results can be compared by key)."""
    return df.withColumn(ROW_ID, F.col(key).cast("long"))


def ctx_for(df: DataFrame, roles: dict | None = None, ids=(), order_by=None) -> Context:
    ctx = Context.from_schema(df, order_by)
    if roles:
        ctx = ctx.with_(roles={**ctx.roles, **roles})
    return ctx.with_(id_columns=frozenset(ids))


# ---- events with gaps ------------------------------------------------------
def events_gaps(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    lo, hi = e.agg(F.min("event_id"), F.max("event_id")).first()
    gap = (F.col("event_id") % 11 == 0) | (F.col("event_id") == F.lit(lo)) | (F.col("event_id") == F.lit(hi))
    return e.select("event_id", "ts", "user_id", "event_type", F.when(~gap, F.col("value")).alias("value"))


EVENTS_GAPS_SQL = """(SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_id % 11 = 0 OR event_id = (SELECT min(event_id) FROM events)
            OR event_id = (SELECT max(event_id) FROM events) THEN NULL ELSE value END AS value
  FROM events)"""


def events_spikes(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", (F.col("value") * F.when(F.col("event_id") % 997 == 0, 50).otherwise(1)).alias("value"))


EVENTS_SPIKES_SQL = """(SELECT event_id, value * CASE WHEN event_id % 997 = 0 THEN 50 ELSE 1 END AS value FROM events)"""


def events_multi_gaps(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select("event_id", "ts", "user_id",
                    F.when(~(k % 5 < 2), F.col("event_type")).alias("event_type"),
                    F.when(~(k % 11 == 0), F.col("value")).alias("value"),
                    F.when(~(k % 10).isin(0, 1, 2, 3, 4, 7), F.col("props")).alias("props"))


EVENTS_MULTI_GAPS_SQL = """(SELECT event_id, ts, user_id,
  CASE WHEN event_id % 5 < 2 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 10 IN (0, 1, 2, 3, 4, 7) THEN NULL ELSE props END AS props
  FROM events)"""


# ---- orders ----------------------------------------------------------------
TOKENS = ["N/A", " null ", "", "-", "未知"]


def orders_tokens(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 13
    pr = F.col("o_orderpriority")
    for i, t in enumerate(TOKENS):
        pr = F.when(k == i, F.lit(t)).otherwise(pr)
    return o.select("o_orderkey", pr.alias("o_orderpriority"))


ORDERS_TOKENS_SQL = """(SELECT o_orderkey, CASE o_orderkey % 13 WHEN 0 THEN 'N/A' WHEN 1 THEN ' null '
  WHEN 2 THEN '' WHEN 3 THEN '-' WHEN 4 THEN '未知' ELSE o_orderpriority END AS o_orderpriority FROM orders)"""


def orders_text(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])


ORDERS_TEXT_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS_TEXT_SQL = "(SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ORDERS_TEXT_COLS) + " FROM orders)"


def orders_bad_numbers(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = (F.when(k % 50 == 0, F.lit("abc")).when(k == 1, F.lit("1d")).when(k == 3, F.lit("1e3"))
         .when(k == 7, F.lit(" 12 ")).otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", s.alias("o_totalprice"))


ORDERS_BAD_NUMBERS_SQL = """(SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'abc' WHEN o_orderkey = 1 THEN '1d'
  WHEN o_orderkey = 3 THEN '1e3' WHEN o_orderkey = 7 THEN ' 12 ' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice
  FROM orders)"""


def orders_bool_text(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    return o.select("o_orderkey", F.when(k == 0, "Yes").when(k == 1, " no").alias("o_flag"))


ORDERS_BOOL_SQL = """(SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN ' no' ELSE NULL END AS o_flag
  FROM orders)"""


def orders_date_text(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = F.when(k % 20 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", s.alias("o_orderdate"))


ORDERS_DATE_TEXT_SQL = """(SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN 'not a date'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate FROM orders)"""


def orders_dates5(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 5
    s = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/M/d"))
         .when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, F.date_format(d, "yyyy年M月d日"))
         .otherwise(F.date_format(d, "M/d/yyyy")))
    return o.select("o_orderkey", s.alias("o_orderdate"))


# ---- lineitem ----------------------------------------------------------------
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def lineitem_dupkeys(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.withColumn("l_linenumber", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_linenumber")))


LINEITEM_DUPKEYS_SQL = ("(SELECT " + ", ".join(
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber" if c == "l_linenumber" else c
    for c in LINEITEM_COLS) + " FROM lineitem)")


def lineitem_units(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") % 10
    q = F.col("l_quantity").cast("long").cast("string")
    q10 = (F.col("l_quantity").cast("long") + 10).cast("string")
    s = (F.when(k < 5, F.concat(q, F.lit("kg"))).when(k == 5, F.concat(q, F.lit(" kg")))
         .when(k == 6, F.lit("1,234.5kg")).when(k == 7, F.concat(q, F.lit("-"), q10, F.lit("kg")))
         .when(k == 8, q).otherwise(F.lit("n/a")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", s.alias("l_quantity"))


LINEITEM_UNITS_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE
  WHEN l_orderkey % 10 < 5 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'kg'
  WHEN l_orderkey % 10 = 5 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' kg'
  WHEN l_orderkey % 10 = 6 THEN '1,234.5kg'
  WHEN l_orderkey % 10 = 7 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(l_quantity AS BIGINT) + 10 AS VARCHAR) || 'kg'
  WHEN l_orderkey % 10 = 8 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
  ELSE 'n/a' END AS l_quantity FROM lineitem)"""


def lineitem_percent(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") % 10
    pct = F.round(F.col("l_discount") * 100).cast("long").cast("string")
    pml = F.round(F.col("l_discount") * 1000).cast("long").cast("string")
    s = (F.when(F.col("l_orderkey") == 1, F.lit("abc")).when(k < 7, F.concat(pct, F.lit("%")))
         .otherwise(F.concat(pml, F.lit("‰"))))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", s.alias("l_discount"))


LINEITEM_PERCENT_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, CASE
  WHEN l_orderkey = 1 THEN 'abc'
  WHEN l_orderkey % 10 < 7 THEN CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) || '%'
  ELSE CAST(CAST(round(l_discount * 1000) AS BIGINT) AS VARCHAR) || '‰' END AS l_discount FROM lineitem)"""


def lineitem_collinear(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_quantity", (F.col("l_quantity") * 2 + F.col("l_tax") * 100).alias("l_q2"), "l_discount")


# ---- documents ---------------------------------------------------------------
INJECT = [
    ("  ", "", " "), ("ＡＢＣ１２３　", "", ""), ("“q” ", "", ""), ("", " — x…", ""),
    ("", " end", ""), ("", " m²", ""), ("", " https://x.y/z", ""), ("a@b.cd ", "", ""), ("", "", ""),
]


def documents_dirty(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 9
    t = F.col("text")
    out = t
    for i, (pre, post, tail) in enumerate(INJECT):
        if i == 4:
            v = F.concat(t, F.lit("\u00a0"), F.lit("end"))
        else:
            v = F.concat(F.lit(pre), t, F.lit(post), F.lit(tail))
        out = F.when(k == i, v).otherwise(out)
    return d.select("doc_id", out.alias("text"))


DOCUMENTS_DIRTY_SQL = """(SELECT doc_id, CASE doc_id % 9
  WHEN 0 THEN '  ' || text || ' '
  WHEN 1 THEN 'ＡＢＣ１２３　' || text
  WHEN 2 THEN '“q” ' || text
  WHEN 3 THEN text || ' — x…'
  WHEN 4 THEN text || chr(160) || 'end'
  WHEN 5 THEN text || ' m²'
  WHEN 6 THEN text || ' https://x.y/z'
  WHEN 7 THEN 'a@b.cd ' || text
  ELSE text END AS text FROM documents)"""


def supplier_constants(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select("*", F.lit(1).alias("k"), F.lit(None).cast("string").alias("z"),
                    F.when(F.col("s_suppkey") == 1, F.lit(1)).alias("rare"))


SUPPLIER_CONSTANTS_SQL = """(SELECT *, 1 AS k, CAST(NULL AS VARCHAR) AS z,
  CASE WHEN s_suppkey = 1 THEN 1 END AS rare FROM supplier)"""


def customer_uuid(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    u = F.lower(F.concat(F.format_string("%08x", F.col("c_custkey")), F.lit("-0000-4000-8000-"),
                         F.format_string("%012x", F.col("c_custkey") * 7919)))
    few = F.lower(F.concat(F.format_string("%08x", F.col("c_custkey") % 10), F.lit("-0000-4000-8000-000000000000")))
    return (c.withColumn("c_ref", u).withColumn("c_tag", few)                       # UUIDs, but not unique
            .withColumn("c_step", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") * 3)))    # a sequence in half of the rows


CUSTOMER_UUID_SQL = """(SELECT *, lower(printf('%08x', c_custkey) || '-0000-4000-8000-' || printf('%012x', c_custkey * 7919))
  AS c_ref, lower(printf('%08x', c_custkey % 10) || '-0000-4000-8000-000000000000') AS c_tag,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 3 END AS c_step FROM customer)"""


SPELLINGS = [
    "yyyy-MM-dd'T10:00:00Z'", "yyyy-MM-dd'T10:00:00.123'", "yyyy-MM-dd' 10:00:00+08:00'", "yyyy-MM-dd' 10:00 AM'", "M/d/yy",
    "MMM d", "d-MMM-yyyy", "yyyy.MM.dd' 10:00:00'", "yyyy-MM-dd'T10:00'", "EEE MMM d' 10:00:00 'yyyy",
    "MMMM yyyy", "yyyy-MM-dd' 10:00:00.1'", "yyyy年M月", "M月d日", "yyyyMMddHHmmss",
    "'not a day'", "MMMM d, yyyy", "yyyy/M/d", "d MMM yyyy", "yyyyMMdd",
]


def orders_spellings(spark, sf_dir) -> DataFrame:
    """Order dates in twenty spellings, in a column whose name says nothing."""
    o = table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % len(SPELLINGS)
    s = F.lit(None).cast("string")
    for i, f in enumerate(SPELLINGS):
        s = F.when(k == i, F.date_format(d, f)).otherwise(s)
    return o.select("o_orderkey", s.alias("memo"))


def orders_roles(spark, sf_dir) -> DataFrame:
    """Columns for the rarer branches of role detection."""
    o = table(spark, sf_dir, "orders")
    digits = F.date_format("o_orderdate", "yyyyMMdd")
    return o.select("o_orderkey", F.lit(None).cast("string").alias("blank"), digits.alias("ship_date"), digits.alias("digits"),
                    F.concat(F.lit("note "), F.col("o_orderkey").cast("string")).alias("remark"))
