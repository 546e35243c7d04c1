"""Registered queries of readers, whole runs and rarer switches, with their DuckDB twins."""
from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from prepwise.context import Role
from prepwise.operators.dates import DatetimeStandardizer
from prepwise.operators.numeric_text import UnitDetector
from prepwise.operators.text_steps import ColumnNameCleaner, EncodingNormalizer, TextStandardizer
from prepwise.plans import changelog, views as V
from prepwise.plans.catalog import MESSY, ORDERS_SQL, TS_FMT, lit, r6, register
from prepwise.plans.chain import REGISTRY, CleaningPipeline, clean
from prepwise.plans.views import ctx_for, table
from prepwise.session import ensure_checkpoint_dir
from prepwise.sources.readers import read
from prepwise.sources.writers import save


def _path(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepwise-io-{uuid.uuid4().hex}/{name}"


# ============================================================ readers
LATIN_SQL = "'x' || regexp_replace(coalesce(text, ''), '[^\\x20-\\x7E\\xA1-\\xFF]', ' ', 'g') || 'x'"


@register("io_charset", f"SELECT doc_id, {LATIN_SQL} AS text FROM documents")
def q_io_charset(spark, d):
    """Texts written in a one-byte charset and read back by Python's name of it."""
    docs = table(spark, d, "documents").select("doc_id", F.concat(
        F.lit("x"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^\\x20-\\x7E\\xA1-\\xFF]", " "), F.lit("x")).alias("text"))
    path = _path(spark, "latin.csv")
    docs.write.option("header", True).option("escape", '"').csv(path, encoding="ISO-8859-1")
    return read(spark, path, encoding="latin-1").select(F.col("doc_id").cast("long").alias("doc_id"), "text")


@register("io_tokens", """SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN '-' WHEN 3 THEN NULL
    WHEN 4 THEN NULL WHEN 5 THEN 'na' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def q_io_tokens(spark, d):
    """Missing tokens of the usual CSV reader become null; a dash and other spellings stay."""
    k = F.col("o_orderkey") % 8
    cell = F.when(k == 0, "NA").when(k == 1, "n/a").when(k == 2, "-").when(k == 3, "#N/A").when(k == 4, "NULL").when(k == 5, "na").otherwise(F.col("o_orderpriority"))
    path = _path(spark, "tokens.csv")
    table(spark, d, "orders").select("o_orderkey", cell.alias("o_orderpriority")).write.option("header", True).csv(path)
    return read(spark, path).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority")


# ============================================================ names
@register("name_case", """SELECT o_orderkey AS O_KEY, o_custkey AS "col_1ST_CUST", o_orderstatus AS "col_2", o_totalprice AS A_B,
    strftime(o_orderdate, '%Y-%m-%d') AS "A_B_1", o_orderpriority AS FINE FROM orders""")
def q_name_case(spark, d):
    o = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).toDF(*MESSY)
    return ColumnNameCleaner(case="upper").fit_transform(o, ctx_for(o))[0]


@register("name_roles", """SELECT * FROM (VALUES ('o_key', 'numeric', true), ('col_1st_cust', 'categorical', false), ('col_2', 'boolean', false),
    ('a_b', 'numeric', false), ('A_B_1', 'datetime', false), ('fine', 'text', true)) AS v(column_name, role, is_id), (SELECT count(*) AS rows FROM orders)""")
def q_name_roles(spark, d):
    """Roles, IDs and the order follow their columns through a renaming; one row per new column, with the table's rows."""
    o = table(spark, d, "orders").toDF(*MESSY)
    roles = dict(zip(MESSY, [Role.NUMERIC, Role.CATEGORICAL, Role.BOOLEAN, Role.NUMERIC, Role.DATETIME, Role.TEXT]))
    out, ctx = ColumnNameCleaner().fit_transform(o, ctx_for(o, roles, ids=[MESSY[0], MESSY[5]], order_by=[MESSY[3]]))
    assert ctx.order_by[0] == "a_b"
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(ctx.roles[c].value).alias("role"), F.lit(c in ctx.id_columns).alias("is_id")) for c in out.columns])
    return out.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(cells).alias("t"), "rows").select("t.*", "rows")


# ============================================================ dates and units
@register("date_by_role", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS memo FROM orders")
def q_date_by_role(spark, d):
    """A datetime column that neither its name nor most of its cells tell."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise("none").alias("memo"))
    return DatetimeStandardizer(detect_by_content=False).fit_transform(o, ctx_for(o, {"memo": Role.DATETIME}))[0]


@register("unit_skip", """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 20 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'kg'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS l_quantity FROM lineitem""")
def q_unit_skip(spark, d):
    """Texts that are numbers for more than nine tenths keep their few units."""
    q = F.col("l_quantity").cast("long").cast("string")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 20 == 0, F.concat(q, F.lit("kg"))).otherwise(q).alias("l_quantity"))
    return UnitDetector(match_ratio=0.01).fit_transform(li, ctx_for(li))[0]


@register("unit_categories", """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS "size(cm)",
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'kg' AS weight FROM lineitem""")
def q_unit_categories(spark, d):
    """Only lengths are looked for: weights stay as they are."""
    q = F.col("l_quantity").cast("long").cast("string")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(q, F.lit("cm")).alias("size"), F.concat(q, F.lit("kg")).alias("weight"))
    return UnitDetector(unit_categories=["长度"]).fit_transform(li, ctx_for(li))[0]


# ============================================================ text by Unicode rules
# letters of the test texts -> compatibility forms that NFKC maps back
FANCY = {"fi": "ﬁ", "A": "Ａ", "2": "②", "m": "ｍ", "TM": "™", "1/2": "½"}
LETTERS_SQL = "regexp_replace(coalesce(text, ''), '[^A-Za-zéèêàçñüöäßáíóúÉÈÀÇÑÜÖÄ0-9 .,]', '', 'g')"
LETTERS_RE = "[^A-Za-zéèêàçñüöäßáíóúÉÈÀÇÑÜÖÄ0-9 .,]"


def _letters(spark, d):
    return table(spark, d, "documents").select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), LETTERS_RE, "").alias("text"))


def _text(docs):
    return ctx_for(docs, {"text": Role.TEXT})


@register("text_nfkc_cells", f"SELECT doc_id, regexp_replace(trim({LETTERS_SQL}), ' +', ' ', 'g') AS text FROM documents")
def q_text_nfkc_cells(spark, d):
    docs = _letters(spark, d)
    fancy = F.col("text")
    for plain, form in FANCY.items():
        if plain != "1/2" and plain != "TM":
            fancy = F.replace(fancy, F.lit(plain), F.lit(form))
    docs = docs.withColumn("text", fancy)
    return EncodingNormalizer().fit_transform(docs, _text(docs))[0]


@register("text_accents_cells", f"""SELECT doc_id, translate(trim(regexp_replace({LETTERS_SQL}, ' +', ' ', 'g')),
    'éèêàçñüöäáíóúÉÈÀÇÑÜÖÄ', 'eeeacnuoaaiouEEACNUOA') AS text FROM documents""")
def q_text_accents_cells(spark, d):
    docs = _letters(spark, d)
    return TextStandardizer(remove_accents=True, case="none", remove_urls=False, remove_emails=False).fit_transform(docs, _text(docs))[0]


@register("text_title_cells", f"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(
    trim(regexp_replace({LETTERS_SQL}, ' +', ' ', 'g')), '\\p{{L}}+|[^\\p{{L}}]+'),
    lambda w: CASE WHEN starts_with(w, 'ß') THEN 'Ss' ELSE upper(substr(w, 1, 1)) END || lower(substr(w, 2))), '') AS text FROM documents""")
def q_text_title_cells(spark, d):
    docs = _letters(spark, d)
    return TextStandardizer(remove_accents=False, case="title", remove_urls=False, remove_emails=False).fit_transform(docs, _text(docs))[0]


# ============================================================ whole runs
def _only(*names):
    return {c.name: c.name in names for c in REGISTRY}


@register("pipeline_config", "SELECT event_id, floor(value * 10) / 10 AS value FROM events WHERE value IS NOT NULL")
def q_pipeline_config(spark, d):
    """Two steps by switches and settings: rows with gaps go, places are cut to one."""
    e = table(spark, d, "events").select("event_id", "value")
    ctx = ctx_for(e, ids=["event_id"])
    pipe = CleaningPipeline(_only("missing_handler", "decimal_unifier"), {
        "missing_handler": {"strategy": "drop_rows"}, "decimal_unifier": {"mode": "fixed", "fixed_places": 1, "method": "floor"}})
    return pipe.run(e, ctx)[0].select("event_id", "value")


@register("load_and_run", "SELECT o_orderkey, round_even(o_totalprice * 10, 0) / 10 AS o_totalprice, o_orderpriority FROM orders")
def q_load_and_run(spark, d):
    """The one-call form on a written file: load, switches of the command line, run."""
    path = _path(spark, "orders.csv")
    save(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    skip = [c.name for c in REGISTRY if c.name not in ("type_detector", "decimal_unifier")]
    out = clean(spark, path, skip=skip, decimal_places=1).result
    return out.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), r6(F.col("o_totalprice")).alias("o_totalprice"), F.col("o_orderpriority").cast("string").alias("o_orderpriority"))


@register("run_switches", "SELECT 'key ' || o_orderkey AS key, o_totalprice > avg(o_totalprice) OVER () AS above FROM orders")
def q_run_switches(spark, d):
    """A step that is off by default is enabled, though it is also skipped: enable wins."""
    path = _path(spark, "orders.parquet")
    save(table(spark, d, "orders").select(F.concat(F.lit("key "), F.col("o_orderkey")).alias("key"), "o_totalprice"), path)
    skip = [c.name for c in REGISTRY if c.name != "type_detector"]
    out = clean(spark, path, skip=skip, enable=["feature_scaler"], scaler_method="standard").result
    return out.select("key", (F.col("o_totalprice") > 0).alias("above"))


@register("step_catalogue", "SELECT unnest(range(1, 21)) AS position, (SELECT count(*) FROM orders) AS rows")
def q_step_catalogue(spark, d):
    """Every step of the catalogue can be built from its listing and run alone on the orders, and keeps all rows."""
    from prepwise.plans.chain import BY_NAME, steps
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    out = None
    for at, s in enumerate(steps(), 1):
        config = {**(s["default_config"] or {}), **({"action": "flag"} if s["name"] == "outlier_detector" else {}), **({"action": "mark"} if s["name"] == "duplicate_handler" else {})}
        done = BY_NAME[s["name"]](**config).fit_transform(o, ctx_for(o, ids=["o_orderkey"]))[0]
        one = done.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(at).cast("long").alias("position"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("report", f"""SELECT 'rows' AS item, count(*) AS n FROM {V.EVENTS_GAPS_SQL} UNION ALL SELECT 'missing', count(*) - count(value) FROM {V.EVENTS_GAPS_SQL}
    UNION ALL SELECT 'columns', 2 UNION ALL SELECT 'filled cells', count(*) - count(value) FROM {V.EVENTS_GAPS_SQL} UNION ALL SELECT 'events', 1""")
def q_report(spark, d):
    """The machine-readable report of a run, written and read back."""
    from prepwise.operators.analysis import profile
    e = V.with_id(V.events_gaps(spark, d).select("event_id", "value"), "event_id")
    ctx = ctx_for(e, ids=["event_id"])
    fp = CleaningPipeline(_only("missing_handler"), {"missing_handler": {"strategy": "mean"}}, log_cells=True).fit(e, ctx)
    before = profile(e)
    path = _path(spark, "report")
    rep = changelog.report(before, fp.context.events, changelog.changes_per_step(fp.cell_log()), shape=[before.first()["count"], len(e.columns) - 1])
    changelog.write_report(spark, rep, path, fp.cell_log())
    found = json.loads(spark.read.text(path).first()[0])
    cells = spark.read.json(path + "-cells").count()
    rows = [("rows", found["shape"][0]), ("missing", found["total_missing"]), ("columns", len(found["columns"])), ("filled cells", cells), ("events", found["summary"]["events"])]
    return spark.createDataFrame(rows, "item string, n long")
