"""Registered queries: each runs a library step over the given tables (or a
dirty view Spark derives from them) and has, where SQL can express it, a
DuckDB twin with the same arithmetic.  Computed doubles are rounded to six
places on both sides (sums in a different order differ in the last bits)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prepwise.context import ROW_ID, Role
from prepwise.functions import numbers as nb
from prepwise.functions import text as tx
from prepwise.functions import vocab
from prepwise.operators.analysis import CorrelationAnalyzer, pearson_pairs, profile, spearman_pairs, table_summary, vif
from prepwise.operators.dates import DatetimeStandardizer
from prepwise.operators.detect import IdColumnDetector, TypeDetector
from prepwise.operators.features import Binning, CategoricalEncoder, FeatureScaler, SkewnessCorrector
from prepwise.operators.missing import MissingHandler
from prepwise.operators.numeric_text import DecimalUnifier, PercentageUnifier, UnitDetector
from prepwise.operators.outliers import OutlierDetector
from prepwise.operators.text_steps import EncodingNormalizer, TextStandardizer
from prepwise.operators.values import ConstantRemover, DuplicateHandler, ValueReplacer
from prepwise.plans import changelog, views as V
from prepwise.plans.views import ctx_for, table

QUERIES: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def r6(c):
    return F.round(c, 6)


TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_SQL = "'%Y-%m-%d %H:%M:%S'"
TRIM_SQL = "regexp_replace({x}, " + lit("^" + tx.WS + "+|" + tx.WS + "+$") + ", '', 'g')"


def fx(template: str, x: str) -> str:
    return template.replace("{x}", x)


def trim_sql(x):
    return fx(TRIM_SQL, x)


def nodrop(df):
    return df.drop(ROW_ID) if ROW_ID in df.columns else df


# ============================================================ outliers
def _events_value(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return e, ctx_for(e, {"event_id": Role.NUMERIC, "value": Role.NUMERIC}, ids=["event_id"])


IQR_SQL = """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {src}),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
t AS (SELECT event_id, value, coalesce(value < lo OR value > hi, false) AS flag, lo, hi FROM {src}, f)"""


@register("outlier_iqr_flag", IQR_SQL.format(src="events") +
          " SELECT event_id, value, flag AS value_outlier FROM t")
def q_outlier_iqr_flag(spark, d):
    e, ctx = _events_value(spark, d)
    return OutlierDetector(method="iqr", action="flag").fit_transform(e, ctx)[0]


@register("outlier_iqr_cap", IQR_SQL.format(src="events") +
          " SELECT event_id, round(CASE WHEN flag THEN least(greatest(value, lo), hi) ELSE value END, 6) AS value FROM t")
def q_outlier_iqr_cap(spark, d):
    e, ctx = _events_value(spark, d)
    out = OutlierDetector(method="iqr", action="cap").fit_transform(e, ctx)[0]
    return out.select("event_id", r6(F.col("value")).alias("value"))


@register("outlier_iqr_remove", IQR_SQL.format(src="events") + " SELECT event_id, value FROM t WHERE NOT flag")
def q_outlier_iqr_remove(spark, d):
    e, ctx = _events_value(spark, d)
    return OutlierDetector(method="iqr", action="remove").fit_transform(e, ctx)[0]


Z_SQL = """WITH m AS (SELECT avg(value) AS mu, stddev_pop(value) AS sp, stddev_samp(value) AS ss FROM {src}),
t AS (SELECT event_id, value, coalesce(abs((value - mu) / sp) > 3.0, false) AS flag, mu, ss FROM {src}, m)""".format(
    src=V.EVENTS_SPIKES_SQL)


def _spikes(spark, d):
    e = V.events_spikes(spark, d)
    return e, ctx_for(e, {"event_id": Role.NUMERIC, "value": Role.NUMERIC}, ids=["event_id"])


@register("outlier_zscore_flag", Z_SQL + " SELECT event_id, round(value, 6) AS value, flag AS value_outlier FROM t")
def q_outlier_zscore_flag(spark, d):
    e, ctx = _spikes(spark, d)
    out = OutlierDetector(method="zscore", action="flag").fit_transform(e, ctx)[0]
    return out.select("event_id", r6(F.col("value")).alias("value"), "value_outlier")


@register("outlier_zscore_cap", Z_SQL + """ SELECT event_id, round(CASE WHEN flag THEN
    least(greatest(value, mu - 3.0 * ss), mu + 3.0 * ss) ELSE value END, 6) AS value FROM t""")
def q_outlier_zscore_cap(spark, d):
    e, ctx = _spikes(spark, d)
    out = OutlierDetector(method="zscore", action="cap").fit_transform(e, ctx)[0]
    return out.select("event_id", r6(F.col("value")).alias("value"))


@register("outlier_forest_flag")
def q_outlier_forest_flag(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                             "l_discount", "l_tax")
    ctx = ctx_for(li, ids=["l_orderkey", "l_linenumber"], order_by=li.columns)
    out = OutlierDetector(method="isolation_forest", action="flag").fit_transform(li, ctx)[0]
    return out.select("l_orderkey", "l_linenumber", "_if_outlier")


@register("outlier_forest_summary", """SELECT count(*) AS rows, 0.05 AS flagged_share, true AS flags_are_extreme FROM lineitem""")
def q_outlier_forest_summary(spark, d):
    """The share of flagged rows, and whether their cells lie further from the middle than those of the others."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ctx = ctx_for(li, ids=["l_orderkey", "l_linenumber"], order_by=li.columns)
    out = OutlierDetector(method="isolation_forest", action="flag").fit_transform(li, ctx)[0]
    mid = out.agg(*[F.avg(c).alias(c) for c in li.columns[2:]], *[F.stddev(c).alias(f"{c}_sd") for c in li.columns[2:]]).first()
    far = sum(F.abs((F.col(c) - mid[c]) / mid[f"{c}_sd"]) for c in li.columns[2:])
    return out.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("_if_outlier").cast("int")), 2).alias("flagged_share"),
                   (F.avg(F.when(F.col("_if_outlier"), far)) > F.avg(F.when(~F.col("_if_outlier"), far))).alias("flags_are_extreme"))


# ============================================================ duplicates
DUP_KEYS = ["l_orderkey", "l_linenumber"]
LI_OUT_SPARK = [c for c in V.LINEITEM_COLS if c != "l_shipdate"]
LI_SEL_SQL = ", ".join(V.LINEITEM_COLS[:-1]) + f", strftime(l_shipdate, {TS_SQL}) AS l_shipdate"
ORDER_ALL = ", ".join(V.LINEITEM_COLS)


def _dup(spark, d, action):
    li = V.lineitem_dupkeys(spark, d)
    li = li.withColumn(ROW_ID, F.monotonically_increasing_id())
    ctx = ctx_for(li, order_by=V.LINEITEM_COLS)
    out = DuplicateHandler(action=action, subset=DUP_KEYS).fit_transform(li, ctx)[0]
    extra = ["_is_duplicate"] if action == "mark" else []
    return out.select(*LI_OUT_SPARK, F.date_format("l_shipdate", TS_FMT).alias("l_shipdate"), *extra)


@register("dup_mark", f"""SELECT {LI_SEL_SQL}, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS _is_duplicate
    FROM {V.LINEITEM_DUPKEYS_SQL}""")
def q_dup_mark(spark, d):
    return _dup(spark, d, "mark")


@register("dup_remove_all", f"""SELECT {LI_SEL_SQL} FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n
    FROM {V.LINEITEM_DUPKEYS_SQL}) WHERE n = 1""")
def q_dup_remove_all(spark, d):
    return _dup(spark, d, "remove")


@register("dup_keep_first", f"""SELECT {LI_SEL_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {ORDER_ALL}) AS rn FROM {V.LINEITEM_DUPKEYS_SQL}) WHERE rn = 1""")
def q_dup_keep_first(spark, d):
    return _dup(spark, d, "keep_first")


@register("dup_keep_last", f"""SELECT {LI_SEL_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {", ".join(c + " DESC" for c in V.LINEITEM_COLS)}) AS rn FROM {V.LINEITEM_DUPKEYS_SQL}) WHERE rn = 1""")
def q_dup_keep_last(spark, d):
    return _dup(spark, d, "keep_last")


# ============================================================ value replacement (V1–V3)
TOKENS_SQL = ", ".join(lit(t) for t in vocab.NA_TOKENS)


@register("na_tokens", f"""SELECT o_orderkey, CASE WHEN {trim_sql('o_orderpriority')} IN ({TOKENS_SQL})
    THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM {V.ORDERS_TOKENS_SQL}""")
def q_na_tokens(spark, d):
    o = V.orders_tokens(spark, d)
    return ValueReplacer().fit_transform(o, ctx_for(o))[0]


@register("replace_exact", f"""SELECT o_orderkey, CASE WHEN {trim_sql('o_orderpriority')} = '1-URGENT' THEN 'URGENT'
    ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def q_replace_exact(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    step = ValueReplacer(replace_na=False, custom_rules=[("1-URGENT", "URGENT", False, ["o_orderpriority"])])
    return step.fit_transform(o, ctx_for(o))[0]


@register("replace_regex", """SELECT o_orderkey, CASE WHEN regexp_matches(coalesce(o_orderpriority, ''), '^(?:[0-9]-(HIGH|LOW))')
    THEN 'HL' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def q_replace_regex(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    step = ValueReplacer(replace_na=False, custom_rules=[("[0-9]-(HIGH|LOW)", "HL", True, ["o_orderpriority"])])
    return step.fit_transform(o, ctx_for(o))[0]


# ============================================================ roles and conversion
DUCK_FORMATS = {
    "yyyy-M-d": "%Y-%m-%d", "yyyy/M/d": "%Y/%m/%d", "yyyy-M-d H:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy/M/d H:mm:ss": "%Y/%m/%d %H:%M:%S", "yyyy-M-d H:mm": "%Y-%m-%d %H:%M",
    "yyyy-M-d'T'H:mm:ss": "%Y-%m-%dT%H:%M:%S", "M/d/yyyy": "%m/%d/%Y", "d/M/yyyy": "%d/%m/%Y",
    "M/d/yyyy H:mm:ss": "%m/%d/%Y %H:%M:%S", "yyyyMMdd": "%Y%m%d", "yyyy年M月d日": "%Y年%m月%d日",
    "MMM d, yyyy": "%b %d, %Y",
}
NUM_OK_SQL = "(regexp_matches({x}, " + lit(nb.NUMBER_RE) + ") AND try_cast({x} AS DOUBLE) IS NOT NULL)"
DATE_WORDS_SQL = " OR ".join(f"contains(lower({{name}}), {lit(w)})" for w in vocab.DATE_NAME_WORDS)


def role_sql(src: str, c: str) -> str:
    x = c
    lc = f"lower(trim({x}))"
    dt = " , ".join(f"count_if(try_strptime({x}, {lit(f)}) IS NOT NULL)" for f in DUCK_FORMATS.values())
    words = vocab.TRUE_WORDS + vocab.FALSE_WORDS
    pair_tests = " OR ".join(
        "(" + " AND ".join(f"NOT bool_or(coalesce({lc} = {lit(w)}, false))" for w in words if w not in pair) + ")"
        for pair in vocab.BOOL_PAIRS)
    name_date = DATE_WORDS_SQL.format(name=lit(c))
    return f"""SELECT {lit(c)} AS column_name, CASE
      WHEN nn = 0 THEN 'text'
      WHEN num * 1.0 / n >= 0.9 AND dt * 1.0 / n >= 0.8 THEN CASE WHEN {name_date} THEN 'datetime' ELSE 'numeric' END
      WHEN dt * 1.0 / n >= 0.8 THEN 'datetime'
      WHEN num * 1.0 / n >= 0.9 THEN 'numeric'
      WHEN nonbool = 0 AND bpair THEN 'boolean'
      WHEN nd * 1.0 / nn < 0.1 THEN 'categorical'
      ELSE 'text' END AS role
    FROM (SELECT count(*) AS n, count({x}) AS nn, count_if({fx(NUM_OK_SQL, x)}) AS num,
      greatest({dt}) AS dt, count(DISTINCT {x}) AS nd,
      count_if({x} IS NOT NULL AND {lc} NOT IN ({", ".join(lit(w) for w in words)})) AS nonbool,
      ({pair_tests}) AS bpair FROM {src})"""


@register("type_roles", " UNION ALL ".join(role_sql(V.ORDERS_TEXT_SQL, c) for c in V.ORDERS_TEXT_COLS))
def q_type_roles(spark, d):
    o = V.orders_text(spark, d)
    f = TypeDetector().fit(o, ctx_for(o))
    return spark.createDataFrame(sorted(f.state["roles"].items()), "column_name string, role string")


@register("to_number", f"""SELECT o_orderkey, CASE WHEN regexp_matches(o_totalprice, {lit(nb.NUMBER_RE)})
    THEN try_cast(o_totalprice AS DOUBLE) END AS o_totalprice FROM {V.ORDERS_BAD_NUMBERS_SQL}""")
def q_to_number(spark, d):
    o = V.orders_bad_numbers(spark, d)
    return TypeDetector().fit_transform(o, ctx_for(o))[0]


@register("to_boolean", f"""SELECT o_orderkey, CASE WHEN lower(trim(o_flag)) IN ({", ".join(lit(w) for w in vocab.TRUE_WORDS)})
    THEN true WHEN lower(trim(o_flag)) IN ({", ".join(lit(w) for w in vocab.FALSE_WORDS)}) THEN false END AS o_flag
    FROM {V.ORDERS_BOOL_SQL}""")
def q_to_boolean(spark, d):
    o = V.orders_bool_text(spark, d)
    return TypeDetector().fit_transform(o, ctx_for(o))[0]


@register("to_timestamp", f"""SELECT o_orderkey, strftime(try_strptime(o_orderdate, '%Y-%m-%d'), {TS_SQL}) AS o_orderdate
    FROM {V.ORDERS_DATE_TEXT_SQL}""")
def q_to_timestamp(spark, d):
    o = V.orders_date_text(spark, d)
    out = TypeDetector().fit_transform(o, ctx_for(o))[0]
    return out.select("o_orderkey", F.date_format("o_orderdate", TS_FMT).alias("o_orderdate"))


# ============================================================ ID columns
UUID_RE = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
CUSTOMER_COLS = {"c_custkey": "num", "c_name": "str", "c_nationkey": "num", "c_acctbal": "num",
                 "c_mktsegment": "str", "c_ref": "str", "c_tag": "str", "c_step": "num"}
LINEITEM_KINDS = {c: ("str" if c in ("l_returnflag", "l_linestatus") else "ts" if c == "l_shipdate" else "num")
                  for c in V.LINEITEM_COLS}


def id_sql(tname: str, src: str, c: str, kind: str) -> str:
    name = " OR ".join(f"contains(lower({lit(c)}), {lit(w)})" for w in vocab.ID_NAME_WORDS)
    seq = "false"
    if kind == "num":
        seq = f"""coalesce((SELECT d > 0 AND k * 1.0 / (nn - 1) > 0.8 AND nn > 2 FROM (
            SELECT d, count(*) AS k, (SELECT count({c}) FROM {src}) AS nn FROM (
              SELECT {c} - lag({c}) OVER (ORDER BY {c}) AS d FROM {src} WHERE {c} IS NOT NULL)
            WHERE d IS NOT NULL GROUP BY d ORDER BY k DESC, d ASC LIMIT 1)), false)"""
    uuid = "false"
    if kind == "str":
        uuid = f"""coalesce((SELECT avg(CASE WHEN regexp_matches(v, {lit(UUID_RE)}) THEN 1.0 ELSE 0.0 END) > 0.5 FROM (
            SELECT CAST({c} AS VARCHAR) AS v FROM {src} WHERE {c} IS NOT NULL)), false)"""
    uniq = f"(SELECT count(DISTINCT {c}) * 1.0 / count(*) >= 0.9 AND count({c}) > 0 FROM {src})"
    return f"SELECT {lit(tname)} AS table_name, {lit(c)} AS column_name, (({name}) OR {uniq} OR {seq} OR {uuid}) AS is_id"


@register("id_columns", " UNION ALL ".join(
    [id_sql("customer", V.CUSTOMER_UUID_SQL, c, k) for c, k in CUSTOMER_COLS.items()]
    + [id_sql("lineitem", "lineitem", c, k) for c, k in LINEITEM_KINDS.items()]))
def q_id_columns(spark, d):
    rows = []
    cu = V.customer_uuid(spark, d)
    cu = cu.withColumn(ROW_ID, F.col("c_custkey"))
    f = IdColumnDetector().fit(cu, ctx_for(cu, order_by=["c_custkey"]))
    rows += [("customer", c, c in f.state["ids"]) for c in CUSTOMER_COLS]
    li = table(spark, d, "lineitem")
    li = li.withColumn(ROW_ID, F.monotonically_increasing_id())
    f = IdColumnDetector().fit(li, ctx_for(li, order_by=V.LINEITEM_COLS))
    rows += [("lineitem", c, c in f.state["ids"]) for c in V.LINEITEM_COLS]
    return spark.createDataFrame(rows, "table_name string, column_name string, is_id boolean")


# ============================================================ constant columns
SUPPLIER_KINDS = {"s_suppkey": True, "s_name": False, "s_nationkey": True, "s_acctbal": True,
                  "k": True, "z": False, "rare": True}


def const_sql(c, numeric):
    var = f"OR stddev_samp({c}) IS NULL OR stddev_samp({c}) = 0" if numeric else ""
    return f"""SELECT {lit(c)} AS column_name, (count(DISTINCT {c}) <= 1 {var}
      OR (count(*) - count({c})) * 1.0 / count(*) >= 0.95) AS dropped FROM {V.SUPPLIER_CONSTANTS_SQL}"""


@register("prune_constant", " UNION ALL ".join(const_sql(c, n) for c, n in SUPPLIER_KINDS.items()))
def q_prune_constant(spark, d):
    s = V.supplier_constants(spark, d)
    f = ConstantRemover().fit(s, ctx_for(s))
    return spark.createDataFrame([(c, c in f.state["drop"]) for c in s.columns],
                                 "column_name string, dropped boolean")


# ============================================================ text
def _docs(spark, d):
    t = V.documents_dirty(spark, d)
    return t, ctx_for(t, {"text": Role.TEXT}, ids=["doc_id"])


ENC_OFF = dict(trim_whitespace=False, normalize_fullwidth=False, unicode_normalize=None,
               replace_smart_quotes=False, collapse_whitespace=False)
TXT_OFF = dict(remove_accents=False, collapse_whitespace=False)
FW_SRC, FW_DST = vocab.fullwidth_pairs()
QUOTES_SQL = ("replace(replace(translate({x}, " + lit("".join(vocab.SMART_PUNCT_1TO1)) + ", "
              + lit("".join(vocab.SMART_PUNCT_1TO1.values())) + "), '—', '--'), '…', '...')")
COLLAPSE_SQL = "regexp_replace({x}, " + lit(tx.WS + "+") + ", ' ', 'g')"


def _text_query(name, sql_expr, step):
    @register(name, f"SELECT doc_id, {fx(sql_expr, 'text')} AS text FROM {V.DOCUMENTS_DIRTY_SQL}")
    def q(spark, d):
        t, ctx = _docs(spark, d)
        return step.fit_transform(t, ctx)[0]
    return q


_text_query("text_trim", TRIM_SQL, EncodingNormalizer(**{**ENC_OFF, "trim_whitespace": True}))
_text_query("text_fullwidth", "translate({x}, " + lit(FW_SRC) + ", " + lit(FW_DST) + ")",
            EncodingNormalizer(**{**ENC_OFF, "normalize_fullwidth": True}))
_text_query("text_quotes", QUOTES_SQL, EncodingNormalizer(**{**ENC_OFF, "replace_smart_quotes": True}))
_text_query("text_collapse", COLLAPSE_SQL, EncodingNormalizer(**{**ENC_OFF, "collapse_whitespace": True}))
_text_query("text_case", "lower({x})", TextStandardizer(**{**TXT_OFF, "case": "lower"}))
_text_query(
    "text_strip_pattern",
    fx(TRIM_SQL, fx(COLLAPSE_SQL, "regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, "
                    + lit(tx.URL_RE) + ", '', 'g'), " + lit(tx.EMAIL_RE) + ", '', 'g'), "
                    + lit(tx.DIGITS) + ", '', 'g'), " + lit(tx.PUNCT_RE) + ", '', 'g')")),
    TextStandardizer(remove_accents=False, remove_urls=True, remove_emails=True, remove_numbers=True,
                     remove_punctuation=True, collapse_whitespace=True))
_text_query("text_special",
            fx(TRIM_SQL, fx(COLLAPSE_SQL, "regexp_replace({x}, " + lit(tx.SPECIAL_RE) + ", '', 'g')")),
            TextStandardizer(remove_accents=False, remove_special_chars=True, collapse_whitespace=True))


@register("text_nfkc")
def q_text_nfkc(spark, d):
    t, ctx = _docs(spark, d)
    return EncodingNormalizer().fit_transform(t, ctx)[0]


@register("text_title")
def q_text_title(spark, d):
    t, ctx = _docs(spark, d)
    return TextStandardizer(remove_accents=False, case="title").fit_transform(t, ctx)[0]


@register("text_accents")
def q_text_accents(spark, d):
    t, ctx = _docs(spark, d)
    return TextStandardizer().fit_transform(t, ctx)[0]


# ============================================================ dates
@register("date_standardize", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders")
def q_date_standardize(spark, d):
    o = V.orders_dates5(spark, d)
    return DatetimeStandardizer(current_year=2024).fit_transform(o, ctx_for(o, ids=["o_orderkey"]))[0]


# ============================================================ units, percent, decimals
UNITS = vocab.units_for(None)
U_RE, R_RE = nb.unit_regex(UNITS), nb.range_regex(UNITS)


def _num_sql(x):
    return f"CASE WHEN regexp_matches({x}, {lit(nb.NUMBER_RE)}) THEN try_cast({x} AS DOUBLE) END"


def unit_sql(ranges: bool) -> str:
    rng = (f"""WHEN regexp_matches(l_quantity, {lit(R_RE)}) THEN
        (try_cast(replace(regexp_extract(l_quantity, {lit(R_RE)}, 1), ',', '') AS DOUBLE)
         + try_cast(replace(regexp_extract(l_quantity, {lit(R_RE)}, 2), ',', '') AS DOUBLE)) / 2.0""" if ranges else "")
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE
      WHEN regexp_matches(l_quantity, {lit(U_RE)}) THEN try_cast(replace(regexp_extract(l_quantity, {lit(U_RE)}, 1), ',', '') AS DOUBLE)
      {rng}
      ELSE {_num_sql("replace(l_quantity, ',', '')")} END AS "l_quantity(kg)" FROM {V.LINEITEM_UNITS_SQL}"""


@register("unit_strip", unit_sql(False))
def q_unit_strip(spark, d):
    li = V.lineitem_units(spark, d)
    return UnitDetector(handle_ranges=False).fit_transform(li, ctx_for(li))[0]


@register("unit_range", unit_sql(True))
def q_unit_range(spark, d):
    li = V.lineitem_units(spark, d)
    return UnitDetector().fit_transform(li, ctx_for(li))[0]


@register("percent_unify", f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE
    WHEN regexp_matches(l_discount, {lit(nb.PERCENT_RE)}) THEN try_cast(regexp_extract(l_discount, {lit(nb.PERCENT_RE)}, 1) AS DOUBLE) / 100.0
    WHEN regexp_matches(l_discount, {lit(nb.PERMILLE_RE)}) THEN try_cast(regexp_extract(l_discount, {lit(nb.PERMILLE_RE)}, 1) AS DOUBLE) / 1000.0
    ELSE {_num_sql("l_discount")} END AS l_discount FROM {V.LINEITEM_PERCENT_SQL}""")
def q_percent_unify(spark, d):
    li = V.lineitem_percent(spark, d)
    return PercentageUnifier().fit_transform(li, ctx_for(li))[0]


def _parts(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_retailprice") / 3).alias("p_third"))
    return p, ctx_for(p, ids=["p_partkey"])


DEC_COUNT_SQL = "length(split_part(rtrim(printf('%.10f', p_retailprice / 3), '0'), '.', 2))"
DEC_PLACES_SQL = f"(SELECT greatest(0, least(CAST(floor(quantile_cont({DEC_COUNT_SQL}, 0.9)) AS INTEGER), 6)) FROM part)"


@register("decimal_auto", f"""SELECT p_partkey, round_even(p_retailprice / 3 * pow(10, {DEC_PLACES_SQL}), 0)
    / pow(10, {DEC_PLACES_SQL}) AS p_third FROM part""")
def q_decimal_auto(spark, d):
    p, ctx = _parts(spark, d)
    return DecimalUnifier().fit_transform(p, ctx)[0]


@register("decimal_floor", "SELECT p_partkey, floor(p_retailprice / 3 * 100.0) / 100.0 AS p_third FROM part")
def q_decimal_floor(spark, d):
    p, ctx = _parts(spark, d)
    return DecimalUnifier(mode="fixed", method="floor").fit_transform(p, ctx)[0]


@register("decimal_ceil", "SELECT p_partkey, ceil(p_retailprice / 3 * 100.0) / 100.0 AS p_third FROM part")
def q_decimal_ceil(spark, d):
    p, ctx = _parts(spark, d)
    return DecimalUnifier(mode="fixed", method="ceil").fit_transform(p, ctx)[0]


# ============================================================ missing values
def _gaps(spark, d):
    e = V.events_gaps(spark, d).select("event_id", "value")
    e = e.withColumn(ROW_ID, F.col("event_id"))
    return e, ctx_for(e, {"event_id": Role.NUMERIC, "value": Role.NUMERIC}, ids=["event_id"], order_by=["event_id"])


def _fill(name, strategy, sql_value, where=""):
    @register(name, f"SELECT event_id, round({sql_value}, 6) AS value FROM {V.EVENTS_GAPS_SQL} {where}")
    def q(spark, d):
        e, ctx = _gaps(spark, d)
        out = MissingHandler(strategy=strategy).fit_transform(e, ctx)[0]
        return out.select("event_id", r6(F.col("value")).alias("value"))
    return q


G = V.EVENTS_GAPS_SQL
_fill("fill_mean", "mean", f"coalesce(value, (SELECT avg(value) FROM {G}))")
_fill("fill_median", "median", f"coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {G}))")
_fill("fill_mode", "mode", f"""coalesce(value, (SELECT value FROM {G} WHERE value IS NOT NULL GROUP BY value
      ORDER BY count(*) DESC, value ASC LIMIT 1))""")
_fill("fill_ffill", "ffill",
      "last_value(value IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
_fill("fill_bfill", "bfill",
      "first_value(value IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
_fill("drop_null_rows", "drop_rows", "value", "WHERE value IS NOT NULL")

INTERP_SQL = f"""WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS pos FROM {G}),
w AS (SELECT event_id, value, pos,
  last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  last_value(value IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  first_value(value IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p)
SELECT event_id, round(CASE WHEN value IS NOT NULL THEN value WHEN pp IS NULL THEN NULL WHEN np IS NULL THEN pv
  ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS value FROM w"""


@register("fill_interpolate", INTERP_SQL)
def q_fill_interpolate(spark, d):
    e, ctx = _gaps(spark, d)
    out = MissingHandler(strategy="interpolate").fit_transform(e, ctx)[0]
    return out.select("event_id", r6(F.col("value")).alias("value"))


M = V.EVENTS_MULTI_GAPS_SQL


@register("missing_auto", f"""WITH b AS {M},
mu AS (SELECT avg(value) AS m FROM b),
sk AS (SELECT avg(power(value - m, 3)) / power(avg(power(value - m, 2)), 1.5) AS s FROM b, mu WHERE value IS NOT NULL),
r AS (SELECT * FROM b WHERE event_type IS NOT NULL),
f AS (SELECT CASE WHEN abs((SELECT s FROM sk)) > 1.0 THEN quantile_cont(value, 0.5) ELSE avg(value) END AS v FROM r)
SELECT event_id, strftime(ts, {TS_SQL}) AS ts, user_id, event_type, round(coalesce(value, v), 6) AS value FROM r, f""")
def q_missing_auto(spark, d):
    e = V.events_multi_gaps(spark, d).withColumn(ROW_ID, F.col("event_id"))
    ctx = ctx_for(e, order_by=["event_id"])
    e, ctx = TypeDetector().fit_transform(e, ctx)
    out = MissingHandler().fit_transform(e, ctx)[0]
    shown = {"ts": F.date_format("ts", TS_FMT).alias("ts"), "value": r6(F.col("value")).alias("value")}
    return nodrop(out.select(*[shown.get(c, F.col(c)) for c in out.columns]))       # no column is selected away (M6)


# ============================================================ scaling
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li_num(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)
    return li, ctx_for(li, {c: Role.NUMERIC for c in LI_NUM}, ids=["l_orderkey", "l_linenumber"])


def _scale(name, method, sql_expr):
    cols = ", ".join(f"round({fx(sql_expr, c)}, 6) AS {c}" for c in LI_NUM)

    @register(name, f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem")
    def q(spark, d):
        li, ctx = _li_num(spark, d)
        out = FeatureScaler(method=method).fit_transform(li, ctx)[0]
        return out.select("l_orderkey", "l_linenumber", *[r6(F.col(c)).alias(c) for c in LI_NUM])
    return q


_scale("scale_standard", "standard", "({x} - avg({x}) OVER ()) / stddev_samp({x}) OVER ()")
_scale("scale_minmax", "minmax", "0.0 + ({x} - min({x}) OVER ()) * 1.0 / (max({x}) OVER () - min({x}) OVER ())")
_scale("scale_robust", "robust", """({x} - quantile_cont({x}, 0.5) OVER ()) /
       (quantile_cont({x}, 0.75) OVER () - quantile_cont({x}, 0.25) OVER ())""")


# ============================================================ skew
def _skew(spark, d, method):
    e, ctx = _events_value(spark, d)
    out = SkewnessCorrector(method=method).fit_transform(e, ctx)[0]
    return out.select("event_id", r6(F.col("value")).alias("value"))


@register("skew_log", """SELECT event_id, round(ln(value + CASE WHEN (SELECT min(value) FROM events) <= 0
    THEN abs((SELECT min(value) FROM events)) + 1 ELSE 0 END), 6) AS value FROM events""")
def q_skew_log(spark, d):
    return _skew(spark, d, "log")


def _lambda_sql(kind):
    """λ by halving an interval on the sign of the likelihood's derivative, then the transformed values."""
    if kind == "box_cox":
        x = "(value + CASE WHEN (SELECT min(value) FROM events) <= 0 THEN abs((SELECT min(value) FROM events)) + 1 ELSE 0 END)"
        sign, length, power = "1", f"ln{x}", "m"
    else:
        sign, length, power = "CASE WHEN value >= 0 THEN 1 ELSE -1 END", "ln(1 + abs(value))", "CASE WHEN g > 0 THEN m ELSE 2 - m END"
    y, y1 = "g * (exp(p * l) - 1) / p", "(exp(p * l) * (p * l - 1) + 1) / (p * p)"
    return f"""WITH RECURSIVE x AS MATERIALIZED (SELECT {sign} AS g, {length} AS l FROM events WHERE value IS NOT NULL),
    it AS (SELECT 0 AS i, -4.0::DOUBLE AS lo, 4.1::DOUBLE AS hi UNION ALL
           SELECT i + 1, CASE WHEN slope > 0 THEN m ELSE lo END, CASE WHEN slope > 0 THEN hi ELSE m END
           FROM (SELECT i, lo, hi, m, sum(g * l) - count(*) * covar_pop({y}, {y1}) / var_pop({y}) AS slope
                 FROM (SELECT i, lo, hi, m, g, l, {power} AS p FROM (SELECT i, lo, hi, (lo + hi) / 2 AS m FROM it), x) GROUP BY i, lo, hi, m) WHERE i < 44),
    best AS (SELECT (lo + hi) / 2 AS m FROM it ORDER BY i DESC LIMIT 1)
    SELECT event_id, round({y}, 6) AS value FROM (SELECT event_id, g, l, {power} AS p
        FROM (SELECT event_id, {sign} AS g, {length} AS l FROM events), best)"""


@register("skew_boxcox", _lambda_sql("box_cox"))
def q_skew_boxcox(spark, d):
    return _skew(spark, d, "box_cox")


@register("skew_yeojohnson", _lambda_sql("yeo_johnson"))
def q_skew_yeojohnson(spark, d):
    return _skew(spark, d, "yeo_johnson")


# ============================================================ bins
def _bins(spark, d, method):
    e, ctx = _events_value(spark, d)
    e = e.withColumn(ROW_ID, F.col("event_id"))
    ctx = ctx.with_(order_by=("event_id",))
    return nodrop(Binning(method=method).fit_transform(e, ctx)[0])


EDGES = " + ".join(f"CAST(value > {i} * ((mx - mn) / 5.0) + mn AS INTEGER)" for i in range(1, 5))


@register("bin_width", f"""SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE {EDGES} END AS value_bin
    FROM events, (SELECT min(value) AS mn, max(value) AS mx FROM events)""")
def q_bin_width(spark, d):
    return _bins(spark, d, "equal_width")


@register("bin_freq", """SELECT event_id, CAST(greatest(0, (((r - 1) * 5 + n - 2) // (n - 1)) - 1) AS INTEGER) AS value_bin
    FROM (SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS r, count(*) OVER () AS n
          FROM events WHERE value IS NOT NULL)""")
def q_bin_freq(spark, d):
    return _bins(spark, d, "equal_freq")


def _code_sql(x, op):
    return " + ".join(f"CAST({x} {op} (c[{j}] + c[{j + 1}]) / 2 AS INTEGER)" for j in range(1, 5))


# Lloyd's iteration step by step: centres as a list, until they move by less than the tolerance
@register("bin_kmeans", f"""WITH RECURSIVE x AS MATERIALIZED (SELECT coalesce(value, (SELECT quantile_cont(value, 0.5) FROM events)) AS v FROM events),
    z AS (SELECT var_pop(v) AS var FROM x),
    it AS (SELECT 0 AS i, list_transform(range(5), lambda j: lo + (hi - lo) * (j + 0.5) / 5) AS c, false AS done
           FROM (SELECT min(value) AS lo, max(value) AS hi FROM events)
           UNION ALL
           SELECT i + 1, new, list_sum(list_transform(range(1, 6), lambda j: pow(new[j] - c[j], 2))) <= 1e-4 * var
           FROM (SELECT i, c, list(a ORDER BY k) AS new FROM (SELECT i, c, {_code_sql("v", ">")} AS k, avg(v) AS a FROM it, x WHERE NOT done GROUP BY ALL)
                 GROUP BY i, c), z WHERE i < 300)
    SELECT event_id, CASE WHEN value IS NOT NULL THEN {_code_sql("value", ">=")} END AS value_bin
    FROM events, (SELECT c FROM it ORDER BY i DESC LIMIT 1)""")
def q_bin_kmeans(spark, d):
    return _bins(spark, d, "kmeans")


# ============================================================ encoding
PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _orders_cat(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return o, ctx_for(o, {"o_orderpriority": Role.CATEGORICAL}, ids=["o_orderkey"])


@register("encode_onehot", "SELECT o_orderkey, " + ", ".join(
    f"coalesce(o_orderpriority = {lit(v)}, false) AS \"o_orderpriority_{v}\"" for v in PRIOS[1:]) + " FROM orders")
def q_encode_onehot(spark, d):
    o, ctx = _orders_cat(spark, d)
    return CategoricalEncoder(method="onehot").fit_transform(o, ctx)[0]


@register("encode_label", """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER)
    AS o_orderpriority FROM orders""")
def q_encode_label(spark, d):
    o, ctx = _orders_cat(spark, d)
    return CategoricalEncoder(method="label").fit_transform(o, ctx)[0]


ORD = list(reversed(PRIOS))


@register("encode_ordinal", "SELECT o_orderkey, CASE o_orderpriority " + " ".join(
    f"WHEN {lit(v)} THEN {i}" for i, v in enumerate(ORD)) + " END AS o_orderpriority FROM orders")
def q_encode_ordinal(spark, d):
    o, ctx = _orders_cat(spark, d)
    return CategoricalEncoder(method="ordinal", ordinal_order={"o_orderpriority": ORD}).fit_transform(o, ctx)[0]


# ============================================================ correlation
PAIRS = [(a, b) for i, a in enumerate(LI_NUM) for b in LI_NUM[i + 1:]]


@register("corr_pearson", " UNION ALL ".join(
    f"SELECT {lit(a)} AS col_a, {lit(b)} AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in PAIRS))
def q_corr_pearson(spark, d):
    li, _ = _li_num(spark, d)
    return pearson_pairs(li, LI_NUM).select("col_a", "col_b", r6(F.col("r")).alias("r"))


RANKS = "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in LI_NUM) + " FROM lineitem"


@register("corr_spearman", f"WITH rk AS ({RANKS}) " + " UNION ALL ".join(
    f"SELECT {lit(a)} AS col_a, {lit(b)} AS col_b, round(corr({a}, {b}), 6) AS r FROM rk" for a, b in PAIRS))
def q_corr_spearman(spark, d):
    li, _ = _li_num(spark, d)
    return spearman_pairs(li, LI_NUM).select("col_a", "col_b", r6(F.col("r")).alias("r"))


VIF_COLS = ["l_quantity", "l_q2", "l_discount"]
_g = {(i, j): f"g{i}{j}" for i in range(3) for j in range(3)}
VIF_SQL = ("WITH x AS (SELECT l_quantity AS x0, l_quantity * 2 + l_tax * 100 AS x1, l_discount AS x2 FROM lineitem), "
           "g AS (SELECT " + ", ".join(f"sum(x{i} * x{j}) AS g{i}{j}" for i in range(3) for j in range(i, 3)) + " FROM x), "
           "c AS (SELECT *, g11 * g22 - g12 * g12 AS c0, g00 * g22 - g02 * g02 AS c1, g00 * g11 - g01 * g01 AS c2, "
           "g00 * (g11 * g22 - g12 * g12) - g01 * (g01 * g22 - g12 * g02) + g02 * (g01 * g12 - g11 * g02) AS det FROM g) "
           "SELECT 'l_quantity' AS column_name, round(g00 * c0 / det, 4) AS vif FROM c UNION ALL "
           "SELECT 'l_q2', round(g11 * c1 / det, 4) FROM c UNION ALL "
           "SELECT 'l_discount', round(g22 * c2 / det, 4) FROM c")


@register("vif", VIF_SQL)
def q_vif(spark, d):
    li = V.lineitem_collinear(spark, d)
    rows = [(c, round(v, 4)) for c, v in vif(li, VIF_COLS)]
    return spark.createDataFrame(rows, "column_name string, vif double")


# ============================================================ profile and log
EV_COLS = {"event_id": "num", "ts": "ts", "user_id": "num", "event_type": "str", "value": "num", "props": "str"}


def prof_sql(c, kind):
    if kind == "num":
        stats = f"""round(avg({c}), 6), round(quantile_cont({c}, 0.5), 6), round(stddev_samp({c}), 6),
          round(avg(power({c} - (SELECT avg({c}) FROM events), 3)) / power(avg(power({c} - (SELECT avg({c}) FROM events), 2)), 1.5), 6),
          CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR), CAST(CAST(max({c}) AS DOUBLE) AS VARCHAR)"""
    else:
        stats = f"NULL, NULL, NULL, NULL, CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR)"
    return (f"SELECT {lit(c)}, count(*), count(*) - count({c}), count(DISTINCT {c}), {stats} FROM events")


@register("profile", "SELECT * FROM (" + " UNION ALL ".join(prof_sql(c, k) for c, k in EV_COLS.items())
          + ") AS t(column_name, count, missing, unique_count, mean, median, std, skewness, min_value, max_value)")
def q_profile(spark, d):
    e = table(spark, d, "events")
    p = profile(e)
    return p.select(F.col("column").alias("column_name"), "count", "missing", F.col("unique").alias("unique_count"),
                    r6(F.col("mean")).alias("mean"), r6(F.col("median")).alias("median"), r6(F.col("std")).alias("std"),
                    r6(F.col("skewness")).alias("skewness"), F.col("min").alias("min_value"),
                    F.col("max").alias("max_value"))


TOP_COLS = ["event_type", "user_id", "value"]


@register("top_values", "SELECT column_name, rk, value, n FROM (SELECT column_name, value, n, row_number() OVER "
          "(PARTITION BY column_name ORDER BY n DESC, value ASC) AS rk FROM (" + " UNION ALL ".join(
              f"SELECT {lit(c)} AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM events "
              f"WHERE {c} IS NOT NULL GROUP BY 2" for c in TOP_COLS) + ")) WHERE rk <= 5")
def q_top_values(spark, d):
    e = table(spark, d, "events").select(*TOP_COLS)
    p = profile(e)
    return (p.select(F.col("column").alias("column_name"), F.posexplode("top_values").alias("pos", "tv"))
            .select("column_name", (F.col("pos") + 1).cast("long").alias("rk"), F.col("tv.value").alias("value"),
                    F.col("tv.n").alias("n")))


@register("missing_summary", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {lit(c)}, count({c}), count(*), round((count(*) - count({c})) * 1.0 / count(*), 6) FROM {G}"
    for c in ["event_id", "ts", "user_id", "event_type", "value"]) + ") AS t(column_name, non_null, count, missing_rate)")
def q_missing_summary(spark, d):
    e = V.events_gaps(spark, d)
    st = changelog.column_state(profile(e))
    return st.select(F.col("column").alias("column_name"), "non_null", "count", r6(F.col("missing_rate")).alias("missing_rate"))


def _enc_sql(x):
    """encoding_normalizer without NFKC, as SQL."""
    return fx(COLLAPSE_SQL, fx(QUOTES_SQL, "translate(" + fx(TRIM_SQL, x) + ", " + lit(FW_SRC)
                                                     + ", " + lit(FW_DST) + ")"))


LOG_STEP = EncodingNormalizer(unicode_normalize=None)


@register("cell_log", f"""SELECT 'encoding_normalizer' AS step, 'text' AS column_name, doc_id AS row_id, text AS original,
    {_enc_sql('text')} AS new FROM {V.DOCUMENTS_DIRTY_SQL} WHERE text IS DISTINCT FROM {_enc_sql('text')}""")
def q_cell_log(spark, d):
    t, ctx = _docs(spark, d)
    t = t.withColumn(ROW_ID, F.col("doc_id"))
    f = LOG_STEP.fit(t, ctx)
    log = changelog.cell_diff(t, LOG_STEP.name, f.exprs(t, ctx))
    return log.select("step", F.col("column").alias("column_name"), "row_id", "original", "new")


@register("changes_per_step", f"""WITH a AS (SELECT text AS t0, {_enc_sql('text')} AS t1 FROM {V.DOCUMENTS_DIRTY_SQL}),
b AS (SELECT t0, t1, lower(t1) AS t2 FROM a)
SELECT 'encoding_normalizer' AS step, CAST(count_if(t0 IS DISTINCT FROM t1) AS BIGINT) AS changes FROM b
UNION ALL SELECT 'text_standardizer', CAST(count_if(t1 IS DISTINCT FROM t2) AS BIGINT) FROM b""")
def q_changes_per_step(spark, d):
    from prepwise.plans.chain import REGISTRY, CleaningPipeline
    t, ctx = _docs(spark, d)
    t = t.withColumn(ROW_ID, F.col("doc_id"))
    pipe = CleaningPipeline(
        enabled_steps={c.name: c.name in ("encoding_normalizer", "text_standardizer") for c in REGISTRY},
        step_configs={"encoding_normalizer": {"unicode_normalize": None},
                      "text_standardizer": {**TXT_OFF, "case": "lower"}},
        log_cells=True)
    fp = pipe.fit(t, ctx)
    return changelog.changes_per_step(fp.cell_log())


def _step_log(df, ctx, step, config, **on):
    """The cell log of a pipeline that runs one step."""
    from prepwise.plans.chain import REGISTRY, CleaningPipeline
    pipe = CleaningPipeline({c.name: c.name == step for c in REGISTRY}, {step: config}, log_cells=True)
    return pipe.fit(df, ctx).cell_log().withColumnRenamed("column", "column_name")


@register("fill_log", f"""SELECT 'missing_handler' AS step, 'value' AS column_name, event_id AS row_id, NULL::VARCHAR AS original, round(filled, 6) AS new
    FROM (SELECT event_id, value, last_value(value IGNORE NULLS) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled FROM {G})
    WHERE value IS NULL AND filled IS NOT NULL""")
def q_fill_log(spark, d):
    e, ctx = _gaps(spark, d)
    log = _step_log(e, ctx, "missing_handler", {"strategy": "ffill"})
    return log.select("step", "column_name", "row_id", "original", r6(F.col("new").cast("double")).alias("new"))


@register("convert_log", f"""SELECT 'type_detector' AS step, 'o_totalprice' AS column_name, o_orderkey AS row_id, o_totalprice AS original, NULL::VARCHAR AS new
    FROM {V.ORDERS_BAD_NUMBERS_SQL} WHERE o_totalprice IS NOT NULL
    AND CASE WHEN regexp_matches(o_totalprice, {lit(nb.NUMBER_RE)}) THEN try_cast(o_totalprice AS DOUBLE) END IS NULL""")
def q_convert_log(spark, d):
    o = V.with_id(V.orders_bad_numbers(spark, d), "o_orderkey")
    return _step_log(o, ctx_for(o), "type_detector", {}).select("step", "column_name", "row_id", "original", "new")


@register("removed_log", """SELECT 'duplicate_handler' AS step, NULL::VARCHAR AS column_name, o_orderkey AS row_id, 'row removed' AS reason
    FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn > 1""")
def q_removed_log(spark, d):
    o = V.with_id(table(spark, d, "orders"), "o_orderkey")
    log = _step_log(o, ctx_for(o), "duplicate_handler", {"action": "keep_first", "subset": ["o_custkey"]})
    return log.select("step", "column_name", "row_id", "reason")


@register("encode_log", """SELECT 'categorical_encoder' AS step, 'o_orderpriority' AS column_name, o_orderkey AS row_id, o_orderpriority AS original,
    CASE WHEN o_orderpriority > (SELECT min(o_orderpriority) FROM orders) THEN 'o_orderpriority_' || o_orderpriority END AS new FROM orders""")
def q_encode_log(spark, d):
    o, ctx = _orders_cat(spark, d)
    o = V.with_id(o, "o_orderkey")
    return _step_log(o, ctx, "categorical_encoder", {"method": "onehot"}).select("step", "column_name", "row_id", "original", "new")


@register("preview_page", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 100""")
def q_preview_page(spark, d):
    o = table(spark, d, "orders")
    page = o.orderBy("o_orderkey").offset(100).limit(100)
    return page.withColumn("o_orderdate", F.date_format("o_orderdate", TS_FMT))


# ============================================================ sources and sinks
def _stored(spark, d, ext, **options):
    """Orders written by ``save`` to the session's shared folder and read back by ``read``."""
    import uuid

    from prepwise.session import ensure_checkpoint_dir
    from prepwise.sources.readers import read
    from prepwise.sources.writers import save
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepwise-io-{uuid.uuid4().hex}/orders.{ext}"
    o = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", TS_FMT))
    info = save(o, path)
    return read(spark, path, **options), path, info


ORDERS_SQL = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {TS_SQL}) AS o_orderdate,
    o_orderpriority FROM orders"""


def _round_trip(ext, **options):
    @register(f"io_{ext}", ORDERS_SQL)
    def q(spark, d):
        kinds = {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double"}
        back = _stored(spark, d, ext, **options)[0]
        return back.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in back.columns])
    return q


for _ext in ("csv", "tsv", "json", "parquet", "txt"):
    _round_trip(_ext)


@register("io_json_mixed", ORDERS_SQL)
def q_io_json_mixed(spark, d):
    """Orders in one folder as record lines and as array documents of a few thousand records."""
    import uuid

    from prepwise.session import ensure_checkpoint_dir
    from prepwise.sources.readers import read
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/prepwise-io-{uuid.uuid4().hex}/orders.json"
    o = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", TS_FMT))
    o.where("o_custkey % 3 > 0").write.json(path)
    documents = o.where("o_custkey % 3 = 0").groupBy(F.floor(F.col("o_orderkey") / 4000).alias("g")).agg(
        F.to_json(F.collect_list(F.struct(*o.columns))).alias("value"))
    documents.select(F.regexp_replace("value", r"\},\{", "},\n{").alias("value")).write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return read(spark, path).select(*[F.col(c).cast(k).alias(c) for c, k in o.dtypes])


@register("io_metadata", "SELECT count(*) AS file_rows, count(*) AS saved_rows, 6 AS cols, '.json' AS extension, 'utf-8' AS encoding FROM orders")
def q_io_metadata(spark, d):
    from prepwise.sources.readers import metadata
    df, path, info = _stored(spark, d, "json")
    m = metadata(df, path)
    return spark.createDataFrame([(m["rows"], info["rows"], m["cols"], m["extension"], m["encoding"])],
                                 "file_rows long, saved_rows long, cols int, extension string, encoding string")


# ============================================================ column names
MESSY = [" o key ", "1st cust", "---", "a__b", "A_B ", "fine"]


@register("name_clean", """SELECT o_orderkey AS o_key, o_custkey AS col_1st_cust, o_orderstatus AS col_2, o_totalprice AS a_b,
    strftime(o_orderdate, '%Y-%m-%d') AS "A_B_1", o_orderpriority AS fine FROM orders""")
def q_name_clean(spark, d):
    from prepwise.operators.text_steps import ColumnNameCleaner
    o = table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).toDF(*MESSY)
    return ColumnNameCleaner().fit_transform(o, ctx_for(o))[0]


# ============================================================ rarer branches
@register("encode_label_large", """SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY 'part ' || CAST(l_partkey AS VARCHAR)) - 1 AS INTEGER) AS part
    FROM lineitem""")
def q_encode_label_large(spark, d):
    """More categories than a literal map takes: codes are looked up."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("part "), F.col("l_partkey")).alias("part"))
    ctx = ctx_for(li, {"part": Role.CATEGORICAL}, ids=["l_orderkey", "l_linenumber"])
    return CategoricalEncoder(method="label", small_domain=10).fit_transform(li, ctx)[0]


@register("date_spellings", """SELECT o_orderkey, CASE o_orderkey % 20
    WHEN 5 THEN strftime(o_orderdate, '2024-%m-%d') WHEN 13 THEN strftime(o_orderdate, '2024-%m-%d')
    WHEN 10 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 12 THEN strftime(o_orderdate, '%Y-%m-01')
    WHEN 15 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS memo FROM orders""")
def q_date_spellings(spark, d):
    o = V.orders_spellings(spark, d)
    return DatetimeStandardizer(current_year=2024).fit_transform(o, ctx_for(o, ids=["o_orderkey"]))[0]


@register("role_branches", """SELECT 'blank' AS column_name, 'text' AS role UNION ALL SELECT 'ship_date', 'datetime'
    UNION ALL SELECT 'digits', 'numeric' UNION ALL SELECT 'remark', 'text' UNION ALL SELECT 'o_orderkey', 'numeric'""")
def q_role_branches(spark, d):
    o = V.orders_roles(spark, d)
    f = TypeDetector().fit(o, ctx_for(o))
    return spark.createDataFrame(sorted(f.state["roles"].items()), "column_name string, role string")


@register("prune_drop", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_prune_drop(spark, d):
    s = V.supplier_constants(spark, d).withColumn("low", F.col("s_suppkey") * 1e-9)
    return ConstantRemover(low_variance_threshold=0.01).fit_transform(s, ctx_for(s))[0]


@register("text_upper", "SELECT event_id, upper(event_type) AS event_type FROM events")
def q_text_upper(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    return TextStandardizer(**{**TXT_OFF, "case": "upper"}).fit_transform(e, ctx_for(e, {"event_type": Role.TEXT}))[0]


@register("percent_mode", f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE
    WHEN regexp_matches(l_discount, '^[0-9]+%$') THEN try_cast(replace(l_discount, '%', '') AS DOUBLE)
    WHEN regexp_matches(l_discount, '^[0-9]+‰$') THEN try_cast(replace(l_discount, '‰', '') AS DOUBLE) / 10.0
    END AS l_discount FROM {V.LINEITEM_PERCENT_SQL}""")
def q_percent_mode(spark, d):
    li = V.lineitem_percent(spark, d)
    return PercentageUnifier(mode="percent").fit_transform(li, ctx_for(li))[0]


@register("decimal_integers", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q_decimal_integers(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return DecimalUnifier(mode="fixed", fixed_places=1).fit_transform(li, ctx_for(li, ids=["l_orderkey", "l_linenumber"]))[0]


@register("fill_override", f"SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM {G})), 6) AS value FROM {G}")
def q_fill_override(spark, d):
    e, ctx = _gaps(spark, d)
    out = MissingHandler(strategy="mean", column_overrides={"value": "median"}).fit_transform(e, ctx)[0]
    return nodrop(out.withColumn("value", r6(F.col("value"))))


@register("bin_new_column", f"""SELECT event_id, value, CASE WHEN value IS NULL THEN NULL ELSE {EDGES} END AS value_bin
    FROM events, (SELECT min(value) AS mn, max(value) AS mx FROM events)""")
def q_bin_new_column(spark, d):
    e, ctx = _events_value(spark, d)
    return Binning(method="equal_width", output_mode="new_column").fit_transform(e, ctx)[0]


@register("encode_auto", """SELECT o_orderkey, o_orderstatus = 'O' AS "o_orderstatus_O", o_orderstatus = 'P' AS "o_orderstatus_P",
    CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority FROM orders""")
def q_encode_auto(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    ctx = ctx_for(o, {"o_orderstatus": Role.CATEGORICAL, "o_orderpriority": Role.CATEGORICAL}, ids=["o_orderkey"])
    return CategoricalEncoder(method="auto", onehot_max_categories=3).fit_transform(o, ctx)[0]


@register("encode_ordinal_sorted", f"""SELECT o_orderkey, CASE WHEN p IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY p NULLS LAST) - 1 AS INTEGER)
    END AS o_orderpriority FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS p FROM orders)""")
def q_encode_ordinal_sorted(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return CategoricalEncoder(method="ordinal").fit_transform(o, ctx_for(o, {"o_orderpriority": Role.CATEGORICAL}, ids=["o_orderkey"]))[0]


@register("high_pairs", f"""SELECT 'l_quantity' AS col_a, 'l_q2' AS col_b, round(corr(l_quantity, l_quantity * 2 + l_tax * 100), 6) AS r FROM lineitem""")
def q_high_pairs(spark, d):
    li = V.lineitem_collinear(spark, d)
    f = CorrelationAnalyzer(compute_vif=False).fit(li, ctx_for(li))
    return spark.createDataFrame([(a, b, round(r, 6)) for a, b, r in f.state["high"]], "col_a string, col_b string, r double")


@register("outlier_cap_log", IQR_SQL.format(src="events") + """ SELECT 'outlier_detector' AS step, 'value' AS column_name, event_id AS row_id,
    round(value, 6) AS original, round(least(greatest(value, lo), hi), 6) AS new FROM t WHERE flag""")
def q_outlier_cap_log(spark, d):
    e, ctx = _events_value(spark, d)
    e = e.withColumn(ROW_ID, F.col("event_id"))
    step = OutlierDetector(method="iqr", action="cap")
    log = changelog.cell_diff(e, step.name, step.fit(e, ctx).exprs(e, ctx))
    return log.select("step", F.col("column").alias("column_name"), "row_id", r6(F.col("original").cast("double")).alias("original"),
                      r6(F.col("new").cast("double")).alias("new"))


@register("change_detail", f"""SELECT 'encoding_normalizer' AS step, 'text' AS column_name, doc_id AS row_id, text AS original,
    {_enc_sql('text')} AS new FROM {V.DOCUMENTS_DIRTY_SQL} WHERE text IS DISTINCT FROM {_enc_sql('text')}""")
def q_change_detail(spark, d):
    t, ctx = _docs(spark, d)
    t = t.withColumn(ROW_ID, F.col("doc_id"))
    log = changelog.cell_diff(t, LOG_STEP.name, LOG_STEP.fit(t, ctx).exprs(t, ctx))
    return changelog.change_detail(log, [LOG_STEP.name]).select("step", F.col("column").alias("column_name"), "row_id", "original", "new")


@register("table_summary", f"""SELECT column_name, dtype, (SELECT count(*) FROM {G}) AS rows, 5 AS cols,
    (SELECT count(*) - count(value) FROM {G}) AS total_missing FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'),
    ('user_id', 'bigint'), ('event_type', 'string'), ('value', 'double')) AS v(column_name, dtype)""")
def q_table_summary(spark, d):
    s = table_summary(V.events_gaps(spark, d))
    return s.select("rows", "cols", "total_missing", F.explode("dtypes").alias("t")).select(
        F.col("t.column").alias("column_name"), F.col("t.dtype").alias("dtype"), "rows", "cols", "total_missing")


@register("step_snapshots", f"""SELECT 0 AS snapshot, count(*) AS rows, count(value) AS filled FROM {G}
    UNION ALL SELECT 1, count(*), count(*) FROM {G}""")
def q_step_snapshots(spark, d):
    from prepwise.plans.chain import REGISTRY, CleaningPipeline
    e, ctx = _gaps(spark, d)
    pipe = CleaningPipeline(enabled_steps={c.name: c.name == "missing_handler" for c in REGISTRY},
                            step_configs={"missing_handler": {"strategy": "mean"}})
    out = None
    for i, snap in enumerate(pipe.run_step_by_step(e, ctx)):
        one = snap.agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("filled")).withColumn("snapshot", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return out


# ============================================================ the whole default run
@register("clean_events", """WITH e AS (SELECT * REPLACE (round_even(value * 100, 0) / 100 AS value) FROM events),
    q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM e)
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS ts, user_id, event_type, value, props,
           value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS value_outlier FROM e, q""")
def q_clean_events(spark, d):
    from prepwise.plans.chain import CleaningPipeline
    from prepwise.sources.readers import prepare
    e, ctx = prepare(table(spark, d, "events"), order_by=["event_id"])
    fp = CleaningPipeline().fit(e, ctx)
    return nodrop(fp.result)


# events in a bad state: odd names, padded and full-width text, units, percentages, gaps, a constant, doubled rows
DIRTY_EVENTS_SQL = """(SELECT event_id, ts, event_type AS kind, CAST(CAST(trunc(abs(value)) AS BIGINT) % 50 AS DOUBLE) AS weight, (event_id % 90 + 5) / 100.0 AS share,
    CASE WHEN event_id % 11 > 0 THEN value END AS value FROM events WHERE event_id % 97 > 0)"""


def _dirty_events(spark, d):
    e = table(spark, d, "events")
    k = F.col("event_id")
    e = e.select(k.alias("event  id"), F.date_format("ts", "yyyy/MM/dd HH:mm").alias("ts"),
                 F.concat(F.lit("\u3000 "), F.regexp_replace("event_type", "i", "\uff49"), F.lit(" ")).alias(" kind"),
                 F.concat((F.abs("value").cast("long") % 50).cast("string"), F.when(k % 3 == 0, " kg").otherwise("kg")).alias("weight"),
                 F.concat((k % 90 + 5).cast("string"), F.lit("%")).alias("share"), F.when(k % 11 > 0, F.col("value")).alias("value"), F.lit("same").alias("const"))
    return e.unionByName(e.where("`event  id` % 97 = 0"))


def _fence_sql(c):
    return f"coalesce({c} < q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1]) OR {c} > q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1]), false)"


@register("clean_dirty_events", f"""SELECT event_id, strftime(ts, '%Y-%m-%d') AS ts, kind, weight AS "weight(kg)", round(share, 2) AS share,
    round(coalesce(value, mid), 6) AS value, {_fence_sql("weight")} AS "weight(kg)_outlier", {_fence_sql("share")} AS share_outlier, {_fence_sql("value")} AS value_outlier
    FROM {DIRTY_EVENTS_SQL}, (SELECT quantile_cont(weight, [0.25, 0.75]) AS q_weight, quantile_cont(share, [0.25, 0.75]) AS q_share,
        quantile_cont(value, [0.25, 0.75]) AS q_value, quantile_cont(value, 0.5) AS mid FROM {DIRTY_EVENTS_SQL})""")
def q_clean_dirty_events(spark, d):
    """The whole default run where nearly every step has work."""
    from prepwise.plans.chain import CleaningPipeline
    from prepwise.sources.readers import prepare
    e, ctx = prepare(_dirty_events(spark, d))
    out = nodrop(CleaningPipeline(step_configs={"datetime_standardizer": {"current_year": 2024}}).fit(e, ctx).result)
    return out.withColumns({"share": F.round("share", 2), "value": r6(F.col("value"))})


from prepwise.plans import catalog_runs  # noqa: E402,F401 — registers its queries here
