"""Registered queries: one per operator, columns of the contracts, twins at the smallest scale."""
import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": ["doc_id", "fingerprint", "component_id"], "op2_": ["page_id", "host", "path", "rule", "verdict"],
    "op4_": ["vec_id", "n_links", "component_id", "kept"], "op5_": ["doc_id", "held_out", "score", "predicted"],
    "op7_": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op9_": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], "op10_": ["doc_id", "size", "source_size", "target", "taken"],
    "op11_": ["page_id", "url", "text", "n_chars"],
    "op12_": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13_": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


def test_one_query_per_operator():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("prefix", COLUMNS)
def test_contract_columns(spark, prefix):
    name = next(q for q in E.queries() if q.startswith(prefix))
    assert E.queries()[name](spark, SF).columns[: len(COLUMNS[prefix])] == COLUMNS[prefix]


@pytest.mark.parametrize("prefix", ["op2_", "op6_", "op9_", "op11_", "op12_", "op13_"])
def test_twins(spark, prefix):
    name = next(q for q in E.queries() if q.startswith(prefix))
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name]).df()
    got = E.queries()[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    cell = lambda x: "" if pd.isna(x) else str(int(x)) if isinstance(x, float) and x.is_integer() else str(x)    # noqa: E731 — longs with nulls come as floats
    rows = lambda df: sorted(tuple(cell(x) for x in r) for r in df[sorted(want.columns)].itertuples(index=False))
    assert rows(got) == rows(want)
