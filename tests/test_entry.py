"""Driver contract: entry runs, every query runs at sf0.001, twins agree on a sample."""
import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", ["outlier_iqr_flag", "dup_keep_first", "na_tokens", "type_roles",
                                  "text_strip_pattern", "date_standardize", "unit_range", "fill_interpolate",
                                  "bin_freq", "encode_label", "corr_spearman", "profile", "id_columns"])
def test_twin_agrees_at_smallest_scale(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    a = E.queries()[name](spark, SF).toPandas()
    b = con.execute(E.oracle_sql()[name]).df()
    assert sorted(a.columns) == sorted(b.columns) and len(a) == len(b)
    cols = sorted(a.columns)

    def canon(df):
        def norm(v):
            if v is None or (isinstance(v, float) and v != v):
                return "∅"
            if isinstance(v, float):
                return str(int(v)) if v.is_integer() else repr(round(v, 9))
            return str(v.item() if hasattr(v, "item") else v)
        return sorted("|".join(norm(r[c]) for c in cols) for r in df.to_dict("records"))
    assert canon(a) == canon(b)
