"""Golden cells (FIXTURES §C) on tiny inline frames."""
import pytest

from prepwise.context import Context, Role
from prepwise.operators.dates import DatetimeStandardizer
from prepwise.operators.detect import TypeDetector
from prepwise.operators.features import Binning
from prepwise.operators.missing import MissingHandler
from prepwise.operators.numeric_text import DecimalUnifier, PercentageUnifier, UnitDetector
from prepwise.operators.text_steps import ColumnNameCleaner, EncodingNormalizer
from prepwise.operators.values import ValueReplacer


def col_values(df, c):
    return [r[0] for r in df.orderBy("_row_id").select(f"`{c}`").collect()]


def test_unit_kg_and_wan_yuan(frame):
    df = frame([("100kg",), ("20kg",), ("3kg",)], "x string")
    out, ctx = UnitDetector().fit_transform(df)
    assert "x(kg)" in out.columns and col_values(out, "x(kg)") == [100.0, 20.0, 3.0]
    assert ctx.roles["x(kg)"] == Role.NUMERIC
    df = frame([("500万元",), ("20万元",)], "x string")
    out, _ = UnitDetector().fit_transform(df)
    assert col_values(out, "x(万元)") == [500.0, 20.0]


def test_unit_range_midpoint_and_leftovers(frame):
    # the range is converted but, as a range, does not count towards the 0.6 match share
    df = frame([("100-200kg",), ("1kg",), ("2kg",), ("3kg",), ("4kg",), ("6kg",), ("5",), ("n/a",)], "x string")
    out, _ = UnitDetector().fit_transform(df)
    assert col_values(out, "x(kg)") == [150.0, 1.0, 2.0, 3.0, 4.0, 6.0, 5.0, None]
    df = frame([("100-200kg",), ("1kg",), ("2kg",), ("5",), ("n/a",)], "x string")
    out, _ = UnitDetector().fit_transform(df)
    assert out.columns == df.columns   # 2 of 5 match: column left alone


def test_percent_and_permille(frame):
    df = frame([("50%",), ("5‰",), ("junk",)], "x string")
    out, _ = PercentageUnifier().fit_transform(df)
    assert col_values(out, "x") == [0.5, 0.005, None]
    out, _ = PercentageUnifier(mode="percent").fit_transform(df)
    assert col_values(out, "x") == [50.0, 0.5, None]


def test_dates_three_spellings(frame):
    df = frame([("2024年1月1日",), ("2024/01/01",), ("01-01-2024",)], "d_date string")
    out, _ = DatetimeStandardizer(current_year=2024).fit_transform(df)
    assert col_values(out, "d_date") == ["2024-01-01"] * 3


def test_compact_and_no_year_dates(frame):
    df = frame([("20240101",), ("20240101120000",), ("1月1日",)], "created string")
    out, _ = DatetimeStandardizer(current_year=2024).fit_transform(df)
    assert col_values(out, "created") == ["2024-01-01", "2024-01-01", "2024-01-01"]
    out, _ = DatetimeStandardizer(current_year=2024, output_format="datetime").fit_transform(df)
    assert col_values(out, "created")[1] == "2024-01-01 12:00:00"


def test_missing_tokens(frame):
    df = frame([("N/A",), ("#REF!",), ("不详",), (" ok ",), ("  ",)], "x string")
    out, _ = ValueReplacer().fit_transform(df)
    assert col_values(out, "x") == [None, None, None, " ok ", None]


def test_column_names(frame):
    df = frame([(1, 2, 3, 4, 5)], "` a b ` int, `1st` int, `---` int, `a b` int, `a_b` int")
    out, _ = ColumnNameCleaner().fit_transform(df)
    assert out.columns[:5] == ["a_b_1", "col_1st", "col_2", "a_b_2", "a_b"]


def test_booleans(frame):
    df = frame([("是",), ("否",), ("是",)], "x string")
    out, ctx = TypeDetector().fit_transform(df)
    assert ctx.roles["x"] == Role.BOOLEAN and col_values(out, "x") == [True, False, True]
    df = frame([("T",), ("f",), (None,)], "x string")
    out, ctx = TypeDetector().fit_transform(df)
    assert col_values(out, "x") == [True, False, None]


def test_fullwidth_only(frame):
    df = frame([("ＡＢＣ１２３　，",)], "x string")
    step = EncodingNormalizer(trim_whitespace=False, unicode_normalize=None, replace_smart_quotes=False,
                              collapse_whitespace=False)
    out, _ = step.fit_transform(df)
    assert col_values(out, "x") == ["ABC123 ,"]


@pytest.mark.parametrize("n,q", [(12, 4), (15, 4), (100, 5), (37, 5)])
def test_equal_frequency_matches_pandas(frame, n, q):
    import pandas as pd
    df = frame([(float(i % 13),) for i in range(n)], "v double")
    ctx = Context.from_schema(df).with_(roles={"v": Role.NUMERIC})
    out, _ = Binning(method="equal_freq", bins=q, output_mode="new_column").fit_transform(df, ctx)
    got = [r[0] for r in out.orderBy("_row_id").select("v_bin").collect()]
    s = pd.Series([float(i % 13) for i in range(n)])
    want = pd.qcut(s.rank(method="first"), q, labels=False).tolist()
    assert got == want


def test_rounding_half_even(frame):
    df = frame([(1.015,), (2.5,)], "v double")
    ctx = Context.from_schema(df).with_(roles={"v": Role.NUMERIC})
    out, _ = DecimalUnifier(mode="fixed", fixed_places=2).fit_transform(df, ctx)
    assert col_values(out, "v") == [1.01, 2.5]


def test_interpolation(frame):
    df = frame([(None,), (1.0,), (None,), (3.0,), (None,)], "v double")
    ctx = Context.from_schema(df).with_(roles={"v": Role.NUMERIC})
    out, _ = MissingHandler(strategy="interpolate").fit_transform(df, ctx)
    assert col_values(out, "v") == [None, 1.0, 2.0, 3.0, 3.0]
