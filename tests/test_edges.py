"""Less-travelled paths: encoder placement and unknowns, ID name modes, typed dates."""
from prepwise.context import Context, Role
from prepwise.operators.dates import DatetimeStandardizer
from prepwise.operators.detect import IdColumnDetector
from prepwise.operators.features import CategoricalEncoder


def test_onehot_in_place_drop_first_and_null_all_false(frame):
    df = frame([(1, "b", 9), (2, "a", 8), (3, None, 7), (4, "c", 6)], "k int, c string, z int")
    ctx = Context.from_schema(df).with_(roles={**Context.from_schema(df).roles, "c": Role.CATEGORICAL})
    out, ctx2 = CategoricalEncoder(method="onehot").fit_transform(df, ctx)
    assert out.columns[:4] == ["k", "c_b", "c_c", "z"]
    row = out.where("k = 3").first()
    assert row["c_b"] is False and row["c_c"] is False
    assert ctx2.roles["c_b"] == Role.BOOLEAN and "c" not in ctx2.roles


def test_ordinal_given_order_and_sorted_codes(frame):
    df = frame([("lo",), ("hi",), ("mid",), ("other",), (None,)], "c string")
    ctx = Context.from_schema(df).with_(roles={"c": Role.CATEGORICAL})
    out, _ = CategoricalEncoder(method="ordinal", ordinal_order={"c": ["lo", "mid", "hi"]}).fit_transform(df, ctx)
    assert [r[0] for r in out.orderBy("_row_id").select("c").collect()] == [0, 2, 1, None, None]
    out, _ = CategoricalEncoder(method="ordinal").fit_transform(df, ctx)
    assert [r[0] for r in out.orderBy("_row_id").select("c").collect()] == [1, 0, 2, 3, -1]


def test_id_name_substring_versus_token(frame):
    df = frame([(i % 3, i % 2) for i in range(30)], "notes int, row_no int")
    sub = IdColumnDetector(check_sequential=False).fit(df)
    tok = IdColumnDetector(check_sequential=False, match="token").fit(df)
    assert set(sub.state["ids"]) == {"notes", "row_no"}      # "no" inside "notes"
    assert set(tok.state["ids"]) == {"row_no"}


def test_dates_typed_output_and_unparseable_column_left_alone(frame):
    df = frame([("2024/3/5",), ("bad",)], "start_time string")
    out, _ = DatetimeStandardizer(as_type="date").fit_transform(df)
    assert str(out.schema["start_time"].dataType) == "DateType()"
    df = frame([("x",), ("y",)], "end_note string")
    out, _ = DatetimeStandardizer().fit_transform(df)
    assert [r[0] for r in out.orderBy("_row_id").select("end_note").collect()] == ["x", "y"]
