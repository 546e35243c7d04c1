"""JSON files of several layouts (S3)."""
import json

import pytest

from prepwise.sources.readers import json_layouts, read

ROWS = [{"a": i, "b": f"t{i}", "c": {"d": i}} for i in range(100)]


def lines(rows):
    return "\n".join(json.dumps(r) for r in rows) + "\n"


def test_folder_of_arrays_and_lines(spark, tmp_path):
    (tmp_path / "one.json").write_text("﻿ \n" + json.dumps(ROWS), encoding="utf-8")
    (tmp_path / "two.json").write_text("\n\n" + lines(ROWS), encoding="utf-8")
    (tmp_path / "three.json").write_text(json.dumps(ROWS, indent=2), encoding="utf-8")
    found = {r["file"].rsplit("/", 1)[1]: r["layout"] for r in json_layouts(spark, str(tmp_path)).collect()}
    assert found == {"one.json": "document", "two.json": "lines", "three.json": "document"}
    df = read(spark, str(tmp_path), fmt="json")
    assert df.columns == ["a", "b", "c"]
    assert sorted((r["a"], r["b"], r["c"]["d"]) for r in df.collect()) == sorted((i, f"t{i}", i) for i in range(100) for _ in range(3))


def test_pretty_printed_object_is_one_row(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps(ROWS[7], indent=4))
    rows = read(spark, str(tmp_path / "x.json")).collect()
    assert len(rows) == 1 and rows[0]["a"] == 7 and rows[0]["c"]["d"] == 7


def test_schemas_are_merged(spark, tmp_path):
    (tmp_path / "a.json").write_text(lines([{"n": 1, "t": 5, "s": {"x": 1}, "l": [1]}]))
    (tmp_path / "b.json").write_text(json.dumps([{"n": 1.5, "t": "five", "s": {"y": True}, "l": [2.5], "more": None}]))
    df = read(spark, str(tmp_path), fmt="json")
    assert dict(df.dtypes) == {"n": "double", "t": "string", "s": "struct<x:bigint,y:boolean>", "l": "array<double>", "more": "string"}
    assert sorted((r["n"], r["t"], tuple(r["l"])) for r in df.collect()) == [(1.0, "5", (1.0,)), (1.5, "five", (2.5,))]


def test_single_layouts_and_empty_folder(spark, tmp_path):
    (tmp_path / "a.json").write_text(lines(ROWS[:3]))
    assert read(spark, str(tmp_path / "a.json")).count() == 3
    assert read(spark, str(tmp_path / "a.json"), json_layout="lines").count() == 3
    (tmp_path / "b.json").write_text(json.dumps(ROWS))
    assert read(spark, str(tmp_path / "b.json")).count() == 100 == read(spark, str(tmp_path / "b.json"), json_layout="array").count()
    with pytest.raises(ValueError):
        read(spark, str(tmp_path / "a.json"), json_layout="rows")
