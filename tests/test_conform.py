"""Rows of any type against the schema of a table."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillet.constants import DATA_ISSUE_CODES
from rillet.functions.convert import converted
from rillet.operators import conform
from rillet.operators.conform import TableRules, conformed, first_error
from rillet.operators.validate import failure_outcome

TARGET = "id bigint NOT NULL, name string NOT NULL, price decimal(6,2), at timestamp_ntz, flag boolean, tags array<int>, doc variant, n int"
RIGHT = """'7' AS id, 'a' AS name, '1.235' AS price, '2024-01-01 10:00:00' AS at, '1' AS flag, '[1,2]' AS tags, '{"a":1}' AS doc, 3 AS n"""


@pytest.fixture
def rules(spark):
    return TableRules(T.StructType.fromDDL(TARGET), not_empty=["name"], max_length={"name": 8}, max_row_bytes=400)


def test_right_row(spark, rules):
    row = conformed(spark.sql(f"SELECT {RIGHT}"), rules).selectExpr("row.*", "errors", "extra_columns", "to_json(row.doc) AS json").first()
    assert (row["id"], row["name"], str(row["price"]), row["flag"], row["tags"], row["json"], row["n"]) == (7, "a", "1.24", True, [1, 2], '{"a":1}', 3)
    assert row["errors"] == [] and row["extra_columns"] == []


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ("CAST(NULL AS STRING) AS id", [("NULL_VALUE", "id")]),
        ("'' AS name", [("NULL_OR_EMPTY_STRING", "name")]),
        ("'123456789' AS name", [("INVALID_VALUE_ROW", "name")]),
        ("'x' AS id", [("INVALID_FORMAT_ROW", "id")]),
        ("'99999999999999999999' AS id", [("INVALID_VALUE_ROW", "id")]),
        ("'12345.6' AS price", [("INVALID_VALUE_ROW", "price")]),
        ("'1,5' AS price", [("INVALID_FORMAT_ROW", "price")]),
        ("'yesterday' AS at", [("INVALID_FORMAT_ROW", "at")]),
        ("'true' AS flag", [("INVALID_FORMAT_ROW", "flag")]),
        ("'[1,' AS tags", [("INVALID_FORMAT_ROW", "tags")]),
        ("'{' AS doc", [("INVALID_FORMAT_ROW", "doc")]),
        ("map('a', 1) AS n", [("UNKNOWN_DATA_TYPE", "n")]),
        ("3000000000L AS n", [("INVALID_VALUE_ROW", "n")]),
        ("true AS at", [("UNKNOWN_DATA_TYPE", "at")]),
        ("repeat('é', 300) AS other", [("MAX_ROW_SIZE_EXCEEDED", None)]),
        ("'' AS name, 'x' AS id", [("INVALID_FORMAT_ROW", "id"), ("NULL_OR_EMPTY_STRING", "name")]),
    ],
)
def test_wrong_rows(spark, rules, change, expected):
    changed = spark.sql(f"SELECT {change}").columns
    kept = ", ".join(f"`{name}`" for name in rules.schema.names if name not in changed)
    spark.sql(f"SELECT {RIGHT}").createOrReplaceTempView("right_row")
    row = conformed(spark.sql(f"SELECT {kept}, {change} FROM right_row"), rules).first()
    assert [(e["code"], e["name"]) for e in row["errors"]] == expected
    assert {code for code, _ in expected} <= set(DATA_ISSUE_CODES)


def test_all_codes_are_made():
    source = Path(conform.__file__).read_text()
    assert all(f'"{code}"' in source for code in DATA_ISSUE_CODES)


def test_missing_and_extra_columns(spark, rules):
    row = conformed(spark.sql("SELECT '1' AS id, 5 AS more, CAST(NULL AS INT) AS none"), rules).first()
    assert [(e["code"], e["name"]) for e in row["errors"]] == [("NULL_VALUE", "name")] and row["extra_columns"] == ["more"]
    rows = conformed(spark.sql("SELECT '1' AS id, 'a' AS name, 5 AS more"), rules)
    outcome = rows.select(failure_outcome(F.col("extra_columns"), first_error())).first()[0]
    assert outcome == "evolve"
    wrong = conformed(spark.sql("SELECT 'x' AS id, 'a' AS name"), rules)
    assert wrong.select(failure_outcome(F.col("extra_columns"), first_error())).first()[0] == "bad"
    assert conformed(spark.createDataFrame([], "id string"), rules).collect() == []


@pytest.mark.parametrize(
    ("value", "target", "expected"),
    [
        ("array('1', 'x', null)", "array<int>", [1, None, None]),
        ("named_struct('a', '1', 'gone', 2)", "struct<a:int,b:string>", {"a": 1}),
        ("array(named_struct('a', array(1.5, 2.5)))", "array<struct<a:array<int>>>", [{"a": [1, 2]}]),
        ("map('1', '2024-01-01')", "map<int,date>", {"1": "2024-01-01"}),
        ("'{\"a\":1,\"a\":2}'", "struct<a:int>", {"a": 2}),
        ("'[[1],[2,3]]'", "array<array<int>>", [[1], [2, 3]]),
        ("named_struct('a', array(1, null))", "variant", {"a": [1, None]}),
        ("array(named_struct('a', 1))", "string", '[{"a":1}]'),
        ("parse_json('{\"a\":[1]}')", "struct<a:array<int>>", {"a": [1]}),
        ("CAST(NULL AS struct<a:string>)", "struct<a:int>", None),
    ],
)
def test_nested_values(spark, value, target, expected):
    rows = spark.sql(f"SELECT {value} AS v")
    kind = T.StructType.fromDDL(f"t {target}")[0].dataType
    sql = converted("v", rows.schema["v"].dataType, kind)
    found = rows.selectExpr(f"{sql} AS t")
    assert found.schema["t"].dataType.simpleString() == kind.simpleString()
    text = found.selectExpr("t" if target == "string" else "to_json(t)").first()[0]
    assert (text if target == "string" or text is None else json.loads(text)) == expected


def test_types_that_never_fit(spark):
    kind = lambda ddl: T.StructType.fromDDL(f"t {ddl}")[0].dataType
    for source, target in (("int", "boolean"), ("map<int,int>", "variant"), ("array<int>", "map<int,int>"), ("array<boolean>", "array<int>"),
                           ("struct<a:boolean>", "struct<a:date>"), ("date", "int")):
        assert converted("v", kind(source), kind(target)) is None
