import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidewell.model import CHAT, FAMILIES, MARKETING, SALES, find_spec, schema_from_names
from tidewell.model.payloads import sales_record
from tidewell.model.specs import TableSpec
from tidewell.operators.coerce import coerce, split_by_key, stringify_nested
from tidewell.operators.infer import infer_schema, parse_records, spec_from_sample, spec_from_schema, widen_union

NUMBERS = TableSpec("t", "numbers", (("id", "int"), ("i", "int"), ("l", "long"), ("d", "double"), ("b", "flag")), "id")


def test_declared_tables():
    assert [len(f) for f in FAMILIES.values()] == [12, 8, 4]
    assert find_spec("sales", "Opportunity").table == "bronze_sales_opportunity"
    assert SALES["Opportunity"].struct()["IsWon"].dataType == T.IntegerType()
    assert CHAT["channels"].struct()["created"].dataType == T.LongType()
    assert {s.modified for s in SALES.values()} == {("LastModifiedDate",)}  # of the raw record, declared or not
    assert CHAT["messages"].keys == ["channel_id", "message_ts"]
    assert MARKETING["pipelines"].key == "id"
    with pytest.raises(KeyError):
        find_spec("sales", "Nothing")


def test_generic_type_names():
    schema = schema_from_names({"a": "INT", "b": "list", "c": "datetime", "d": "whatever", "e": "bool"})
    assert schema.simpleString() == "struct<a:bigint,b:string,c:timestamp,d:string,e:int>"


# value in the export -> int, long, double, flag
CASES = [
    (None, None, None, None, None),
    ("7", 7, 7, 7.0, 0),
    (" 42 ", 42, 42, 42.0, 0),
    ("3.7", 0, 0, 3.7, 0),
    (3.7, 3, 3, 3.7, 0),
    (-3.7, -3, -3, -3.7, 0),
    ("abc", 0, 0, 0.0, 0),
    ("", 0, 0, 0.0, 0),
    (99999999999, 0, 99999999999, 99999999999.0, 0),
    ("1e3", 0, 0, 1000.0, 0),
    ("1d", 0, 0, 0.0, 0),
    ("inf", 0, 0, math.inf, 0),
    (12, 12, 12, 12.0, 0),
    (True, 1, 1, 1.0, 1),
    (False, 0, 0, 0.0, 0),
    ("true", 0, 0, 0.0, 1),
    ("True", 0, 0, 0.0, 1),
    ("TRUE", 0, 0, 0.0, 0),
    ("1", 1, 1, 1.0, 0),
    ("yes", 0, 0, 0.0, 0),
    (1, 1, 1, 1.0, 1),
    (1.0, 1, 1, 1.0, 1),
    (0, 0, 0, 0.0, 0),
    ([1], 0, 0, 0.0, 0),
    ({"a": 1}, 0, 0, 0.0, 0),
]


def test_coerce_values_of_any_json_type(spark):
    texts = spark.createDataFrame(
        [(json.dumps({"id": n, "i": v, "l": v, "d": v, "b": v, "extra": 1}),) for n, (v, *_) in enumerate(CASES)],
        "value string",
    )
    raw = "id variant, i variant, l variant, d variant, b variant"
    out = coerce(texts.select(F.inline(F.array(F.from_json("value", raw)))), NUMBERS)
    assert out.columns == NUMBERS.names
    got = rows(out, "id")
    assert got == [(n, *want) for n, (_, *want) in enumerate(CASES)]


def test_coerce_nan(spark):
    frame = spark.createDataFrame([(1, "nan"), (2, "NaN")], "id int, d string")
    assert all(math.isnan(r["d"]) for r in coerce(frame, NUMBERS).collect())
    frame = spark.createDataFrame([(1, float("nan")), (2, float("inf"))], "id int, i double")
    assert rows(coerce(frame, NUMBERS).select("i")) == [(0,), (0,)]


@pytest.mark.parametrize(
    "source, values, want",
    [
        ("string", ["7", " 42 ", "3.7", "abc", "", None], [7, 42, 0, 0, 0, None]),
        ("double", [3.7, 1e12, None], [3, 0, None]),
        ("bigint", [5, 99999999999, None], [5, 0, None]),
        ("boolean", [True, False, None], [1, 0, None]),
        ("array<int>", [[1], None], [0, None]),
    ],
)
def test_coerce_int_from_spark_types(spark, source, values, want):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"id int, i {source}")
    assert [r["i"] for r in coerce(frame, NUMBERS).orderBy("id").collect()] == want


@pytest.mark.parametrize(
    "source, values, want",
    [
        ("string", ["true", "True", "1", "yes", None], [1, 1, 0, 0, None]),
        ("int", [1, 0, 2, None], [1, 0, 0, None]),
        ("boolean", [True, False, None], [1, 0, None]),
    ],
)
def test_coerce_flag_from_spark_types(spark, source, values, want):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"id int, b {source}")
    assert [r["b"] for r in coerce(frame, NUMBERS).orderBy("id").collect()] == want


def test_text_keeps_nested_json_and_nulls(spark):
    record = {"Id": 5, "Name": {"a": None, "b": [1]}, "Website": True, "Phone": None}
    raw = parse_records(spark.createDataFrame([(json.dumps(record),)], "value string"), sales_record(SALES["Account"]))
    row = coerce(raw, SALES["Account"]).first()
    assert row["Id"] == "5" and row["Website"] == "true" and row["Phone"] is None and row["Type"] is None
    assert json.loads(row["Name"]) == {"a": None, "b": [1]}


def test_stringify_nested_keeps_null_fields(spark):
    frame = spark.createDataFrame([(1, (None, 2), [1, 2])], "id int, s struct<a:int,b:int>, l array<int>")
    assert rows(stringify_nested(frame)) == [(1, '{"a":null,"b":2}', "[1,2]")]


def test_split_by_key(spark):
    frame = spark.createDataFrame([("a",), ("",), (None,)], "id string")
    good, bad = split_by_key(frame, "id")
    assert (good.count(), bad.count()) == (1, 2)


def _texts(spark, *records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def test_infer_widens_and_falls_back_to_text(spark):
    texts = _texts(
        spark,
        {"z": 1, "num": 1, "clash": 1, "none": None, "flag": True, "nest": {"x": 1}, "list": [1]},
        {"z": 2, "num": 3.5, "clash": "x", "none": None, "big": 123456789012345678901234, "one": 1.0},
    )
    schema = infer_schema(texts)
    assert schema.names == sorted(schema.names)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "z": "bigint", "num": "double", "clash": "string", "none": "string", "flag": "boolean",
        "nest": "struct<x:bigint>", "list": "array<bigint>", "big": "string", "one": "double",
    }
    got = {r["z"]: r for r in parse_records(texts, schema).collect()}
    assert got[1]["clash"] == "1" and got[2]["clash"] == "x" and got[1]["num"] == 1.0
    assert got[2]["big"] == "123456789012345678901234"


def test_infer_odd_field_names(spark):
    schema = infer_schema(_texts(spark, {"a b": 1, "OBJECT<x": "s"}))
    assert sorted(schema.names) == ["OBJECT<x", "a b"]


def test_spec_for_unknown_object(spark):
    spec = spec_from_sample(_texts(spark, {"Id": "1", "n": 2, "f": 1.5, "ok": True, "l": [1]}), "sales", "Custom", "Id")
    assert spec.table == "bronze_sales_custom"
    assert dict(spec.columns) == {"Id": "text", "n": "long", "f": "double", "ok": "flag", "l": "text"}
    assert spec.names[0] == "Id"
    assert spec_from_schema("sales", "X", T.StructType([T.StructField("Id", T.StringType())]), "Id").key == "Id"


def test_widen_union(spark):
    a = spark.createDataFrame([(1, 2, [1], None)], "id int, v int, n array<int>, e void")
    b = spark.createDataFrame([(3, 4.5, "x")], "id bigint, v double, n string")
    out = widen_union(a, b)
    assert out.schema.simpleString() == "struct<e:string,id:bigint,n:string,v:double>"
    assert rows(out, "id") == [(None, 1, "[1]", 2.0), (None, 3, "x", 4.5)]
