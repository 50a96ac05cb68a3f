import pytest
from pyspark.sql import types as T

from millrace.errors import SchemaMismatch, TypeParseError
from millrace.sources.tables import TableDef, expect_schema
from millrace.sources.types import parse, parse_type

ROUND = ["UInt8", "Int64", "Nullable(Array(UInt64))".replace("Nullable(Array(UInt64))", "Array(Nullable(UInt64))"), "Map(String, Array(Int32))", "Tuple(a Int32, b String)", "Tuple(Int32, String)", "Nested(k String, v Float64)", "LowCardinality(Nullable(String))", "Enum8('a' = 1, 'b' = -2)", "DateTime64(3, 'UTC')", "DateTime('UTC')", "DateTime", "Decimal(10, 2)", "Decimal64(4)", "FixedString(16)", "SimpleAggregateFunction(sum, Float64)", "Object('json')", "JSON"]


@pytest.mark.parametrize("text", ROUND)
def test_round_trip(text):
    assert str(parse(text)) == text
    assert parse(str(parse(f"  {text} "))) == parse(text)


@pytest.mark.parametrize(
    "text,kind",
    [("UInt64", T.DecimalType(20, 0)), ("Array(Nullable(Int8))", T.ArrayType(T.ByteType(), True)), ("Map(String,UInt32)", T.MapType(T.StringType(), T.LongType(), False)), ("DateTime", T.TimestampNTZType()), ("DateTime('UTC')", T.TimestampType()), ("Decimal256(3)", T.DecimalType(38, 3)), ("Tuple(Int8, x String)", T.StructType([T.StructField("_1", T.ByteType(), False), T.StructField("x", T.StringType(), False)]))],
)
def test_spark_types(text, kind):
    assert parse_type(text) == kind


@pytest.mark.parametrize("text", ["Nullable(Map(String, Int8))", "Nullable(Array(Int8))", "Enum8('a' = x)", "Decimal(a, b)", "Array(", "Array", "DateTime64(x)", "Map(String)"])
def test_malformed(text):
    with pytest.raises(TypeParseError):
        parse(text)


def test_unknown_names():
    assert parse_type("Whatever") == T.StringType()
    with pytest.raises(TypeParseError):
        parse("Whatever", strict=True)


def test_table_definition(spark):
    t = TableDef.of("t", {"id": "Int64", "e": "Enum8('x' = 1)", "s": "SimpleAggregateFunction(max, Int32)", "n": "Nullable(String)"}, "id")
    assert t.schema["e"].metadata == {"enum": {"x": 1}} and t.schema["s"].metadata == {"agg": "max"}
    assert not t.schema["id"].nullable and t.schema["n"].nullable
    assert "Int64" in t.render()
    with pytest.raises(SchemaMismatch):
        expect_schema(spark.range(1), t.schema)
