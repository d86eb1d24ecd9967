import pytest
from pyspark.sql import types as T

from tablepact.functions.types import UnknownType, decimal_parts, parse_type, type_text


@pytest.mark.parametrize(
    "text,expected",
    [
        ("string", T.StringType()),
        ("decimal(12,2)", T.DecimalType(12, 2)),
        (" decimal(12, 2) ", T.DecimalType(12, 2)),
        ("int", T.IntegerType()),
        ("bigint", T.LongType()),
        ("double", T.DoubleType()),
        ("timestamp", T.TimestampType()),
        ("array<int>", T.ArrayType(T.IntegerType())),
        ("struct<a:int>", T.StructType([T.StructField("a", T.IntegerType())])),
        ("StringType()", T.StringType()),
        ("StringType", T.StringType()),
        ("LongType()", T.LongType()),
        ("DecimalType(10,2)", T.DecimalType(10, 2)),
        ("TimestampNTZType()", T.TimestampNTZType()),
    ],
)
def test_parse_type(spark, text, expected):
    assert parse_type(text) == expected


@pytest.mark.parametrize("text", ["money", "a int", "decimal(99,2)", "MoneyType()"])
def test_unknown_types_are_errors(spark, text):
    with pytest.raises(UnknownType):
        parse_type(text)


def test_text_round_trip(spark):
    for data_type in (T.DecimalType(12, 2), T.MapType(T.StringType(), T.LongType()), T.DateType()):
        assert parse_type(type_text(data_type)) == data_type
    assert decimal_parts(T.DecimalType(12, 2)) == (12, 2)
    assert decimal_parts(T.StringType()) == (None, None)
