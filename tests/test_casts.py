import pytest
from pyspark.sql import functions as F

from tablepact.functions.casts import parse_date, try_cast_text
from tablepact.functions.types import parse_type

TEXTS = [
    "1", " 1 ", "+1", "-1", "1.", "1.5", ".5", "-.5e1", "1e3", "1E-2", "1e", "0x1p3", "0x10",
    "NaN", "nan", "Infinity", "-Infinity", "inf", "+INF", "1d", "1.5D", "1f", "2F", "1L", "",
    " ", "\t1\n", "\x00 7 \x1f", "1\n", "1 2", "1_000", "1,000", "--1", "999999999999",
    "99999999999999999999", "١٢", "９", " 1", "1 ", "true", "TRUE", "T",
    " tRue ", "f", "yes", "y", "NO", "n", "on", "off", "0", "00", "x", "n/a", "-", "+", ".", "e",
    "null", "abc", "\x7f7", "Nan7", "2020-01-05", "2020-01-05 10:00:00", None,
]


@pytest.mark.parametrize(
    "name",
    ["tinyint", "smallint", "int", "bigint", "decimal(12,2)", "decimal(38,0)", "float", "double",
     "boolean", "date", "timestamp_ntz", "string"],
)
def test_the_shortcut_never_changes_a_cast(spark, name):
    df = spark.createDataFrame([(t,) for t in TEXTS], "s string")
    target = parse_type(name)
    plain, guarded = F.col("s").try_cast(target), try_cast_text(F.col("s"), target)
    same = plain.eqNullSafe(guarded)
    assert df.filter(~same).select("s", plain, guarded).collect() == []
    assert df.filter(plain.isNotNull()).count() > 0


@pytest.mark.parametrize("fmt", ["dd/MM/yyyy", "yyyyMMdd", "d MMM yyyy", "MMM", "[yyyy]MMM", "yy"])
def test_dates_by_format(spark, fmt):
    texts = ["05/01/2020", "20200105", "5 Jan 2020", "Jan", "2020", "20", "n/a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain, guarded = F.try_to_date("s", fmt), parse_date(F.col("s"), fmt)
    assert df.filter(~plain.eqNullSafe(guarded)).collect() == []
    assert df.filter(plain.isNotNull()).count() > 0
