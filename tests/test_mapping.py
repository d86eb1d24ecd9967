import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from tablepact.contract import ContractError, parse_contract
from tablepact.operators import mapping, quality


def contract(*fields, **ds):
    cols = [{"tgt_nm": f["src_nm"], **f} for f in fields]
    return parse_contract({"ds": {"nm": "t", "cols": cols, **ds}})


def test_swapped_names_and_passed_through_columns(spark, rows):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    swap = contract({"src_nm": "a", "tgt_nm": "b"}, {"src_nm": "b", "tgt_nm": "a"})
    out = mapping.map_columns(df, swap)
    assert out.columns == ["b", "a", "c"]
    assert out.first().asDict() == {"b": 1, "a": 2, "c": 3}
    assert mapping.map_columns(df, swap, keep_extra=False).columns == ["b", "a"]


def test_rename_and_cast_of_one_field_both_apply(spark):
    df = spark.createDataFrame([("1",)], "a string")
    out = mapping.map_columns(df, contract({"src_nm": "a", "tgt_nm": "b", "tgt_dtype": "bigint"}))
    assert out.dtypes == [("b", "bigint")]


def test_bad_casts(spark, rows):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("99999999999",)], "a string")
    to_int = contract({"src_nm": "a", "tgt_dtype": "int"})
    assert rows(mapping.map_columns(df, to_int)) == [(1,), (None,), (None,), (None,)]
    rejecting = mapping.map_columns(df, to_int, on_cast_error="reject")
    tagged = quality.tag_rows(rejecting, [])
    assert rows(tagged) == [(1, None), (None, "a not castable"), (None, "a not castable"),
                            (None, None)]
    with pytest.raises(PySparkException):
        mapping.map_columns(df, to_int, on_cast_error="fail").collect()


def test_decimal_overflow_is_null(spark):
    df = spark.createDataFrame([("123456.789",), ("1.005",)], "a string")
    out = mapping.map_columns(df, contract({"src_nm": "a", "tgt_dtype": "decimal(5,2)"}))
    assert [r.a for r in out.collect()] == [None, Decimal("1.01")]


def test_dates_and_timestamps_with_and_without_format(spark):
    df = spark.createDataFrame(
        [("05/01/2020", "2020-01-05", "2020-01-05 10", dt.date(2020, 1, 5)), ("?", "?", "?", None)],
        "a string, b string, c string, d date",
    )
    out = mapping.map_columns(
        df,
        contract(
            {"src_nm": "a", "tgt_dtype": "date", "src_fmt": "dd/MM/yyyy"},
            {"src_nm": "b", "tgt_dtype": "date"},
            {"src_nm": "c", "tgt_dtype": "timestamp_ntz", "src_fmt": "yyyy-MM-dd HH"},
            {"src_nm": "d", "tgt_dtype": "timestamp_ntz", "src_fmt": "ignored for dates"},
        ),
    )
    day = dt.date(2020, 1, 5)
    first, second = out.collect()
    assert tuple(first) == (day, day, dt.datetime(2020, 1, 5, 10), dt.datetime(2020, 1, 5))
    assert tuple(second) == (None, None, None, None)


def test_added_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, old string")
    added = parse_contract(
        [
            {"source_field": "-", "target_field": "t", "target_type": "decimal(5,2)"},
            {"source_field": "-", "target_field": "old", "target_type": "string"},
            {"source_field": None, "target_field": "e", "target_type": "int", "expr": "a + 1"},
            {"source_field": "t2", "target_field": "t2", "change_type": "added"},
        ]
    )
    out = mapping.map_columns(df, added)
    assert out.dtypes[1:] == [("t", "decimal(5,2)"), ("old", "string"), ("e", "int"),
                              ("t2", "string")]
    assert tuple(out.first()) == (1, None, None, 2, None)


def test_missing_source_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    two = contract({"src_nm": "a"}, {"src_nm": "z", "tgt_dtype": "date"})
    assert mapping.map_columns(df, two).columns == ["a"]
    assert mapping.map_columns(df, two, missing="null").dtypes == [("a", "int"), ("z", "date")]
    with pytest.raises(ContractError, match="'z'"):
        mapping.map_columns(df, two, missing="raise")


def test_clashing_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ContractError, match="twice"):
        mapping.map_columns(df, contract({"src_nm": "a", "tgt_nm": "b"}))


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    out = mapping.map_columns(df, contract({"src_nm": "a.b", "tgt_nm": "x.y", "nullable": False}))
    assert out.columns == ["x.y", "c`d"]
    rules = quality.compile_rules(contract({"src_nm": "x.y", "nullable": False}))
    assert quality.valid_rows(quality.tag_rows(out, rules)).count() == 1


def test_lenient_falls_back_to_text(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5), "7", "x")], "d date, n string, m string")
    out = mapping.lenient_mapping(
        df,
        contract(
            {"src_nm": "d", "tgt_dtype": "int"},
            {"src_nm": "n", "tgt_dtype": "int"},
            {"src_nm": "m", "tgt_dtype": "money"},
            {"src_nm": "z", "tgt_dtype": "int"},
        ),
    ).apply(df)
    assert out.dtypes == [("d", "string"), ("n", "int"), ("m", "string")]
    assert tuple(out.first()) == ("2020-01-05", 7, "x")


def test_batch_times(spark):
    naive = dt.datetime(2025, 11, 14, 8, 30)
    aware = dt.datetime(2025, 11, 14, 10, 30, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert mapping.load_partition(naive) == mapping.load_partition(aware) == ("2025-11-14", "08")
    df = spark.range(1)
    stamps = [mapping.with_ingest_ts(df, m).selectExpr("unix_micros(ingest_ts)").first()[0]
              for m in (naive, aware)]
    assert stamps == [1763109000000000] * 2
    dated = mapping.add_missing_update_columns(df.withColumn("u", df.id), ["u", "v"], naive)
    assert dated.columns == ["id", "u", "v"]
