import datetime as dt
from decimal import Decimal

import pytest

from tablepact.contract import parse_contract
from tablepact.operators import gates, profile, quality
from tablepact.operators.quality import Rule


def rule(column, kind, **details):
    reason = {"range": "outside range", "allowed": "invalid value"}.get(kind, kind)
    return Rule(column, kind, f"{column} {reason}", **details)


@pytest.fixture
def numbers(spark):
    values = [(1, 5.0), (2, 50.0), (3, None), (4, float("nan")), (5, -1.0)]
    return spark.createDataFrame(values, "id int, v double")


def split(df, rules, **options):
    tagged = quality.tag_rows(df, rules, **options)
    return (
        sorted(r.id for r in quality.valid_rows(tagged).collect()),
        sorted((r.id, r.error_reason) for r in quality.rejected_rows(tagged).collect()),
    )


def test_null_policies(numbers):
    within = [rule("v", "range", minimum=0, maximum=10)]
    out = "v outside range"
    assert split(numbers, within) == ([1], [(2, out), (3, out), (4, out), (5, out)])
    assert split(numbers, within, null_policy="pass") == ([1, 3], [(2, out), (4, out), (5, out)])
    assert split(numbers, within, null_policy="drop") == ([1], [(2, out), (4, out), (5, out)])


def test_an_earlier_reject_wins_over_a_drop(numbers):
    rules = [rule("id", "allowed", allowed=(1, 2)), rule("v", "range", minimum=0)]
    valid, rejected = split(numbers, rules, null_policy="drop")
    assert valid == [1, 2]
    assert [i for i, _ in rejected] == [3, 4, 5]
    valid, rejected = split(numbers, rules[::-1], null_policy="drop")
    assert rejected == [(4, "id invalid value"), (5, "v outside range")]


def test_bounds_may_be_one_sided(numbers):
    assert split(numbers, [rule("v", "range", minimum=0)])[0] == [1, 2, 4]
    assert split(numbers, [rule("v", "range", maximum=10)])[0] == [1, 5]
    assert split(numbers, [rule("v", "range", minimum=0, maximum=0)])[0] == []


def test_nan_is_missing_only_in_fractions(spark, numbers):
    assert split(numbers, [rule("v", "not_null")])[0] == [1, 2, 5]
    texts = spark.createDataFrame([(1, "NaN"), (2, None)], "id int, v string")
    assert split(texts, [rule("v", "not_null")]) == ([1], [(2, "v not_null")])


def test_first_failure_and_all_failures(spark):
    data = [(1, None, 99), (2, "zz", 1), (3, "ab", 99)]
    df = spark.createDataFrame(data, "id int, s string, n int")
    rules = [
        rule("s", "not_null"),
        rule("s", "regex", regex="^a"),
        rule("n", "range", maximum=10),
    ]
    tagged = quality.tag_rows(df, rules, all_reasons=True)
    found = {r.id: (r.error_reason, r.error_reasons) for r in tagged.collect()}
    assert found == {
        1: ("s not_null", ["s not_null", "s regex", "n outside range"]),
        2: ("s regex", ["s regex"]),
        3: ("n outside range", ["n outside range"]),
    }
    with pytest.raises(ValueError):
        quality.tag_rows(tagged, rules)


def test_regex_is_searched_for_and_reads_other_types_as_text(spark):
    df = spark.createDataFrame([(1, 123), (2, 456)], "id int, n int")
    assert split(df, [rule("n", "regex", regex="2")])[0] == [1]


def test_bounds_compare_exactly(spark):
    edge = Decimal("90071992547409931.01")
    df = spark.createDataFrame([(1, edge), (2, edge + Decimal("0.01"))], "id int, d decimal(20,2)")
    assert split(df, [rule("d", "range", maximum="90071992547409931.01")])[0] == [1]
    big = spark.createDataFrame([(1, 2**53), (2, 2**53 + 1)], "id int, n bigint")
    assert split(big, [rule("n", "range", maximum=2**53)])[0] == [1]
    cents = spark.createDataFrame([(1, Decimal("0.01")), (2, Decimal("0.00"))],
                                  "id int, d decimal(12,2)")
    assert split(cents, [rule("d", "range", minimum=0.01, maximum=1000000.0)])[0] == [1]


def test_bounds_on_dates_and_text(spark):
    days = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2021, 1, 1))],
                                 "id int, d date")
    assert split(days, [rule("d", "range", minimum="2020-06-01")])[0] == [2]
    texts = spark.createDataFrame([(1, "9"), (2, "10"), (3, "x")], "id int, s string")
    assert split(texts, [rule("s", "range", minimum=10)])[0] == [2]


def test_allowed_values_of_another_type(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, n int")
    assert split(df, [rule("n", "allowed", allowed=("1", "x"))])[0] == [1]
    assert split(df, [rule("n", "allowed", allowed=("1", "x"))], null_policy="pass")[0] == [1, 3]
    flags = spark.createDataFrame([(1, True), (2, False)], "id int, b boolean")
    assert split(flags, [rule("b", "allowed", allowed=(True,))])[0] == [1]
    texts = spark.createDataFrame([(1, "1"), (2, "2")], "id int, s string")
    assert split(texts, [rule("s", "allowed", allowed=(1,))])[0] == [1]


def test_compiled_rules_follow_contract_order():
    contract = parse_contract(
        {
            "ds": {
                "nm": "t",
                "cols": [
                    {"src_nm": "a", "tgt_nm": "x", "nullable": False, "regex": "^1"},
                    {"src_nm": "b", "tgt_nm": "y", "nullable": True, "regex": " "},
                ],
            }
        }
    )
    assert [r.reason for r in quality.compile_rules(contract)] == ["x null", "x regex"]
    assert [r.kind for r in quality.compile_rules(contract, ["regex"])] == ["regex"]
    with pytest.raises(ValueError):
        quality.compile_rules(contract, ["length"])


def test_empty_input_keeps_the_reject_schema(spark, numbers):
    tagged = quality.tag_rows(numbers.filter("false"), [rule("v", "not_null")])
    rejects = quality.rejected_rows(tagged)
    assert rejects.columns == ["id", "v", "error_reason"] and rejects.count() == 0


def test_batch_level_invalid_counts(spark):
    df = spark.createDataFrame([(1, 1), (9, 1), (9, 9), (None, 9)], "a int, b int")
    rules = [rule("a", "range", minimum=0, maximum=5), rule("b", "allowed", allowed=(1,))]
    assert gates.invalid_count(df, rules, "any").first().invalid_rows == 3
    # Both bounds of a range cannot fail together, so "all" finds nothing.
    assert gates.invalid_count(df, rules, "all").first().invalid_rows == 0
    one_sided = [rule("a", "range", maximum=5), rules[1]]
    assert gates.invalid_count(df, one_sided, "all").first().invalid_rows == 1


def test_gate_edges():
    assert gates.valid_ratio(0, 0).passed is False
    assert gates.valid_ratio(100, 95).passed is True
    assert gates.valid_ratio(1000, 949).passed is False
    assert gates.reject_pct(0, 0).passed is True
    assert gates.reject_pct(100, 5).passed is True
    assert gates.reject_pct(100, 6).passed is False
    assert gates.null_pct(10, 20).value == 2.0
    with pytest.raises(gates.GateFailed, match="null_pct"):
        gates.null_pct(10, 2).enforce()
    assert gates.reconcile(15000, 9912).details()["pct_loss"] == "33.92%"
    assert gates.reconcile(0, 0).details()["pct_loss"] == "0%"


def test_gate_frames_on_empty_input(spark, numbers):
    empty = numbers.filter("false")
    tagged = quality.tag_rows(empty, [rule("v", "not_null")])
    assert tuple(gates.gate_valid_ratio(tagged).first()) == (0, 0.0, 0.95, False)
    assert gates.gate_reject_pct(empty, [rule("v", "not_null")]).first().passed is True
    assert gates.gate_null_pct(empty, ["v"]).first().value == 0.0
    assert gates.rowcount_reconcile(tagged).first().pct_loss == 0.0


def test_profiles(spark, numbers, rows):
    assert rows(profile.profile_nulls(numbers)) == [("id", 5, 0), ("v", 5, 1)]
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert rows(profile.profile_regex(df, {"s": "a"})) == [("s", 3, 1)]
