import json

import pytest

from tablepact.contract import ContractError, parse_contract, parse_contract_text

SPECIMEN = {
    "dataset_name": "payments",
    "fields": [
        {
            "field_name": "payment_id",
            "source_field": "ref",
            "target_field": "payment_id",
            "source_type": "string",
            "target_type": "string",
            "nullable": False,
            "primary_key": True,
            "change_type": "renamed",
        },
        {
            "field_name": "amount",
            "source_field": "amount",
            "target_field": "amount",
            "source_type": "decimal(10,2)",
            "target_type": "decimal(12,2)",
            "nullable": False,
            "constraints": {"min": 0.5, "max": 20000.0},
            "change_type": "type_modified",
        },
        {
            "field_name": "direction",
            "source_field": "-",
            "target_field": "direction",
            "source_type": "-",
            "target_type": "string",
            "nullable": False,
            "allowed_values": ["in", "out"],
            "constraints": None,
            "change_type": "added",
        },
    ],
}


@pytest.mark.parametrize("indent", [None, 4])
def test_fields_dialect_on_one_line_or_many(indent):
    contract = parse_contract_text(json.dumps(SPECIMEN, indent=indent))
    key, amount, kind = contract.fields
    assert (key.source, key.target, key.primary_key) == ("ref", "payment_id", True)
    assert (amount.minimum, amount.maximum, amount.nullable) == (0.5, 20000.0, False)
    assert kind.added and kind.allowed == ("in", "out") and kind.minimum is None
    assert contract.key_columns == ["payment_id"]
    assert contract.tracked_columns == ["amount", "direction"]
    assert contract.source_columns == ["ref", "amount"]


def test_thresholds_fall_back_one_by_one():
    contract = parse_contract({**SPECIMEN, "thresholds": {"max_reject_pct": 0.2}})
    assert contract.thresholds.max_reject_pct == 0.2
    assert contract.thresholds.max_null_pct == 0.10
    assert contract.thresholds.min_valid_ratio == 0.95


@pytest.mark.parametrize("unknown", ["", None])
def test_ds_dialect_unknowns_are_absent(unknown):
    contract = parse_contract(
        {
            "ds": {
                "nm": "t",
                "format": "csv|parquet",
                "id_cols": ["a"],
                "dq_rules": {"allow_extra_columns": False},
                "cols": [
                    {
                        "src_nm": "a",
                        "tgt_nm": "b",
                        "src_dtype": "int",
                        "tgt_dtype": "bigint",
                        "src_fmt": unknown,
                        "regex": unknown,
                        "nullable": False,
                    }
                ],
            }
        }
    )
    (field,) = contract.fields
    assert field.regex is None and field.source_format is None and not field.nullable
    assert contract.source_format is None
    assert contract.key_columns == ["b"]
    assert contract.update_columns == ()
    assert not contract.policy.allow_extra_columns
    assert not contract.policy.allow_missing_columns


def test_dataset_dialect():
    contract = parse_contract(
        {
            "dataset": {
                "name": "t",
                "id_columns": ["a"],
                "update_id": ["u"],
                "fields": [
                    {
                        "name": "a",
                        "source_name": "a",
                        "target_name": "a",
                        "source_data_type": "LongType()",
                        "target_data_type": "LongType()",
                        "validation_regex": "^1",
                        "change_type": "none",
                    }
                ],
            }
        }
    )
    assert contract.fields[0].regex == "^1"
    assert contract.fields[0].change_types == ()
    assert contract.update_columns == ("u",)


def test_lines_dialect_with_embedded_and_broken_json():
    lines = [
        {"source_field": "a", "target_field": "a", "constraints": '{"min": 1, "max": 2}'},
        {"source_field": "b", "target_field": "c", "allowed_values": '["x"]'},
        {"source_field": "d", "target_field": "d", "constraints": "{oops", "allowed_values": " "},
    ]
    text = "\n".join(json.dumps(line) for line in lines)
    with pytest.raises(ContractError, match="constraints of d is not JSON"):
        parse_contract_text(text)
    contract = parse_contract_text(text, "ignore")
    assert contract.ignored == ("constraints of d is not JSON: {oops",)
    a, c, d = contract.fields
    assert (a.minimum, a.maximum) == (1, 2)
    assert c.allowed == ("x",)
    assert d.minimum is None and d.allowed == ()


@pytest.mark.parametrize("text", ["", "{", "[1", '{"other": 1}'])
def test_unreadable_documents(text):
    if text == "":
        assert parse_contract_text(text).fields == ()
        return
    with pytest.raises(ContractError):
        parse_contract_text(text)


def test_targets_are_unique():
    with pytest.raises(ContractError, match="twice"):
        parse_contract(
            [{"source_field": "a", "target_field": "x"}, {"source_field": "b", "target_field": "x"}]
        )


@pytest.mark.parametrize(
    "entry, thresholds, said",
    [
        ({"constraints": "{min: 5}"}, {}, "not JSON"),
        ({"constraints": [1, 2]}, {}, "not an object"),
        ({"constraints": {"minimum": 5}}, {}, "not min or max"),
        ({"allowed_values": "credit"}, {}, "not JSON"),
        ({"allowed_values": '"credit"'}, {}, "not a list"),
        ({}, {"max_rejects": 1}, "unknown"),
        ({}, {"max_null_pct": "few"}, "not a number"),
    ],
)
def test_broken_rules_are_errors(entry, thresholds, said):
    field = {"source_field": "a", "target_field": "a", **entry}
    document = {"dataset_name": "t", "fields": [field], "thresholds": thresholds}
    with pytest.raises(ContractError, match=said):
        parse_contract(document)
    assert said in parse_contract(document, "ignore").ignored[0]
    with pytest.raises(ValueError):
        parse_contract(document, "shrug")
