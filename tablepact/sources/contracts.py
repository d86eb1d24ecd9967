"""Contract documents on any path Spark can reach."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, ContractError, parse_contract_text
from ..functions.frames import rows_frame

MAPPING_ROW_SCHEMA = (
    "source_field string, target_field string, change_type string, target_type string, "
    "minimum double, maximum double, allowed_values array<string>"
)


def load_document(spark: SparkSession, path: str) -> str:
    """The whole text of a contract file; a contract is one small document."""
    documents = spark.read.text(path, wholetext=True).take(2)
    if len(documents) != 1:
        raise ContractError(f"expected one contract document at {path}, found {len(documents)}")
    return documents[0][0]


def load_contract(spark: SparkSession, path: str, on_bad_rule: str = "raise") -> Contract:
    """Contract of any dialect, pretty-printed or on one line."""
    return parse_contract_text(load_document(spark, path), on_bad_rule)


def save_document(spark: SparkSession, document: Mapping[str, Any] | list, path: str) -> None:
    """Write a profile or contract as JSON; a list becomes one object per line."""
    if isinstance(document, list):
        text = "\n".join(json.dumps(entry) for entry in document)
    else:
        text = json.dumps(document, indent=4)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_mapping_lines(spark: SparkSession, path: str, on_bad_rule: str = "raise") -> DataFrame:
    """The mappings of a line-delimited contract as rows, as ``load_contract`` means them.

    A mapping with a source keeps its data, whatever its change and type say; one
    without is an added column. No type is the source's own type.
    """
    contract = load_contract(spark, path, on_bad_rule)
    text = lambda v: None if v is None else str(v)
    rows = [
        {
            "source_field": f.source,
            "target_field": f.target,
            "change_type": ",".join(f.change_types) or None,
            "target_type": f.target_type,
            "minimum": None if f.minimum is None else float(f.minimum),
            "maximum": None if f.maximum is None else float(f.maximum),
            "allowed_values": [text(v) for v in f.allowed] or None,
        }
        for f in contract.fields
    ]
    return rows_frame(spark, rows, MAPPING_ROW_SCHEMA)
