"""Schemas as data: profiles, contract generation, and checks against a contract."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..contract import Contract
from ..functions.casts import ref
from ..functions.frames import rows_frame
from ..functions.types import decimal_parts, type_text
from ..sources.footers import null_counts
from .profile import null_count

# The texts and defaults generated contracts carry.
COLUMN_DESCRIPTION = "Column {name} description"
TYPED_DESCRIPTION = "Column {name} of type {type}"
PROFILE_SOURCE = "s3_source"
PROFILE_TARGET = "curated_layer"
DS_COMMENT = "Business definition for {name}"
DATASET_COMMENT = "Business description for {name}"
DS_VERSION = "1.0"
DS_DESCRIPTION = "Metadata contract for {name}"
DS_BARE_DESCRIPTION = "Auto-generated metadata for {name}"
DS_SOURCE_SYSTEM = "source_system"
DS_TARGET_SYSTEM = "glue_catalog"
DS_BARE_TARGET_SYSTEM = "GlueCatalog"
DS_BARE_FORMAT = "csv|parquet"
DATASET_VERSION = "v1.0"
DATASET_DESCRIPTION = "Auto-generated metadata JSON for dataset {name}"
DATASET_OWNER = "data-eng"
DATASET_FREQUENCY = "daily"


# ------------------------------------------------------------------ profiles


def schema_profile(
    df: DataFrame,
    source: str = PROFILE_SOURCE,
    target: str = PROFILE_TARGET,
    *,
    count: bool = False,
) -> DataFrame:
    """One row per column: name, type, decimal parts, nullability.

    That needs the schema alone. File formats report every column as nullable, so
    ``nullable`` never yields a not-null rule; ``count`` adds ``null_rows``, what the
    data holds, for one pass over it.
    """
    wide = _counted(df, [null_count(f.name) for f in df.schema.fields] if count else None)
    rows = []
    for i, f in enumerate(df.schema.fields):
        precision, scale = decimal_parts(f.dataType)
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("name"),
                F.lit(type_text(f.dataType)).alias("type"),
                F.lit(precision).cast("int").alias("precision"),
                F.lit(scale).cast("int").alias("scale"),
                F.lit(f.nullable).alias("nullable"),
                F.lit(COLUMN_DESCRIPTION.format(name=f.name)).alias("description"),
                F.lit(source).alias("source"),
                F.lit(target).alias("target"),
                *([F.col(f"n{i}").alias("null_rows")] if count else []),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def _counted(df: DataFrame, counts: list[Column] | None) -> DataFrame:
    """One row with the counts n0, n1 and so on; without counts the data isn't read."""
    if counts is None:
        return df.sparkSession.range(1)
    return df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"n{i}") for i, c in enumerate(counts)])


def clean_schema(
    schema: StructType, source: str = PROFILE_SOURCE, target: str = PROFILE_TARGET
) -> dict[str, Any]:
    """The profile document: one flat entry per column."""
    return {
        "fields": [
            {
                "name": f.name,
                "type": type_text(f.dataType),
                "nullable": f.nullable,
                "description": COLUMN_DESCRIPTION.format(name=f.name),
                "source": source,
                "target": target,
            }
            for f in schema.fields
        ]
    }


def annotated_schema(schema: StructType) -> dict[str, Any]:
    """Spark's own schema JSON, nested types kept, with three keys per column."""
    document = schema.jsonValue()
    for entry in document["fields"]:
        entry["description"] = TYPED_DESCRIPTION.format(name=entry["name"], type=entry["type"])
        entry["source"] = entry["name"]
        entry["target"] = entry["name"]
    return document


def schema_annotated(df: DataFrame, *, count: bool = False) -> DataFrame:
    """``annotated_schema`` as rows; ``count`` adds the number of values of each column."""
    entries = annotated_schema(df.schema)["fields"]
    wide = _counted(df, [F.count(ref(e["name"])) for e in entries] if count else None)
    rows = []
    for i, e in enumerate(entries):
        text = e["type"] if isinstance(e["type"], str) else json.dumps(e["type"], sort_keys=True)
        rows.append(
            F.struct(
                F.lit(e["name"]).alias("name"),
                F.lit(text).alias("type_json"),
                F.lit(e["nullable"]).alias("nullable"),
                F.lit(e["description"]).alias("description"),
                F.lit(e["source"]).alias("source"),
                F.lit(e["target"]).alias("target"),
                *([F.col(f"n{i}").alias("value_rows")] if count else []),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- generation


def observed_nullability(df: DataFrame) -> dict[str, bool]:
    """Which columns hold a NULL in the data; from footers, else one aggregate, one row back."""
    _, known = null_counts(df, df.columns) or (0, {})
    names = [n for n in df.columns if n not in known]
    held = {n: known[n] > 0 for n in known}
    if names:
        row = df.agg(*[null_count(n).alias(f"n{i}") for i, n in enumerate(names)]).first()
        held |= {name: row[i] > 0 for i, name in enumerate(names)}
    return {name: held[name] for name in df.columns}


def generate_contract(
    df: DataFrame,
    name: str,
    *,
    dialect: str = "ds",
    source_format: str = "parquet",
    source_path: str = "",
    id_columns: list[str] | tuple[str, ...] = (),
    update_columns: list[str] | tuple[str, ...] = (),
    observe_nulls: bool = False,
) -> dict[str, Any]:
    """Identity contract of a frame: ``ds``, ``ds_bare`` or ``dataset`` dialect.

    ``observe_nulls`` marks columns without a NULL as not nullable, at the price
    of one aggregate over the data; otherwise only the schema is read.
    """
    nullable = observed_nullability(df) if observe_nulls else {}
    flags = {f.name: nullable.get(f.name, f.nullable) for f in df.schema.fields}
    if dialect == "ds":
        return _ds_document(
            df.schema, name, flags, source_format, source_path, id_columns, update_columns
        )
    if dialect == "ds_bare":
        return _ds_bare_document(df.schema, name, flags)
    if dialect == "dataset":
        return _dataset_document(df.schema, name, flags, id_columns, update_columns)
    raise ValueError(f"dialect={dialect!r}")


# Fixed format: the keys of the documents below and their nesting are what
# contract readers expect.


def _ds_columns(schema: StructType, flags: Mapping[str, bool], unknown: Any) -> list[dict]:
    return [
        {
            "src_nm": f.name,
            "tgt_nm": f.name,
            "src_dtype": type_text(f.dataType),
            "tgt_dtype": type_text(f.dataType),
            "src_fmt": unknown,
            "tgt_fmt": unknown,
            "nullable": flags[f.name],
            "required_src": True,
            "regex": unknown,
            "len": unknown,
            "chg_types": [],
            "comment": DS_COMMENT.format(name=f.name),
        }
        for f in schema.fields
    ]


def _ds_document(schema, name, flags, source_format, source_path, id_columns, update_columns):
    columns = _ds_columns(schema, flags, "")
    for column, f in zip(columns, schema.fields):
        precision, scale = decimal_parts(f.dataType)
        column["precision"] = "" if precision is None else precision
        column["scale"] = "" if scale is None else scale
    return {
        "ds": {
            "nm": name,
            "ver": DS_VERSION,
            "desc": DS_DESCRIPTION.format(name=name),
            "src_sys": DS_SOURCE_SYSTEM,
            "tgt_sys": DS_TARGET_SYSTEM,
            "format": source_format,
            "src_prefix": source_path,
            "id_cols": list(id_columns),
            "upd_cols": list(update_columns),
            "dq_rules": _policy_entries(allow_extra=True),
            "cols": columns,
        }
    }


def _ds_bare_document(schema, name, flags):
    return {
        "ds": {
            "nm": name,
            "ver": DS_VERSION,
            "desc": DS_BARE_DESCRIPTION.format(name=name),
            "src_sys": DS_SOURCE_SYSTEM,
            "tgt_sys": DS_BARE_TARGET_SYSTEM,
            "format": DS_BARE_FORMAT,
            "dq_rules": _policy_entries(allow_extra=False),
            "cols": _ds_columns(schema, flags, None),
        }
    }


def _policy_entries(allow_extra: bool) -> dict[str, bool]:
    return {
        "check_schema": True,
        "check_row_count": True,
        "allow_extra_columns": allow_extra,
        "allow_missing_columns": False,
    }


def _dataset_document(schema, name, flags, id_columns, update_columns):
    return {
        "dataset": {
            "name": name,
            "version": DATASET_VERSION,
            "description": DATASET_DESCRIPTION.format(name=name),
            "owner": DATASET_OWNER,
            "ingestion_frequency": DATASET_FREQUENCY,
            "id_columns": list(id_columns),
            "update_id": list(update_columns),
            "fields": [
                {
                    "name": f.name,
                    "nullable": flags[f.name],
                    "source_name": f.name,
                    "source_data_type": type_text(f.dataType),
                    "source_format": None,
                    "target_name": f.name,
                    "target_data_type": type_text(f.dataType),
                    "target_format": None,
                    "precision": decimal_parts(f.dataType)[0],
                    "validation_regex": None,
                    "row_level_comments": DATASET_COMMENT.format(name=f.name),
                    "change_type": "none",
                    "update_dt": None,
                }
                for f in schema.fields
            ],
        }
    }


def contract_frame(spark: SparkSession, contract: Contract) -> DataFrame:
    """The normalised contract as a table, one row per field."""
    rows = [
        {
            "position": position,
            "source": f.source,
            "target": f.target,
            "source_type": f.source_type,
            "target_type": f.target_type,
            "source_format": f.source_format,
            "nullable": f.nullable,
            "primary_key": f.primary_key,
            "regex": f.regex,
            "minimum": None if f.minimum is None else str(f.minimum),
            "maximum": None if f.maximum is None else str(f.maximum),
            "allowed": json.dumps(list(f.allowed)) if f.allowed else None,
            "change_types": ",".join(f.change_types),
            "comment": f.comment,
        }
        for position, f in enumerate(contract.fields)
    ]
    return rows_frame(
        spark,
        rows,
        "position int, source string, target string, source_type string, target_type string, "
        "source_format string, nullable boolean, primary_key boolean, regex string, "
        "minimum string, maximum string, allowed string, change_types string, comment string",
    )


# -------------------------------------------------------------------- checks


@dataclass(frozen=True)
class SchemaDiff:
    """Column names a contract expects but lacks, and those it does not know."""

    missing: tuple[str, ...]
    extra: tuple[str, ...]

    def allowed_by(self, contract: Contract) -> bool:
        policy = contract.policy
        if self.missing and not policy.allow_missing_columns:
            return False
        return not self.extra or policy.allow_extra_columns


class SchemaMismatch(ValueError):
    """The source does not have the columns the contract's policy demands."""


def diff_columns(df: DataFrame, contract: Contract) -> SchemaDiff:
    """Names compared exactly, as sets."""
    expected, actual = set(contract.source_columns), set(df.columns)
    return SchemaDiff(tuple(sorted(expected - actual)), tuple(sorted(actual - expected)))


def schema_diff(df: DataFrame, contract: Contract, *, count: bool = False) -> DataFrame:
    """(column_name, status): one row per difference.

    ``count`` adds ``value_rows``, what the difference touches: the values an extra
    column holds, or for a missing column nothing.
    """
    diff = diff_columns(df, contract)
    wide = _counted(df, [F.count(ref(name)) for name in diff.extra] if count else None)

    def row(name: str, status: str, values: Column) -> Column:
        touched = [values.cast("bigint").alias("value_rows")] if count else []
        return F.struct(F.lit(name).alias("column_name"), F.lit(status).alias("status"), *touched)

    rows = [row(name, "missing", F.lit(0)) for name in diff.missing]
    rows += [row(name, "extra", F.col(f"n{i}") if count else F.lit(0)) for i, name in enumerate(diff.extra)]
    if not rows:
        return wide.select(row("", "", F.lit(0)).alias("d")).select("d.*").filter("false")
    return wide.select(F.inline(F.array(*rows)))


def check_schema(
    df: DataFrame, contract: Contract, on_fail: str = "flag"
) -> tuple[bool, SchemaDiff]:
    """Apply the contract's column policy; ``flag`` and go on, or ``raise``."""
    if on_fail not in ("flag", "raise"):
        raise ValueError(f"on_fail={on_fail!r}")
    diff = diff_columns(df, contract)
    passed = diff.allowed_by(contract)
    if not passed and on_fail == "raise":
        raise SchemaMismatch(f"missing {list(diff.missing)}, unexpected {list(diff.extra)}")
    return passed, diff


def schema_policy(df: DataFrame, contract: Contract) -> DataFrame:
    """All rows, flagged with the outcome of the column policy."""
    passed, diff = check_schema(df, contract)
    return df.withColumns(
        {
            "schema_ok": F.lit(passed),
            "missing_columns": F.lit(",".join(diff.missing)),
            "extra_columns": F.lit(",".join(diff.extra)),
        }
    )
