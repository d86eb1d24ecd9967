"""Type names as contracts write them, in both directions."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql.types import DataType, DecimalType, StructType

# Python class spellings ("LongType()") found in contracts that were written
# with str(dataType); names that differ from SQL by more than case.
_CLASS_NAMES = {
    "Integer": "int",
    "Long": "bigint",
    "Short": "smallint",
    "Byte": "tinyint",
    "TimestampNTZ": "timestamp_ntz",
}
_CLASS_FORM = re.compile(r"([A-Z]\w*)Type(?:\(([\d,\s]*)\))?")


class UnknownType(ValueError):
    """A contract names a type Spark does not know."""


def type_text(data_type: DataType) -> str:
    """SQL spelling of a type, e.g. ``decimal(12,2)``; legal in any contract."""
    return data_type.simpleString()


def decimal_parts(data_type: DataType) -> tuple[int | None, int | None]:
    """(precision, scale) of a decimal, (None, None) of anything else."""
    if isinstance(data_type, DecimalType):
        return data_type.precision, data_type.scale
    return None, None


def parse_type(text: str) -> DataType:
    """Spark type for a contract's type name; unknown names are an error."""
    name = text.strip()
    spelled = _CLASS_FORM.fullmatch(name)
    if spelled:
        base = _CLASS_NAMES.get(spelled[1], spelled[1].lower())
        name = f"{base}({spelled[2]})" if spelled[2] else base
    try:
        parsed = DataType.fromDDL(name)
    except AnalysisException as error:
        raise UnknownType(f"unknown type name {text!r}") from error
    if isinstance(parsed, StructType) and not name.lower().startswith("struct<"):
        raise UnknownType(f"unknown type name {text!r}")
    return parsed
