"""Casts that yield NULL instead of failing, whatever the session's ANSI mode.

Spark raises on a bad cast by default. Contracts expect a bad value to become
NULL so the quality rules can see it; ``on_error="fail"`` keeps Spark's error.

Inside ``try_cast`` a bad text still costs a thrown exception, some 20 us a row
against 0.4 us for a good one. Words, which no number can begin like, are
therefore sorted out by a comparison beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# ASCII characters that literals of a type may hold, beside blanks. Characters
# beyond ASCII are left for the cast itself to judge.
_FRACTION_CHARACTERS = "0123456789+-.abcdefABCDEFxXpPiInNtTyY"
_BOOLEAN_CHARACTERS = "01tTrRuUeEyYsSfFaAlLnNoO"
_BLANK = r"\x00-\x20\x7f"


def ref(name: str) -> Column:
    """Column by exact name, even if the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def _made_of(text: Column, characters: str) -> Column:
    """The text has only blanks, these characters, and characters beyond ASCII."""
    alien = "".join(f"\\x{code:02x}" for code in range(0x21, 0x7F) if chr(code) not in characters)
    return text.rlike(f"^[{_BLANK}]*[^{alien}{_BLANK}][^{alien}]*$")


def _hopeful(text: Column, target: DataType) -> Column | None:
    """A cheap test that every castable text passes; None where there is none."""
    if isinstance(target, BooleanType):
        return _made_of(text, _BOOLEAN_CHARACTERS)
    # Byte order settles most texts: numbers begin below ":", words above it.
    numeric = (text < ":") | (text >= "\x7f")
    if isinstance(target, (FloatType, DoubleType)):
        numeric = numeric | _made_of(text, _FRACTION_CHARACTERS)
    elif not isinstance(target, (IntegralType, DecimalType)):
        return None
    return (text != "") & (text != "-") & numeric


def try_cast_text(text: Column, target: DataType) -> Column:
    """``text.try_cast(target)``, without the price of most hopeless casts."""
    hopeful, cast = _hopeful(text, target), text.try_cast(target)
    return cast if hopeful is None else F.when(hopeful, cast)


def parse_date(value: Column, fmt: str | None = None) -> Column:
    """Text to date with a format, or Spark's ISO parsing without one."""
    if not fmt:
        return value.try_cast("date")
    parsed = F.try_to_date(value, fmt)
    # A format that asks for a year can match no text without a digit.
    digits_needed = "y" in fmt and not set(fmt) & set("['")
    return F.when(value.rlike("[0-9]"), parsed) if digits_needed else parsed


def cast_value(
    value: Column,
    source: DataType,
    target: DataType,
    fmt: str | None = None,
    on_error: str = "null",
) -> Column:
    """``value`` as ``target``; ``fmt`` applies to text becoming a date or time."""
    if source == target:
        return value
    strict = on_error == "fail"
    if fmt and isinstance(source, StringType):
        if isinstance(target, DateType):
            return F.to_date(value, fmt) if strict else parse_date(value, fmt)
        if isinstance(target, (TimestampType, TimestampNTZType)):
            parse = F.to_timestamp if strict else F.try_to_timestamp
            parsed = parse(value, fmt if strict else F.lit(fmt))
            return parsed.cast(target)
    if strict:
        return value.cast(target)
    return try_cast_text(value, target) if source == StringType() else value.try_cast(target)
