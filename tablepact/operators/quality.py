"""Row rules: one pass tags every row with the first rule it fails.

A rule is a three-valued predicate. What a NULL outcome means (the value was
NULL, so neither in nor out of range) is the caller's ``null_policy``:

``reject``  the row fails the rule (default; nothing is lost)
``pass``    the row satisfies the rule
``drop``    the row leaves both sides, unless an earlier rule rejected it
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
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
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..contract import Contract
from ..functions.casts import ref, try_cast_text
from .mapping import CAST_ERROR

ERROR_REASON = "error_reason"
ERROR_REASONS = "error_reasons"
RULE_KINDS = ("not_null", "regex", "range", "allowed")
NULL_POLICIES = ("reject", "pass", "drop")
_DROPPED = ""

# How a rule finds its column: by name, or as an expression over source columns.
Resolver = Callable[[str], Column]

_FRACTIONS = (FloatType, DoubleType)
_TIMES = (DateType, TimestampType, TimestampNTZType)


@dataclass(frozen=True)
class Rule:
    """One condition on one column."""

    column: str
    kind: str
    reason: str
    regex: str | None = None
    minimum: Any = None
    maximum: Any = None
    allowed: tuple[Any, ...] = ()

    def outcome(self, value: Column, data_type: DataType) -> Column:
        """True when satisfied, False when violated, NULL when undecidable."""
        if self.kind == "not_null":
            present = value.isNotNull()
            return present & ~F.isnan(value) if isinstance(data_type, _FRACTIONS) else present
        if self.kind == "regex":
            text = value if isinstance(data_type, StringType) else value.cast("string")
            return text.rlike(self.regex)
        if self.kind == "range":
            return _within(value, data_type, self.minimum, self.maximum)
        if self.kind == "allowed":
            return _one_of(value, data_type, self.allowed)
        raise ValueError(f"rule kind {self.kind!r}")


def _within(value: Column, data_type: DataType, low: Any, high: Any) -> Column:
    checks = []
    for bound, compare in ((low, Column.__ge__), (high, Column.__le__)):
        if bound is not None:
            side, literal = _comparable(value, data_type, bound)
            checks.append(compare(side, literal))
    return reduce(and_, checks)


def _comparable(value: Column, data_type: DataType, bound: Any) -> tuple[Column, Column]:
    """Value and bound in a type that compares exactly."""
    if isinstance(data_type, _TIMES):
        return value, F.lit(str(bound)).cast(data_type)
    if isinstance(data_type, StringType) and not isinstance(bound, str):
        return try_cast_text(value, DoubleType()), F.lit(float(bound))
    if isinstance(data_type, (DecimalType, IntegralType)):
        return value, F.lit(Decimal(str(bound)))
    if isinstance(data_type, _FRACTIONS):
        return value, F.lit(float(bound))
    return value, F.lit(bound)


def _one_of(value: Column, data_type: DataType, allowed: Sequence[Any]) -> Column:
    if isinstance(data_type, StringType):
        return value.isin([a if isinstance(a, str) else json.dumps(a) for a in allowed])
    if isinstance(data_type, BooleanType) and all(isinstance(a, bool) for a in allowed):
        return value.isin(list(allowed))
    if isinstance(data_type, (DecimalType, IntegralType)) and all(
        isinstance(a, int) and not isinstance(a, bool) for a in allowed
    ):
        return value.isin(list(allowed))
    # Values of another type: those that do not convert can never be matched.
    hits = [F.coalesce(value == F.lit(a).try_cast(data_type), F.lit(False)) for a in allowed]
    return F.when(value.isNotNull(), reduce(or_, hits))


def compile_rules(
    contract: Contract, kinds: Iterable[str] = RULE_KINDS, required: Sequence[str] = ()
) -> list[Rule]:
    """The contract's rules in contract order; within a field in RULE_KINDS order.

    ``required`` columns get a not-null rule in any case.
    """
    kinds = tuple(kinds)
    unknown = set(kinds) - set(RULE_KINDS)
    if unknown:
        raise ValueError(f"rule kinds {sorted(unknown)}")
    rules = []
    for f in contract.fields:
        name = f.target
        if name in required or ("not_null" in kinds and not f.nullable):
            rules.append(Rule(name, "not_null", f"{name} null"))
        if "regex" in kinds and f.regex:
            rules.append(Rule(name, "regex", f"{name} regex", regex=f.regex))
        if "range" in kinds and not (f.minimum is None and f.maximum is None):
            rules.append(
                Rule(name, "range", f"{name} outside range", minimum=f.minimum, maximum=f.maximum)
            )
        if "allowed" in kinds and f.allowed:
            rules.append(Rule(name, "allowed", f"{name} invalid value", allowed=f.allowed))
    return rules


def split_bounds(rules: Iterable[Rule]) -> list[Rule]:
    """Every two-sided range as two one-sided rules."""
    out = []
    for r in rules:
        if r.kind == "range" and r.minimum is not None and r.maximum is not None:
            out.append(Rule(r.column, "range", r.reason, minimum=r.minimum))
            out.append(Rule(r.column, "range", r.reason, maximum=r.maximum))
        else:
            out.append(r)
    return out


def applicable(rules: Iterable[Rule], columns: Iterable[str]) -> list[Rule]:
    """Rules whose column the frame has; contract columns may be absent."""
    present = set(columns)
    return [r for r in rules if r.column in present]


def outcomes(
    rules: Sequence[Rule], schema: StructType, resolve: Resolver = ref
) -> list[Column]:
    return [r.outcome(resolve(r.column), schema[r.column].dataType) for r in rules]


def _failure(outcome: Column, null_policy: str) -> Column:
    """Never-NULL failure flag; under ``drop`` an undecided rule also counts."""
    return ~F.coalesce(outcome, F.lit(null_policy == "pass"))


def first_failure(
    rules: Sequence[Rule], schema: StructType, null_policy: str, resolve: Resolver = ref
) -> Column:
    """Reason of the first failed rule, NULL for a valid row."""
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy={null_policy!r}")
    steps = []
    if CAST_ERROR in schema.names:
        steps.append(F.concat(resolve(CAST_ERROR), F.lit(" not castable")))
    for rule, outcome in zip(rules, outcomes(rules, schema, resolve)):
        reason = F.lit(rule.reason)
        if null_policy == "drop":
            reason = F.when(outcome.isNull(), F.lit(_DROPPED)).otherwise(reason)
        steps.append(F.when(_failure(outcome, null_policy), reason))
    return F.coalesce(*steps, F.lit(None).cast("string"))


def all_failures(rules: Sequence[Rule], schema: StructType, null_policy: str) -> Column:
    """Reasons of all failed rules, in rule order."""
    none = F.array().cast("array<string>")
    parts = [none]
    if CAST_ERROR in schema.names:
        text = F.concat(ref(CAST_ERROR), F.lit(" not castable"))
        parts.append(F.when(ref(CAST_ERROR).isNotNull(), F.array(text)).otherwise(none))
    undecided = null_policy != "reject"
    for rule, outcome in zip(rules, outcomes(rules, schema)):
        failed = ~F.coalesce(outcome, F.lit(undecided))
        parts.append(F.when(failed, F.array(F.lit(rule.reason))).otherwise(none))
    return F.concat(*parts)


def tag_rows(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    null_policy: str = "reject",
    all_reasons: bool = False,
) -> DataFrame:
    """Add ``error_reason``: NULL on valid rows, the first failed rule on others.

    With ``all_reasons`` also ``error_reasons``, filled on rejected rows only.
    """
    if ERROR_REASON in df.columns or ERROR_REASONS in df.columns:
        raise ValueError("the frame already carries reject columns")
    tagged = df.withColumn(ERROR_REASON, first_failure(rules, df.schema, null_policy))
    if all_reasons:
        failed = ref(ERROR_REASON).isNotNull()
        reasons = F.when(failed, all_failures(rules, df.schema, null_policy))
        tagged = tagged.withColumn(ERROR_REASONS, reasons)
    return tagged.drop(CAST_ERROR)


def is_valid() -> Column:
    return ref(ERROR_REASON).isNull()


def is_rejected() -> Column:
    """False on rows that ``null_policy="drop"`` removes from both sides."""
    return F.coalesce(ref(ERROR_REASON), F.lit(_DROPPED)) != _DROPPED


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(is_valid()).drop(ERROR_REASON, ERROR_REASONS)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """Rejected rows with their reason; the right schema even when empty."""
    return tagged.filter(is_rejected())


def untagged_rejects(tagged: DataFrame) -> DataFrame:
    """Rejected rows as they are, without a reason."""
    return rejected_rows(tagged).drop(ERROR_REASON, ERROR_REASONS)


def invalid_flag(
    rules: Sequence[Rule], schema: StructType, combine: str = "any", resolve: Resolver = ref
) -> Column:
    """Batch-level "invalid" flag of a row; an undecided rule never counts.

    ``any``: some rule fails. ``all``: every rule fails, with each bound of a
    range a rule of its own, so a two-sided range can never fail in full.
    """
    if combine not in ("any", "all"):
        raise ValueError(f"combine={combine!r}")
    if combine == "all":
        rules = split_bounds(rules)
    if not rules:
        # No rule at all: "all of none" holds for every row, "any" for none.
        return F.lit(combine == "all")
    failed = [~F.coalesce(o, F.lit(True)) for o in outcomes(rules, schema, resolve)]
    return reduce(and_ if combine == "all" else or_, failed)
