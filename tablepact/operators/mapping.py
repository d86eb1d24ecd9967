"""Source columns to contract columns in one simultaneous projection.

Renames, casts and added columns all read the *source* frame, so two columns
may swap names and the order of contract entries never matters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from ..contract import Contract, ContractError, Field
from ..functions.casts import cast_value, ref
from ..functions.types import UnknownType, parse_type

CAST_ERROR = "cast_error"
INGEST_TS = "ingest_ts"


@dataclass(frozen=True)
class Mapping:
    """A contract compiled against one source schema."""

    columns: tuple[tuple[str, Column], ...]
    cast_error: Column | None = None

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def value(self, name: str) -> Column:
        """A target column as an expression over source columns."""
        if name == CAST_ERROR and self.cast_error is not None:
            return self.cast_error
        return dict(self.columns)[name]

    def apply(self, df: DataFrame) -> DataFrame:
        projected = [value.alias(name) for name, value in self.columns]
        if self.cast_error is not None:
            projected.append(self.cast_error.alias(CAST_ERROR))
        return df.select(*projected)


def compile_mapping(
    schema: StructType,
    contract: Contract,
    *,
    keep_extra: bool = True,
    missing: str = "skip",
    on_cast_error: str = "null",
) -> Mapping:
    """Bind a contract to a source schema.

    keep_extra      pass unmapped source columns through, in place; otherwise
                    exactly the contract's columns, in contract order
    missing         contract column absent in the source: ``skip`` it, ``raise``,
                    or make it ``null``
    on_cast_error   ``null``, ``fail`` (Spark's error), or ``reject``: NULL plus
                    the first offending column's name in ``cast_error``
    """
    if missing not in ("skip", "raise", "null"):
        raise ValueError(f"missing={missing!r}")
    if on_cast_error not in ("null", "fail", "reject"):
        raise ValueError(f"on_cast_error={on_cast_error!r}")

    types = {f.name: f.dataType for f in schema.fields}
    mapped: dict[str, list[tuple[str, Column]]] = {}
    appended: list[tuple[str, Column]] = []
    in_contract_order: list[tuple[str, Column]] = []
    bad_casts: list[Column] = []

    for field in contract.fields:
        if is_added(field, types):
            pair = (field.target, added_value(field))
            appended.append(pair)
        elif field.source not in types:
            if missing == "raise":
                raise ContractError(f"source has no column {field.source!r}")
            if missing == "skip":
                continue
            pair = (field.target, added_value(field))
            appended.append(pair)
        else:
            value = mapped_value(field, types[field.source], on_cast_error)
            pair = (field.target, value)
            mapped.setdefault(field.source, []).append(pair)
            if on_cast_error == "reject" and _changes_type(field, types[field.source]):
                raw = ref(field.source)
                bad_casts.append(F.when(raw.isNotNull() & value.isNull(), F.lit(field.target)))
        in_contract_order.append(pair)

    if keep_extra:
        columns = _in_source_order(schema, mapped, appended)
    else:
        columns = in_contract_order
    cast_error = F.coalesce(*bad_casts) if bad_casts else None
    if on_cast_error == "reject" and cast_error is None:
        cast_error = F.lit(None).cast("string")
    return Mapping(tuple(columns), cast_error)


def _in_source_order(
    schema: StructType,
    mapped: dict[str, list[tuple[str, Column]]],
    appended: list[tuple[str, Column]],
) -> list[tuple[str, Column]]:
    overwritten = {name for name, _ in appended}
    columns: list[tuple[str, Column]] = []
    for name in schema.fieldNames():
        if name in mapped:
            columns.extend(mapped[name])
        elif name not in overwritten:
            columns.append((name, ref(name)))
    columns.extend(appended)
    names = [name for name, _ in columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ContractError(f"mapping yields these columns twice: {clashes}")
    return columns


def is_added(field: Field, types: dict[str, DataType]) -> bool:
    if field.added:
        return True
    return "added" in field.change_types and field.source not in types


def added_value(field: Field) -> Column:
    """A typed NULL, or the contract's ``expr`` over source columns."""
    target = parse_type(field.target_type) if field.target_type else StringType()
    if field.expr:
        return F.expr(field.expr).try_cast(target)
    return F.lit(None).cast(target)


def mapped_value(field: Field, actual: DataType, on_cast_error: str = "null") -> Column:
    """The field's source column in its declared type."""
    target = parse_type(field.target_type) if field.target_type else actual
    on_error = "fail" if on_cast_error == "fail" else "null"
    return cast_value(ref(field.source), actual, target, field.source_format, on_error)


def _changes_type(field: Field, actual: DataType) -> bool:
    return field.target_type is not None and parse_type(field.target_type) != actual


def map_columns(df: DataFrame, contract: Contract, **options) -> DataFrame:
    """Rename, cast and add columns as the contract says; see compile_mapping."""
    return compile_mapping(df.schema, contract, **options).apply(df)


def lenient_mapping(df: DataFrame, contract: Contract) -> Mapping:
    """Like compile_mapping, but no type can fail: text is the last resort.

    A column becomes a string when its declared type is unknown to Spark or
    cannot be reached from the source type at all (say, date to int).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    declared = {}
    for field in contract.fields:
        if field.source in types and field.target_type:
            declared[field.target] = _reachable_type(df, field, types[field.source])
    fields = tuple(
        Field(
            target=f.target,
            source=f.source,
            target_type=declared.get(f.target, f.target_type),
            source_format=f.source_format,
        )
        for f in contract.fields
        if f.source in types
    )
    return compile_mapping(df.schema, contract.but(fields=fields))


def _reachable_type(df: DataFrame, field: Field, actual: DataType) -> str:
    try:
        target = parse_type(field.target_type)
        df.select(cast_value(ref(field.source), actual, target, field.source_format))
    except (UnknownType, AnalysisException):
        return "string"
    return target.simpleString()


def timestamp_literal(moment: datetime) -> Column:
    """A moment as a timestamp literal; naive values are taken as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    delta = moment - epoch
    micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return F.timestamp_micros(F.lit(micros))


def with_ingest_ts(df: DataFrame, moment: datetime | None = None) -> DataFrame:
    """Stamp rows with the batch time, or with the query's own start time."""
    stamp = F.current_timestamp() if moment is None else timestamp_literal(moment)
    return df.withColumn(INGEST_TS, stamp)


def add_missing_update_columns(
    df: DataFrame, columns: Sequence[str], moment: datetime | None = None
) -> DataFrame:
    """Give the frame every update column it lacks, set to the batch time."""
    stamp = F.current_timestamp() if moment is None else timestamp_literal(moment)
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: stamp for c in absent}) if absent else df


def load_partition(moment: datetime) -> tuple[str, str]:
    """(date, hour) of a batch in UTC: the values of the dt and hr partitions."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return f"{moment:%Y-%m-%d}", f"{moment:%H}"
