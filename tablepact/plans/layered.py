"""Layered loads: raw, curated or staging, business; with SCD1 or SCD2 at the end.

Each load passes over its data a fixed number of times, whatever the contract
holds. Quality is counted during a write that happens anyway.

Options of both SCD2 loads:

null_policy      what a rule says about NULL: ``reject``, ``pass`` or ``drop``
kinds            rule kinds to apply; by default columns that the contract says are not
                 nullable, ranges and value lists
on_cast_error    ``null``, ``reject`` or ``fail``
all_reasons      also list every failed rule in ``error_reasons``
min_valid_ratio  the gate's limit, if not the contract's
reject_mode      ``overwrite`` the rejects of the date (and hour), or ``append`` to them,
                 as ``batch=<batch_id>``: what a batch appends again replaces its first try
batch_id         a name that stays the same when the batch is tried again; by default its
                 moment
scd_mode         ``strict`` or ``as_read``; see ``merge.scd2_merge``. A table keeps the
                 mode of its first batch
keys, tracked    business key and compared columns, if not the contract's. Rows
                 without a key are rejected
duplicates       what to do with valid rows that share a key: ``raise``, or merge the
                 ``latest`` by ``order_by`` and count the others; by default ``latest``
                 if there is an order, else ``raise``
order_by         which of several batch rows with one key to merge: the greatest

What would keep a batch from being merged (a newer snapshot, another mode, a column
whose type doesn't fit the table's) raises before anything is written. Columns that
only the table has are NULL in new rows; columns that only the batch has are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
)

from ..audit import AuditLog, audited
from ..contract import Contract, ContractError
from ..functions.frames import empty_frame
from ..operators import gates, merge, quality
from ..operators.dedupe import any_null, latest_per_key
from ..operators.mapping import CAST_ERROR, Mapping, compile_mapping, load_partition, with_ingest_ts
from ..operators.schema import annotated_schema, clean_schema
from ..functions.casts import ref
from ..sources import tables, writers
from ..sources.contracts import save_document
from ..sources.readers import read_source
from .result import LoadResult, log_ignored, watched

_REASON = "__reason"
_ROWS = "__rows"
_REPEATED = "a key of the batch is repeated"
DUPLICATES = ("raise", "latest")
LAYERED_RULES = ("not_null", "range", "allowed")
#: Of a load that routes no rows, whose NULLs a gate of their own counts.
GATED_RULES = ("range", "allowed")


class DuplicateKeys(ValueError):
    """Valid rows of a batch share a key, and nothing says which to merge."""


@dataclass(frozen=True)
class Layers:
    """Where each layer of a dataset lives; business tables hold snapshots."""

    business: str
    curated: str = ""
    raw: str = ""
    rejects: str = ""
    schema_document: str = ""
    audit: str = ""


def _compile(
    source: DataFrame,
    contract: Contract,
    kinds: Sequence[str],
    keep_extra: bool = True,
    on_cast_error: str = "null",
    keys: Sequence[str] = (),
) -> tuple[Mapping, list[quality.Rule], StructType]:
    mapping = compile_mapping(
        source.schema,
        contract,
        keep_extra=keep_extra,
        missing="raise",
        on_cast_error=on_cast_error,
    )
    rules = quality.compile_rules(contract, kinds, required=keys)
    return mapping, rules, mapping.apply(source).schema


def layered_tagged(
    source: DataFrame,
    contract: Contract,
    *,
    null_policy: str = "reject",
    kinds: Sequence[str] = LAYERED_RULES,
    on_cast_error: str = "null",
    all_reasons: bool = False,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Mapped rows, each with the first rule it fails; a key is never NULL."""
    keys = contract.key_columns if keys is None else keys
    mapping, rules, _ = _compile(source, contract, kinds, on_cast_error=on_cast_error, keys=keys)
    return quality.tag_rows(
        mapping.apply(source), rules, null_policy=null_policy, all_reasons=all_reasons
    )


def _copy_raw(
    source: DataFrame,
    contract: Contract,
    path: str,
    null_policy: str,
    kinds: Sequence[str],
    on_cast_error: str,
    keys: Sequence[str],
) -> dict[str, int]:
    """Copy the source untouched; count valid and rejected rows on the way."""
    mapping, rules, schema = _compile(
        source, contract, kinds, on_cast_error=on_cast_error, keys=keys
    )
    reason = quality.first_failure(rules, schema, null_policy, mapping.value)
    flagged = source.withColumn(_REASON, reason)
    valid = F.col(_REASON).isNull()
    rejected = F.coalesce(F.col(_REASON), F.lit("")) != ""
    copied, counts = watched(
        flagged,
        [
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(valid).alias("valid_rows"),
            F.count_if(rejected).alias("rejected_rows"),
        ],
    )
    writers.overwrite(copied.drop(_REASON), path)
    return counts.get


def _count_rows(tagged: DataFrame) -> dict[str, int]:
    """Count a batch by an aggregate, which reads only the columns of its rules."""
    return tagged.agg(*gates.row_metrics()).first().asDict()


def _write_rejects(
    tagged: DataFrame, layers: Layers, dt: str, hr: str | None, mode: str, expected: int, batch: str
) -> None:
    rejects = quality.rejected_rows(tagged)
    if expected == 0:
        # Nothing to look for; still replace what an earlier try left.
        rejects = empty_frame(tagged.sparkSession, rejects.schema)
    rejects = writers.evened(rejects)
    if mode == "append":
        writers.append_rejects(rejects, layers.rejects, dt, hr, batch)
    else:
        writers.write_batch(rejects, layers.rejects, dt, hr, mode)


def _key_counts(batch: DataFrame, keys: Sequence[str]) -> dict[str, int]:
    """Rows without a key, and rows beyond the first of their key; reads only the keys."""
    groups = batch.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    none = any_null(keys)
    row = groups.agg(
        F.sum(F.when(none, F.col("__rows"))).alias("keyless_rows"),
        F.sum(F.when(~none, F.col("__rows") - 1)).alias("duplicate_rows"),
    ).first()
    return {name: row[name] or 0 for name in ("keyless_rows", "duplicate_rows")}


def _duplicates(duplicates: str | None, order_by: Sequence[str]) -> str:
    chosen = duplicates or ("latest" if order_by else "raise")
    if chosen not in DUPLICATES:
        raise ValueError(f"duplicates={duplicates!r}")
    if chosen == "latest" and not order_by:
        raise ValueError("duplicates='latest' needs order_by")
    return chosen


#: Types whose least and greatest value Parquet's statistics and a literal both hold.
_RANGED = (ByteType, ShortType, IntegerType, LongType, StringType, DateType, DecimalType)


def _key_range(schema: StructType, keys: Sequence[str]) -> list[Column]:
    """The least and greatest value of each key column that has them in file statistics."""
    ranged = [k for k in keys if isinstance(schema[k].dataType, _RANGED)]
    bounds = [(F.min(ref(k)), F.max(ref(k))) for k in ranged]
    return [c.alias(f"{side}.{k}") for k, pair in zip(ranged, bounds) for side, c in zip(("low", "high"), pair)]


def _between(found: dict[str, Any]) -> dict[str, tuple[Any, Any]]:
    names = [n.removeprefix("low.") for n in found if n.startswith("low.")]
    return {n: (found[f"low.{n}"], found[f"high.{n}"]) for n in names if found[f"low.{n}"] is not None}


def _one_row_per_key(
    batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], duplicates: str, result: LoadResult
) -> DataFrame:
    """The batch with unique keys; where a repeated key is refused, its write fails.

    The rows of a key are counted by the aggregate that makes keys unique anyway, and a
    task that meets a second one stops the write. Only where the latest is to be merged
    are the others counted, by a pass over the keys.
    """
    if duplicates == "latest":
        result.metrics |= _key_counts(batch, keys) | {"keyless_rows": result.metrics["keyless_rows"]}
        unique = not result.metrics["duplicate_rows"]
        _log_keys(result)
        return batch if unique else latest_per_key(batch, keys, order_by)
    counted = latest_per_key(batch, keys, keys, count=_ROWS)
    repeated = F.raise_error(F.lit(_REPEATED)).cast("boolean")
    return counted.filter(F.when(F.col(_ROWS) > 1, repeated).otherwise(F.lit(True))).drop(_ROWS)


def _log_keys(result: LoadResult) -> None:
    counts = {n: result.metrics[n] for n in ("keyless_rows", "duplicate_rows")}
    report = result.log.warn if any(counts.values()) else result.log.info
    report("keys", "Keys counted", **counts)


def _merge_in(
    table: tables.Table,
    rows: DataFrame,
    snapshot: str,
    batch: DataFrame,
    keys: Sequence[str],
    duplicates: str,
    result: LoadResult,
) -> None:
    """Write a snapshot; where repeated keys stopped it, say how many there are."""
    try:
        table.write(rows, snapshot)
    except Exception as e:
        if duplicates != "raise" or _REPEATED not in str(e):
            raise
        result.metrics["duplicate_rows"] = repeated = _key_counts(batch, keys)["duplicate_rows"]
        _log_keys(result)
        raise DuplicateKeys(f"{repeated} rows repeat a key of {list(keys)}") from e
    if duplicates == "raise":
        result.metrics["duplicate_rows"] = 0
        _log_keys(result)


def _opened(
    spark: SparkSession,
    root: str,
    layout: str,
    keys: Sequence[str],
    snapshot: str,
    schema: StructType,
    log: AuditLog,
) -> tables.Table:
    table = tables.open_table(spark, root, layout, keys, snapshot, schema)
    missing = [c for c in table.missing if c not in merge.HISTORY]
    if missing:
        log.warn("schema", "The batch lacks columns of the table", missing=missing)
    return table


def _load_scd2(
    spark: SparkSession,
    source: DataFrame,
    contract: Contract,
    layers: Layers,
    moment: datetime,
    log: AuditLog,
    *,
    hourly: bool,
    null_policy: str = "reject",
    kinds: Sequence[str] = LAYERED_RULES,
    on_cast_error: str = "null",
    all_reasons: bool = False,
    min_valid_ratio: float | None = None,
    reject_mode: str = "overwrite",
    batch_id: str | None = None,
    scd_mode: str = "strict",
    keys: Sequence[str] | None = None,
    tracked: Sequence[str] | None = None,
    duplicates: str | None = None,
    order_by: Sequence[str] = (),
) -> LoadResult:
    for name in ("curated", "rejects", "business"):
        if not getattr(layers, name):
            raise ValueError(f"set layers.{name}")
    result = LoadResult(log=log)
    log_ignored(contract, log)
    dt, hour = load_partition(moment)
    hr = hour if hourly else None
    keys = list(keys or contract.key_columns)
    tracked = list(tracked if tracked is not None else contract.tracked_columns)
    if not keys:
        raise ContractError("an SCD2 load needs a key: flag a primary_key field or pass keys")
    duplicates = _duplicates(duplicates, order_by)
    merge._check(scd_mode)
    snapshot = dt if hr is None else f"{dt}-{hr}"
    mapping = _compile(source, contract, kinds, on_cast_error=on_cast_error, keys=keys)[0]
    shape = with_ingest_ts(mapping.apply(source), moment).drop(CAST_ERROR).schema
    layout = "scd2" if scd_mode == "strict" else "whole"
    table = _opened(
        spark, layers.business, layout, keys, snapshot, merge.history_schema(shape), log
    )
    if layers.schema_document:
        document = annotated_schema(source.schema) if hourly else clean_schema(
            source.schema, "raw_layer", "curated_layer"
        )
        save_document(spark, document, layers.schema_document)
        log.info("schema", "Schema document written", path=layers.schema_document)

    if layers.raw:
        raw_path = writers.batch_path(layers.raw, dt, hr)
        counts = _copy_raw(
            source, contract, raw_path, null_policy, kinds, on_cast_error, keys
        )
        source = spark.read.schema(source.schema).parquet(raw_path)
        result.paths["raw"] = raw_path
        log.info("raw_copy", "Raw copy written", path=raw_path)

    tagged = layered_tagged(
        source,
        contract,
        null_policy=null_policy,
        kinds=kinds,
        on_cast_error=on_cast_error,
        all_reasons=all_reasons,
        keys=keys,
    )
    if not layers.raw:
        counts = _count_rows(tagged)
    batch_id = batch_id or moment.strftime("%Y%m%dT%H%M%S")
    _write_rejects(tagged, layers, dt, hr, reject_mode, counts["rejected_rows"], batch_id)
    result.metrics.update(counts)
    result.paths["rejects"] = writers.batch_path(layers.rejects, dt, hr)
    log.info("validate", "Rejects written", path=result.paths["rejects"], **counts)

    limit = contract.thresholds.min_valid_ratio if min_valid_ratio is None else min_valid_ratio
    gate = gates.valid_ratio(counts["total_rows"], counts["valid_rows"], limit)
    result.gates.append(gate)
    log.info("gate", "Valid ratio checked", value=gate.value, threshold=limit, passed=gate.passed)
    gate.enforce()

    curated = with_ingest_ts(quality.valid_rows(tagged), moment)
    # keys' bounds come from the write itself, and are the same however often a task runs
    bounds = _key_range(curated.schema, keys) or [F.count(F.lit(1)).alias("rows")]
    observed, ranges = watched(curated, bounds)
    result.paths["curated"] = writers.write_batch(observed, layers.curated, dt, hr)
    log.info("curated", "Curated partition written", path=result.paths["curated"])

    batch = spark.read.schema(curated.schema).parquet(result.paths["curated"])
    result.metrics["keyless_rows"] = 0  # they are rejects
    fitted = table.fitted(batch, snapshot).filter(~any_null(keys))
    unique = _one_row_per_key(fitted, keys, order_by, duplicates, result)
    if scd_mode == "strict":
        small = merge.keys_fit_broadcast(fitted, keys)
        only, between = (merge.keys_of(fitted, keys), _between(ranges.get)) if small else (None, None)
        changes = merge.scd2_changes(
            unique, table.current(only, between, keyed=True), keys, tracked, dt,
            plan="lookup" if small else "shuffle", unique=True, narrowed=small,
        )
    else:
        changes = merge.scd2_merge(unique, table.rows(), keys, tracked, dt, mode=scd_mode, unique=True)
    _merge_in(table, changes, snapshot, fitted, keys, duplicates, result)
    result.snapshot = snapshot
    result.paths["business"] = layers.business
    log.info("merge", "Business layer merged", path=layers.business, snapshot=snapshot)
    return result


def read_business(
    spark: SparkSession, root: str, schema: StructType | None = None
) -> DataFrame:
    """The business table as of its newest finished snapshot.

    It has the columns of all its batches, or those of ``schema``. Before the first
    snapshot it is empty, for which a schema is needed.
    """
    table = tables.read_table(spark, root)
    if table is None:
        if schema is None:
            raise tables.BrokenTable(f"no finished snapshot at {root}")
        return empty_frame(spark, schema)
    rows = table.rows()
    if schema is None:
        return rows
    have = set(rows.columns)
    return rows.select(
        *[ref(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def compact(spark: SparkSession, root: str) -> str | None:
    """Fold a business table's snapshots into one; see ``tables.fold``."""
    return tables.fold(spark, root)


def load_hourly_scd2(
    spark: SparkSession,
    source: str | DataFrame,
    contract: Contract,
    layers: Layers,
    moment: datetime,
    **options: Any,
) -> LoadResult:
    """Raw copy, validation, gate, curated ``dt=/hr=`` partition, SCD2 merge.

    Four passes write data: raw (which also counts), rejects (skipped when there
    are none), curated, business. A failed gate raises after the rejects are
    written and before curated is.
    """
    if not layers.raw:
        raise ValueError("an hourly load keeps a raw copy: set layers.raw")
    df = read_source(spark, source) if isinstance(source, str) else source
    with audited(spark, contract.name or "hourly_scd2", layers.audit, moment) as log:
        return _load_scd2(spark, df, contract, layers, moment, log, hourly=True, **options)


def load_daily_scd2(
    spark: SparkSession,
    source: str | DataFrame,
    contract: Contract,
    layers: Layers,
    moment: datetime,
    **options: Any,
) -> LoadResult:
    """Like the hourly load, from an existing raw layer and by ``dt=`` only.

    One aggregate over the rule columns counts; then three passes write data:
    rejects (skipped when there are none), curated, business.
    """
    df = read_source(spark, source) if isinstance(source, str) else source
    in_place = replace(layers, raw="")
    with audited(spark, contract.name or "daily_scd2", layers.audit, moment) as log:
        return _load_scd2(spark, df, contract, in_place, moment, log, hourly=False, **options)


def load_scd1(
    spark: SparkSession,
    source: str | DataFrame,
    contract: Contract,
    layers: Layers,
    moment: datetime,
    *,
    fmt: str = "csv",
    kinds: Sequence[str] = GATED_RULES,
    combine: str = "any",
    on_cast_error: str = "null",
    keys: Sequence[str] | None = None,
    duplicates: str | None = None,
    order_by: Sequence[str] = (),
) -> LoadResult:
    """Raw copy, reject and null gates, staging (``layers.curated``), SCD1 merge.

    This load gates batches; it does not route rows, so invalid rows of an
    accepted batch stay. NULLs count in the null gate, and as invalid rows where ``kinds``
    has ``not_null``; else the audit names the columns that should have none. Rows without a key stay in staging, are counted, and are
    not merged. Three passes: raw (which also counts), staging, and the batch's own
    rows as a snapshot; the table itself is neither read nor rewritten.
    """
    for name in ("raw", "curated", "business"):
        if not getattr(layers, name):
            raise ValueError(f"set layers.{name}")
    df = read_source(spark, source, fmt) if isinstance(source, str) else source
    keys = list(keys or contract.key_columns)
    if not keys:
        raise ContractError("an SCD1 load needs a key: flag a primary_key field or pass keys")
    with audited(spark, contract.name or "scd1", layers.audit, moment) as log:
        result = LoadResult(log=log)
        log_ignored(contract, log)
        mandatory = [f.target for f in contract.fields if not f.nullable]
        if mandatory and "not_null" not in kinds:
            log.warn("contract", "Not-null columns count in the null gate only", columns=mandatory)
        chosen = _duplicates(duplicates, order_by)
        mapping, rules, schema = _compile(
            df, contract, kinds, keep_extra=False, on_cast_error=on_cast_error
        )
        dt, hr = load_partition(moment)
        snapshot = f"{dt}-{hr}"
        shape = with_ingest_ts(mapping.apply(df), moment).drop(CAST_ERROR).schema
        table = _opened(spark, layers.business, "scd1", keys, snapshot, shape, log)
        copied, counts = watched(
            df,
            [
                F.count(F.lit(1)).alias("total_rows"),
                F.count_if(quality.invalid_flag(rules, schema, combine, mapping.value)).alias(
                    "invalid_rows"
                ),
                gates.null_total(contract.target_columns, mapping.value).alias("null_values"),
                F.count_if(reduce(or_, [mapping.value(k).isNull() for k in keys])).alias("keyless_rows"),
            ],
        )
        writers.overwrite(copied, layers.raw)
        metrics = counts.get
        result.metrics.update(metrics)
        log.info("raw_copy", "Raw copy written", path=layers.raw, **metrics)

        total = metrics["total_rows"]
        limits = contract.thresholds
        result.gates = [
            gates.reject_pct(total, metrics["invalid_rows"], limits.max_reject_pct),
            gates.null_pct(total, metrics["null_values"], limits.max_null_pct),
        ]
        for gate in result.gates:
            log.info("gate", f"{gate.name} checked", value=gate.value, passed=gate.passed)
            gate.enforce()

        raw = spark.read.schema(df.schema).parquet(layers.raw)
        staging = with_ingest_ts(mapping.apply(raw), moment).drop(CAST_ERROR)
        writers.overwrite(staging, layers.curated)
        log.info("staging", "Staging written", path=layers.curated)

        batch = spark.read.schema(staging.schema).parquet(layers.curated)
        keyed = table.fitted(batch, snapshot).filter(~any_null(keys))
        unique = _one_row_per_key(keyed, keys, order_by, chosen, result)
        _merge_in(table, unique, snapshot, keyed, keys, chosen, result)
        result.snapshot = snapshot
        result.paths = {
            "raw": layers.raw, "curated": layers.curated, "business": layers.business
        }
        log.info("merge", "Business layer merged", path=layers.business, snapshot=snapshot)
        return result
